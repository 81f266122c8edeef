"""Score requests: the contract, defaults, and behaviour of a fitted model."""

from __future__ import annotations

import json

import pytest

from shoptrail.config import PRIOR, PUBLISHED_CATEGORIES, Settings
from shoptrail.operators import learning as L
from shoptrail.plans import scoring
from shoptrail.session import fresh_path
from shoptrail.sources.tables import requests_from_records
from shoptrail.streaming.scoring import request_stream, score_stream, write_scores

CFG = Settings()
WARM = {
    "record_id": "u_warm", "category_l1": "electronics",
    "views_30d": 20, "carts_30d": 3, "purchases_30d": 1, "views_14d": 10, "carts_14d": 2, "purchases_14d": 0,
    "views_7d": 4, "carts_7d": 1, "purchases_7d": 0,
    "days_since_view": 1, "days_since_cart": 3, "days_since_purchase": 25,
    "total_views_30d": 55, "total_carts_30d": 6, "total_purchases_30d": 2,
    "active_days_30d": 18, "category_breadth_30d": 4, "session_count_30d": 12,
    "brand_count_30d": 5, "avg_price_viewed_30d": 349.0, "avg_price_carted_30d": 299.0,
}
COLD = [{"record_id": i, "category_l1": c} for i, c in [("a", "kids"), ("b", "electronics"), ("c", "apparel")]]


@pytest.fixture(scope="module")
def prior(spark):
    rates = [(c, 0.19 - 0.0251234567 * i) for i, c in enumerate(PUBLISHED_CATEGORIES)]
    return spark.createDataFrame([(c, max(r, 0.003)) for c, r in rates], f"category_l1 string, {PRIOR} double")


@pytest.fixture(scope="module")
def model(spark, prior):
    """Fitted on requests: warm ones buy, and cold ones at their category's rate."""
    records = []
    for i in range(30):
        records += [{**WARM, "category_l1": c} for c in PUBLISHED_CATEGORIES]
        records += [{"record_id": str(i), "category_l1": c} for c in PUBLISHED_CATEGORIES]
    rows = scoring.request_features(requests_from_records(spark, records, CFG), prior, CFG)
    label = f"cast(views_30d > 0 or request_no % 100 < {PRIOR} * 100 as int)"
    return L.fit_linear(rows.selectExpr("*", f"{label} as label"), CFG)


def _ask(spark, records):
    return requests_from_records(spark, records, CFG)


def test_defaults_ratios_and_rounded_prior(spark, prior):
    warm, cold = scoring.request_features(_ask(spark, [WARM, COLD[0]]), prior, CFG).orderBy("request_no").collect()
    assert (warm.cart_view_ratio_30d, warm.cart_view_ratio_7d) == (0.15, 0.25)
    assert all(cold[c] == 0 for c in CFG.count_columns) and cold.total_views_30d is None
    assert (cold.cart_view_ratio_30d, cold.cart_view_ratio_7d) == (0.0, 0.0)
    assert cold[PRIOR] == round(cold[PRIOR], 6)
    parity = scoring.request_features(_ask(spark, [WARM, COLD[0]]), prior, CFG, null_ratio_when_empty=True)
    got = parity.orderBy("request_no").collect()
    assert got[0].cart_view_ratio_7d == 0.25 and got[1].cart_view_ratio_7d is None


def test_unreadable_numbers_become_null(spark, prior):
    text = spark.createDataFrame([("r", "kids", "many", "3")], "record_id string, category_l1 string, total_views_30d string, views_30d string")
    row = scoring.request_features(text, prior, CFG).first()
    assert row.total_views_30d is None and row.views_30d == 3.0 and row.carts_7d == 0.0


def test_response_schema_and_range(spark, model, prior):
    row = scoring.score_batch(model, _ask(spark, [WARM]), prior, CFG).first()
    assert row.asDict().keys() == {"record_id", "category_l1", "propensity_score"}
    assert (row.record_id, row.category_l1) == ("u_warm", "electronics")
    assert 0 <= row.propensity_score <= 1 and round(row.propensity_score, 6) == row.propensity_score


def test_unknown_category_is_rejected(spark, model, prior):
    asked = _ask(spark, [{"record_id": "x", "category_l1": "spaceship"}, {"record_id": "y"}, COLD[0]])
    assert {r.record_id for r in scoring.rejected(asked, CFG).collect()} == {"x", "y"}
    assert [r.record_id for r in scoring.score_batch(model, asked, prior, CFG).collect()] == ["a"]


def test_empty_input(spark, model, prior):
    assert scoring.score_batch(model, _ask(spark, []), prior, CFG).collect() == []


def test_descending_and_ties_in_request_order(spark, model, prior):
    twice = COLD + [{**r, "record_id": r["record_id"] * 2} for r in COLD]
    rows = scoring.score_batch(model, _ask(spark, twice), prior, CFG).collect()
    scores = [r.propensity_score for r in rows]
    assert scores == sorted(scores, reverse=True)
    assert [r.record_id for r in rows if r.category_l1 == "kids"] == ["a", "aa"]


def test_warm_above_cold_and_cold_follows_prior(spark, model, prior):
    rows = scoring.score_batch(model, _ask(spark, [WARM, *COLD]), prior, CFG).collect()
    score = {r.record_id: r.propensity_score for r in rows}
    assert score["u_warm"] > score["b"] > score["a"]


def test_stream_gives_the_batch_scores(spark, model, prior, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "1.json").write_text("\n".join(json.dumps(r) for r in [WARM, *COLD, {"category_l1": "spaceship"}]))
    out = fresh_path(spark, "scores")
    stream = score_stream(model, request_stream(spark, str(inbox), CFG), prior, CFG)
    query = write_scores(stream, out, fresh_path(spark, "progress"))
    query.awaitTermination(120)
    got = {r.record_id: r.propensity_score for r in spark.read.parquet(out).collect()}
    batch = scoring.score_batch(model, _ask(spark, [WARM, *COLD]), prior, CFG).collect()
    assert got == {r.record_id: r.propensity_score for r in batch}
