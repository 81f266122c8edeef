"""Physical plans: what reaches the scan, and what must not be in a plan."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest

from helpers import random_events
from shoptrail.config import Settings
from shoptrail.operators import behaviour as B
from shoptrail.operators import population as P
from shoptrail.operators import profiling, ranking
from shoptrail.operators.metrics import score_counts
from shoptrail.plans.prepare import clean_events
from shoptrail.session import materialize

CFG = Settings()


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def events(spark):
    return materialize(random_events(spark, 500, 1), "events")


def test_label_filter_and_columns_reach_the_scan(events):
    text = plan(P.label_pairs(events, CFG))
    assert "EqualTo(event_type,purchase)" in text and "GreaterThanOrEqual(event_time,2019-11-01" in text
    assert "price" not in text.split("ReadSchema")[1].split("\n")[0]


def test_fused_features_read_the_log_once(events):
    text = plan(B.pair_activity(B.history(events, CFG), CFG))
    assert text.count("ReadSchema") == 1 and "Expand" not in text
    assert "LessThan(event_time,2019-11-01" in text


def test_matrix_never_joins_on_the_pair(events):
    users = materialize(events.select("user_id").distinct(), "users")
    text = plan(B.feature_matrix(users, events, P.label_pairs(events, CFG), CFG))
    joins = [line for line in text.splitlines() if line.startswith("Left keys")]
    assert joins and all("category_l1" not in line for line in joins)


def test_no_cartesian_product_and_no_python_in_plans(spark, events):
    users = materialize(events.select("user_id").distinct(), "users")
    raw = events.selectExpr("*", "category_l1 as category_code", "1 as product_id", "1L as category_id").drop("category_l1")
    frames = [
        B.feature_matrix(users, events, P.label_pairs(events, CFG), CFG),
        clean_events(raw, CFG),
        profiling.conversion_funnel(events),
        P.scaffold(users, CFG.categories),
        score_counts(P.labelled_scaffold(users, P.label_pairs(events, CFG), CFG.categories).selectExpr("*", "0.5 as score")),
    ]
    for frame in frames:
        text = plan(frame)
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_top_n_limits_before_the_shuffle(spark, events):
    scored = events.selectExpr("user_id", "category_l1", "price as propensity_score")
    assert "WindowGroupLimit" in plan(ranking.top_per_category(scored, 5))
