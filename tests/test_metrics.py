from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptrail.operators import metrics as M
from shoptrail.operators import ranking as R

SCHEMA = "user_id int, category_l1 string, label int, score double"


@pytest.fixture(scope="module")
def four(spark):
    rows = [(1, "c", 1, 0.9), (2, "c", 0, 0.8), (3, "c", 1, 0.8), (4, "c", 0, 0.1)]
    return spark.createDataFrame(rows, SCHEMA)


def _random_rows(n, seed, hot):
    """Random labels and scores; with ``hot`` a third of all rows share one score and category."""
    draw = random.Random(seed)
    rows = []
    for user in range(n):
        category, score = draw.choice("abc"), draw.randint(0, 60) / 60
        if hot and draw.random() < 1 / 3:
            category, score = "a", 0.25
        rows.append((user, category, int(draw.random() < 0.05 + score / 3), score))
    return rows


def _auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / len(pos) / len(neg)


def test_known_values(four):
    assert M.overall_auc(four).first().auc == 0.875
    assert round(M.log_loss(four).first().log_loss, 6) == 0.510826
    recall = {r.k: r.recall for r in M.top_k_recall(four, [0.01, 0.5, 0.75, 1.0]).filter("slice = 'c'").collect()}
    assert recall == {1: 0.5, 2: 0.5, 3: 1.0, 4: 1.0}


def test_log_loss_clips(spark):
    rows = spark.createDataFrame([(1, "c", 1, 1.0), (2, "c", 0, 1.0)], SCHEMA)
    assert M.log_loss(rows).first().log_loss == pytest.approx(-math.log(M.PROBABILITY_MARGIN) / 2, rel=1e-6)


def test_slice_without_positives(spark):
    rows = spark.createDataFrame([(1, "n", 0, 0.3), (2, "n", 0, 0.6), (3, "p", 1, 0.5)], SCHEMA)
    areas = {r.slice: r.auc for r in M.auc_by_slice(rows).collect()}
    assert set(areas) == {"overall"} and areas["overall"] == 0.5
    got = M.top_k_recall(rows).filter("slice = 'n'").collect()
    assert len(got) == 100 and all(r.recall == 0.0 for r in got)


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True)])
def test_auc_against_all_pairs(spark, seed, hot):
    rows = _random_rows(900, seed, hot)
    df = spark.createDataFrame(rows, SCHEMA)
    areas = {r.slice: r.auc for r in M.auc_by_slice(df).collect()}
    for name in "abc":
        assert areas[name] == pytest.approx(_auc([(y, s) for _, c, y, s in rows if c == name]))
    assert areas["overall"] == pytest.approx(_auc([(y, s) for _, _, y, s in rows]))


@pytest.mark.parametrize("seed,hot", [(3, False), (4, True)])
def test_recall_against_sorting(spark, seed, hot):
    rows = _random_rows(700, seed, hot)
    got = {(r.slice, r.share): r.recall for r in M.top_k_recall(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 400
    for name in ["a", "b", "c", "overall"]:
        mine = sorted((r for r in rows if name in (r[1], "overall")), key=lambda r: (-r[3], r[0]))
        total = sum(r[2] for r in mine)
        for share in M.RECALL_SHARES:
            k = max(1, int(len(mine) * share))
            assert got[(name, share)] == pytest.approx(sum(r[2] for r in mine[:k]) / total)


def test_recall_shares_are_the_linear_grid():
    assert list(M.RECALL_SHARES) == list(np.linspace(0.01, 1.0, 100))


@pytest.mark.parametrize("hot", [False, True])
def test_quantiles_and_reliability_against_numpy(spark, hot):
    rows = _random_rows(800, 6, hot)
    df = spark.createDataFrame(rows, SCHEMA)
    scores, labels = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
    counts = df.groupBy("score").agg(F.count("*").alias("n"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert M.exact_quantiles(counts, probs) == pytest.approx(list(np.quantile(scores, probs)))
    edges = np.quantile(scores, np.linspace(0, 1, 11))[1:-1]
    number = np.searchsorted(edges, scores)
    want = {int(b): (scores[number == b].mean(), labels[number == b].mean()) for b in set(number)}
    got = {r.bin: (r.mean_predicted, r.observed_rate) for r in M.reliability_curve(df).collect()}
    assert got.keys() == want.keys()
    assert all(got[b] == pytest.approx(want[b]) for b in want)


def test_histogram_and_summary(spark):
    rows = _random_rows(500, 9, True)
    df = spark.createDataFrame(rows, SCHEMA)
    scores = np.array([r[3] for r in rows])
    got = {r.bin: r["count"] for r in M.score_histogram(df, 7).collect()}
    want, _ = np.histogram(scores, bins=7)
    assert [got.get(i + 1, 0) for i in range(7)] == list(want)
    row = M.score_summary(df).first()
    assert (row.min_score, row.max_score) == (scores.min(), scores.max())
    assert (row.median_score, row.mean_score) == pytest.approx((np.median(scores), scores.mean()))
    same = spark.createDataFrame([(1, "c", 0, 0.4), (2, "c", 1, 0.4)], SCHEMA)
    assert [(r.bin, r["count"]) for r in M.score_histogram(same).collect()] == [(26, 2)]


def test_cold_report(spark):
    rows = [(1, "c", 1, 0.9, None), (2, "c", 0, 0.2, 0), (3, "c", 1, 0.6, 4), (4, "c", 1, 0.3, 2), (5, "c", 0, 0.4, 1)]
    df = spark.createDataFrame(rows, SCHEMA + ", total_views_30d int")
    got = {r.slice: r for r in M.cold_start_report(df).collect()}
    assert (got["cold"].users, got["cold"].positives, got["cold"].auc, got["cold"].user_share) == (2, 1, None, 0.4)
    assert (got["warm"].positives, got["warm"].auc) == (2, 0.5)
    means = {r.slice: r["rows"] for r in M.mean_by_slice(df).collect()}
    assert means == {"cold": 2, "warm": 3, "all": 5}


def test_running_totals_over_many_ranges(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("v"), (F.col("id") % 3).alias("g"))
    got = R.running_totals(df.repartition(16), ["g"], [F.asc("v")], ["v"]).collect()
    for g in range(3):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.v)
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))
        assert [r.v_upto for r in mine] == list(np.cumsum([r.v for r in mine]))


def test_top_per_category_and_order(spark):
    rows = [(u, c, 0, s) for u, c, s in [(1, "b", 0.2), (2, "b", 0.9), (3, "a", 0.5), (4, "b", 0.9), (5, "a", 0.7)]]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("score", "propensity_score")
    assert [r.user_id for r in R.target_list(df).collect()] == [5, 3, 2, 4, 1]
    assert sorted(r.user_id for r in R.top_per_category(df, 1).collect()) == [2, 5]
