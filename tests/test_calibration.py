"""Isotonic calibration over ranges against one pass over the sorted points."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptrail.operators import calibration as C

SCHEMA = "row int, score double, label int, calibrated_by string"


def plain(points):
    """Pools of (score, positives, rows) sorted by score, as score -> value."""
    pools = []
    for score, pos, n in sorted(points):
        pools.append([[score], pos, n])
        while len(pools) > 1 and Fraction(pools[-2][1], pools[-2][2]) >= Fraction(pools[-1][1], pools[-1][2]):
            scores, pos, n = pools.pop()
            pools[-1] = [pools[-1][0] + scores, pools[-1][1] + pos, pools[-1][2] + n]
    return {s: pos / n for scores, pos, n in pools for s in scores}


def points_of(kind, n=600):
    draw = random.Random(kind)
    chance = {"rising": lambda k: k / n, "falling": lambda k: 1 - k / n, "flat": lambda k: 0.3, "steps": lambda k: (k // 100 % 3) / 3}[kind]
    out = []
    for k in range(n):
        rows = draw.randint(1, 9)
        out.append((k / n, sum(draw.random() < chance(k) for _ in range(rows)), rows))
    return out


@pytest.mark.parametrize("kind", ["rising", "falling", "flat", "steps"])
@pytest.mark.parametrize("range_rows", [7, 90, 10_000])
def test_pools_equal_one_pass(spark, kind, range_rows):
    points = points_of(kind)
    got = C.isotonic_pools(spark.createDataFrame(points, "score double, pos long, n long"), range_rows).collect()
    value = plain(points)
    by = sorted((r["low"], r["high"], r["pos"] / r["n"]) for r in got)
    rates = [v for *_, v in by]
    assert all(a < b for a, b in zip(rates, rates[1:]))
    assert sum(r["n"] for r in got) == sum(p[2] for p in points)
    for low, high, rate in by:
        assert all(value[s] == pytest.approx(rate) for s, *_ in points if low <= s <= high)


@pytest.mark.parametrize("most_sent", [1_000_000, 0])
def test_lines_between_pools_and_ends(spark, most_sent):
    points = points_of("rising", 60)
    rows = [(k, s, int(i < pos), "mine") for k, (s, pos, n) in enumerate(points) for i in range(n)]
    model = C.fit_calibrator(spark.createDataFrame([*rows, (0, None, 1, "x")], SCHEMA), range_rows=9)
    value = plain(points)
    xs, ys = zip(*sorted(value.items()))
    asked = [-1.0, 0.0, 0.0083, 0.33, 0.5, 0.505, 0.999, 3.0] + [0.25] * 50
    frame = spark.createDataFrame([(k, s, 0, "mine") for k, s in enumerate(asked)] + [(99, None, 0, None)], SCHEMA)
    got = {r["row"]: r for r in C.calibrate(model, frame, most_sent=most_sent).collect()}
    assert len(got) == len(asked) + 1 and got[99]["calibrated"] is None and got[0]["calibrated_by"] == "mine"
    assert [got[k]["calibrated"] for k in range(len(asked))] == pytest.approx(list(np.interp(asked, xs, ys)))


@pytest.mark.parametrize("most_sent", [1_000_000, -1])
def test_nothing_to_learn_from(spark, most_sent):
    rows = spark.createDataFrame([(1, 0.5, 1, None)], SCHEMA)
    model = C.fit_calibrator(rows.filter("false"))
    assert [r["calibrated"] for r in C.calibrate(model, rows, most_sent=most_sent).collect()] == [None]
    assert C.calibrate(C.fit_calibrator(rows), rows.filter("false"), most_sent=most_sent).count() == 0


def test_hot_score_is_one_point(spark):
    rows = spark.range(3000).select((F.col("id") % 7).cast("int").alias("row"), F.lit(0.25).alias("score"),
                                    (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit("x").alias("calibrated_by"))
    model = C.fit_calibrator(rows)
    assert model.pools.count() == 1
    assert C.calibrate(model, rows).filter("abs(calibrated - 1 / 3) < 1e-9").count() == 3000
