from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import day
from shoptrail.config import Settings
from shoptrail.functions import columns as X
from shoptrail.functions.hashing import fold_number, hash_order


def test_elapsed_days_are_24_hour_days(spark):
    rows = [(day("2019-10-31 23:00:00"), 0), (day("2019-10-31"), 1), (day("2019-10-29 23:00:00"), 2)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, want int")
    got = df.select(X.elapsed_days(F.col("at"), X.instant(Settings().cutoff)).alias("d"), "want").collect()
    assert all(r.d == r.want for r in got)


def test_strict_time_parse(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:07 UTC",)], "t string")
    assert df.select(X.parse_event_time(F.col("t"))).first()[0] == day("2019-10-01 00:00:07")
    bad = spark.createDataFrame([("yesterday UTC",)], "t string")
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|CAST_INVALID"):
        bad.select(X.parse_event_time(F.col("t"))).collect()


def test_category_levels(spark):
    df = spark.createDataFrame([("a.b.c",), ("x",), (None,)], "c string")
    got = df.select(X.top_level(F.col("c")), X.second_level(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("a", "b"), ("x", None), (None, None)]


def test_clip_keeps_null_and_ratio(spark):
    df = spark.createDataFrame([(3, 0), (1, 4), (None, None)], "carts int, views int")
    got = df.select(X.at_least(F.col("views"), 1), X.cart_view_ratio(F.col("carts"), F.col("views"))).collect()
    assert [tuple(r) for r in got] == [(1, 3.0), (4, 0.25), (None, None)]


def test_empty_to_null_and_percent(spark):
    df = spark.createDataFrame([("", 1, 3), ("z", 1, 0)], "s string, a int, b int")
    got = df.select(X.empty_to_null(F.col("s")), X.percent(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(None, 33.33), ("z", None)]


def test_period_is_half_open(spark):
    rows = [(day("2019-10-31 23:59:59"),), (day("2019-11-01"),), (day("2019-11-05 23:59:59"),), (day("2019-11-06"),)]
    df = spark.createDataFrame(rows, "event_time timestamp_ntz")
    kept = df.filter(X.in_period(Settings().cutoff, Settings().target_end)).collect()
    assert [r.event_time.day for r in kept] == [1, 5]


def test_hash_is_seeded_and_folds_cover_range(spark):
    df = spark.range(500).withColumnRenamed("id", "user_id")
    got = df.select(
        hash_order("user_id", 42, "a").alias("a"), hash_order("user_id", 43, "a").alias("b"),
        fold_number("user_id", 5, 42).alias("fold"),
    ).collect()
    assert all(r.a != r.b for r in got)
    sizes = [sum(r.fold == k for r in got) for k in range(5)]
    assert min(sizes) > 60 and sum(sizes) == 500
