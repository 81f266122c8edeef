"""Distinct counts by bitmaps and of texts, and support without the scaffold."""

from __future__ import annotations

from pyspark.sql import functions as F

from helpers import random_events
from shoptrail.operators import population as P
from shoptrail.operators import profiling as R


def test_distinct_counts_of_all_kinds_of_numbers(spark):
    values = [None, None, 0, 0, 1, -1, 5, -5, 32767, 32768, 32769, -32768, -32769, 2**40, -(2**40), 2**40]
    rows = spark.createDataFrame([(v, None, None if v is None else str(v)) for v in values], "a long, b int, c string")
    got = {r["measure"]: r["n"] for r in R.distinct_numbers(rows, {"x": "a", "y": "b"}).collect()}
    assert got == {"x": len(set(values)), "y": 1}
    texts = {r["measure"]: r["n"] for r in R.distinct_texts(rows, {"z": "c"}).collect()}
    assert texts == {"z": len(set(values))}
    assert R.distinct_numbers(rows.filter("false"), {"x": "a"}).collect() == []


def test_profile_equals_single_counts(spark):
    events = random_events(spark, 800, 5).select(
        "*", F.col("user_id").alias("product_id"), F.when(F.rand(1) < 0.8, F.col("category_l1")).alias("category_code"))
    events = events.union(events.limit(40)).cache()
    row = R.profile_report(events).first()
    assert row.total_rows == 840 and row.duplicates == 840 - events.select(*R.DEDUP_KEY).distinct().count()
    for name, column in {"unique_users": "user_id", "unique_sessions": "user_session", "unique_brands": "brand",
                         "unique_category_codes": "category_code", "unique_products": "product_id"}.items():
        assert row[name] == events.select(column).distinct().count()
    for column in ("brand", "category_code", "user_session"):
        assert row[f"null_{column}"] == events.filter(F.col(column).isNull()).count()
    empty = R.profile_report(events.filter("false")).first()
    assert (empty.total_rows, empty.unique_users, empty.unique_brands, empty.null_brand, empty.duplicates) == (0, 0, 0, 0, 0)


def test_support_equals_the_scaffold(spark):
    users = spark.range(30).select(F.col("id").alias("user_id"))
    pairs = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (99, "b")], "user_id long, category_l1 string")
    names = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "category_l1 string")
    for least in (0, 1, 2):
        want = P.category_support(P.attach_labels(P.full_scaffold(users, names), pairs), least)
        got = P.support_of_users(users, pairs, names, least)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_support_makes_no_rows_per_user(spark):
    users = spark.range(5).select(F.col("id").alias("user_id"))
    pairs = spark.createDataFrame([(1, "a")], "user_id long, category_l1 string")
    plan = P.support_of_users(users, pairs, pairs, 0)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
