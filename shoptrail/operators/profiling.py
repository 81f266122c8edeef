"""Profiling reports over the event log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, DEDUP_KEY, KINDS, USER_KEY
from shoptrail.functions.columns import in_period, is_kind, percent
from shoptrail.session import materialize


def overview(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total_rows"),
        F.min("event_time").alias("time_min"),
        F.max("event_time").alias("time_max"),
    )


def distinct_count(events: DataFrame, column: str) -> DataFrame:
    return events.select(F.col(column).alias("value")).distinct().agg(F.count("*").alias("n"))


def distinct_counts(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct values per column, null counting as a value; ``columns`` maps alias -> column.

    Each column is counted by its own two-step aggregation over a one-column scan. One
    aggregation with several distincts would multiply every row by the number of columns.
    """
    each = [
        distinct_count(events, name).select(F.lit(alias).alias("measure"), "n")
        for alias, name in columns.items()
    ]
    stacked = reduce(DataFrame.unionByName, each)
    return stacked.agg(*[F.max(F.when(F.col("measure") == a, F.col("n"))).alias(a) for a in columns])


def null_counts(events: DataFrame) -> DataFrame:
    return events.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in events.columns])


def null_percent_by_type(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    shares = [F.round(F.avg(F.col(c).isNull().cast("int")) * 100, 2).alias(f"{c}_null_pct") for c in columns]
    return events.groupBy("event_type").agg(*shares)


def share_of_total(events: DataFrame, by: str) -> DataFrame:
    """Rows per group and their share. Events are read once: the total is summed from the stored group rows."""
    counts = materialize(events.groupBy(by).agg(F.count("*").alias("count")), "group-counts")
    total = counts.agg(F.sum("count").alias("n")).scalar()
    return counts.withColumn("pct", percent(F.col("count"), total))


def duplicate_report(events: DataFrame) -> DataFrame:
    """Rows, distinct keys, surplus copies and their percentage."""
    per_key = events.groupBy(*DEDUP_KEY).agg(F.count("*").alias("copies"))
    return (
        per_key.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_rows"))
        .withColumn("duplicates", F.col("total_rows") - F.col("unique_rows"))
        .withColumn("duplicate_pct", percent(F.col("duplicates"), F.col("total_rows"), 3))
    )


def daily_counts(events: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """Events per day, one column per event type, null where a day lacks the type."""
    daily = events.groupBy(F.to_date("event_time").alias("date"), "event_type").agg(F.count("*").alias("n"))
    return daily.groupBy("date").pivot("event_type", list(kinds)).agg(F.sum("n"))


def conversion_funnel(events: DataFrame) -> DataFrame:
    """Events and users by type, and both as a percentage of views. Events are read once."""
    funnel = events.groupBy("event_type").agg(
        F.count("*").alias("events"), F.count_distinct(USER_KEY).alias("unique_users")
    )
    funnel = materialize(funnel, "funnel")
    views = funnel.filter(is_kind("view"))
    view_events = views.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n")).scalar()
    view_people = views.agg(F.coalesce(F.sum("unique_users"), F.lit(0)).alias("n")).scalar()
    return funnel.withColumns(
        {
            "pct_of_view_events": percent(F.col("events"), view_events),
            "pct_of_view_users": percent(F.col("unique_users"), view_people),
        }
    )


def top_groups(events: DataFrame, by: str, n: int = 20, count: str = "count") -> DataFrame:
    """The ``n`` largest groups; equal counts are ordered by name."""
    counts = events.groupBy(by).agg(F.count("*").alias(count))
    return counts.orderBy(F.desc(count), F.asc_nulls_first(by)).limit(n)


def purchase_null_share(events: DataFrame) -> DataFrame:
    missing = F.count_if(F.col("category_code").isNull())
    return (
        events.filter(is_kind("purchase"))
        .agg(F.count("*").alias("total_purchases"), missing.alias("null_category"))
        .withColumn("null_pct", percent(F.col("null_category"), F.col("total_purchases")))
    )


def window_purchases(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Purchases and distinct buyers per category inside ``[start, end)``."""
    return (
        events.filter(is_kind("purchase") & in_period(start, end))
        .groupBy(CATEGORY)
        .agg(F.count("*").alias("purchases"), F.count_distinct(USER_KEY).alias("unique_buyers"))
    )


def purchase_only_users(events: DataFrame) -> DataFrame:
    """Users who bought without a single view, from one aggregation per user."""
    return (
        events.groupBy(USER_KEY)
        .agg(F.coalesce(F.max(is_kind("purchase")), F.lit(False)).alias("bought"),
             F.coalesce(F.max(is_kind("view")), F.lit(False)).alias("viewed"))
        .filter(F.col("bought") & ~F.col("viewed"))
        .select(USER_KEY)
    )


def rows_of_users(events: DataFrame, users: DataFrame) -> DataFrame:
    """How many rows the given users have; events are counted per user before the join."""
    per_user = events.groupBy(USER_KEY).agg(F.count("*").alias("n"))
    return per_user.join(users, USER_KEY, "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def distinct_numbers(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(measure, n): distinct values of integer columns, null counting as a value, from one scan.

    Values set bits: one bitmap of 4 KB per 32,768 neighbouring ids, built before the shuffle and merged behind it.
    """
    entry = [F.struct(F.lit(alias).alias("measure"), F.col(name).cast("bigint").alias("value")) for alias, name in columns.items()]
    values = events.select(F.explode(F.array(*entry)).alias("e")).select("e.*")
    maps = values.groupBy("measure", F.bitmap_bucket_number("value").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits"))
    filled = F.when(F.col("bucket").isNull(), F.lit(1).cast("bigint")).otherwise(F.bitmap_count("bits"))
    return maps.groupBy("measure").agg(F.sum(filled).alias("n"))


def distinct_texts(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(measure, n): distinct values of text columns, null counting as a value, from one scan."""
    entry = [F.struct(F.lit(alias).alias("measure"), F.col(name).cast("string").alias("value")) for alias, name in columns.items()]
    values = events.select(F.explode(F.array(*entry)).alias("e")).select("e.*")
    return values.distinct().groupBy("measure").agg(F.count("*").alias("n"))


def profile_report(events: DataFrame) -> DataFrame:
    """The one-row profile: volume, time range, distinct counts, nulls and duplicates, from three scans.

    Volume, nulls and time range come with the count of distinct duplicate keys; integer ids are counted by bitmaps, texts by
    their distinct values.
    """
    missing = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in ("category_code", "brand")}
    per_key = events.groupBy(*DEDUP_KEY).agg(F.count("*").alias("copies"), *[c.alias(n) for n, c in missing.items()])
    sums = {n: F.coalesce(F.sum(n), F.lit(0)) for n in missing}
    no_session = F.coalesce(F.sum(F.when(F.col("user_session").isNull(), F.col("copies"))), F.lit(0))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    base = per_key.agg(
        total.alias("total_rows"),
        F.min("event_time").alias("time_min"),
        F.max("event_time").alias("time_max"),
        *[c.alias(n) for n, c in sums.items()],
        no_session.alias("null_user_session"),
        (total - F.count("*")).alias("duplicates"),
    )
    numbers = {"unique_users": "user_id", "unique_products": "product_id"}
    texts = {"unique_sessions": "user_session", "unique_brands": "brand", "unique_category_codes": "category_code"}
    counted = distinct_numbers(events, numbers).unionByName(distinct_texts(events, texts))
    names = [*numbers, *texts]
    one = counted.agg(*[F.coalesce(F.max(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).alias(m) for m in names])
    columns = ["total_rows", "time_min", "time_max", *missing, "null_user_session", *names, "duplicates"]
    return base.withColumn("one", F.lit(1)).join(one.withColumn("one", F.lit(1)), "one").select(*columns)
