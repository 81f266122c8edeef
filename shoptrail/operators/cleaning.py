"""Cleaning the event log and recovering missing categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, DEDUP_KEY, USER_KEY
from shoptrail.functions.columns import (
    empty_to_null,
    is_kind,
    parse_event_time,
    percent,
    second_level,
    top_level,
)


def parse_events(text_events: DataFrame) -> DataFrame:
    """Delivered text columns -> typed event log."""
    return text_events.withColumns(
        {
            "event_time": parse_event_time(F.col("event_time")),
            "category_code": empty_to_null(F.col("category_code")),
            "brand": empty_to_null(F.col("brand")),
        }
    )


def drop_incomplete(events: DataFrame) -> DataFrame:
    """Keep rows that have a category and a session."""
    return events.filter(F.col("category_code").isNotNull() & F.col("user_session").isNotNull())


def view_users(events: DataFrame) -> DataFrame:
    return events.filter(is_kind("view")).select(USER_KEY).distinct()


def viewless_users(events: DataFrame) -> DataFrame:
    """Users who never viewed anything: the few to remove, not the many to keep.

    A missing event type is no view.
    """
    return (
        events.filter(F.col(USER_KEY).isNotNull())
        .groupBy(USER_KEY)
        .agg(F.coalesce(F.max(is_kind("view")), F.lit(False)).alias("has_view"))
        .filter(~F.col("has_view"))
        .select(USER_KEY)
    )


def keep_view_users(events: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows of users with at least one view anywhere in ``raw``."""
    return events.join(view_users(raw), USER_KEY, "left_semi")


def drop_duplicates(events: DataFrame) -> DataFrame:
    """One row per (time, user, type, product, session), the one with the smallest remainder.

    The partial aggregation runs before the shuffle, so even a row copied millions of times
    reaches the final task once per input split.
    """
    rest = [name for name in events.columns if name not in DEDUP_KEY]
    ordered = sorted(rest, key=lambda name: (name != "price", name))
    return (
        events.groupBy(*DEDUP_KEY)
        .agg(F.min(F.struct(*ordered)).alias("kept"))
        .select(*[F.col(n) if n in DEDUP_KEY else F.col(f"kept.{n}").alias(n) for n in events.columns])
    )


def add_category_l1(events: DataFrame) -> DataFrame:
    return events.withColumn(CATEGORY, top_level(F.col("category_code")))


def add_category_levels(events: DataFrame) -> DataFrame:
    return add_category_l1(events).withColumn("category_l2", second_level(F.col("category_code")))


def first_known_code(events: DataFrame, key: str) -> DataFrame:
    """``key`` -> the category code seen first for it (ties: the smaller code).

    The earliest time per (key, code) is a plain hash aggregation that leaves few rows, so the
    choice among codes sorts almost nothing.
    """
    earliest = (
        events.filter(F.col("category_code").isNotNull())
        .groupBy(key, "category_code")
        .agg(F.min("event_time").alias("first_seen"))
    )
    return earliest.groupBy(key).agg(
        F.min_by("category_code", F.struct("first_seen", "category_code")).alias("category_code")
    )


def uncategorised_purchases(events: DataFrame) -> DataFrame:
    return events.filter(is_kind("purchase") & F.col("category_code").isNull())


def recovery_report(events: DataFrame, key: str) -> DataFrame:
    """How many purchases without a category could get one through ``key``.

    Purchases are counted per key before the join, so a product that holds a third of them costs
    one row.
    """
    lost = uncategorised_purchases(events).groupBy(key).agg(F.count("*").alias("n"))
    known = first_known_code(events, key).withColumn("known", F.lit(True)).drop("category_code")
    total = F.coalesce(F.sum("n"), F.lit(0))
    found = F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0))
    return (
        lost.join(known, key, "left")
        .agg(total.alias("total_null"), found.alias("recoverable"))
        .withColumn("unrecoverable", F.col("total_null") - F.col("recoverable"))
        .withColumn("recoverable_pct", percent(F.col("recoverable"), F.col("total_null"), 1))
        .withColumn("unrecoverable_pct", percent(F.col("unrecoverable"), F.col("total_null"), 1))
    )


def backfill_category(events: DataFrame, key: str) -> DataFrame:
    """Fill missing category codes from the first code known for ``key``.

    Only rows without a code are joined. They carry a hot product at most as often as it lacks
    its code; adaptive execution splits such a partition.
    """
    lookup = first_known_code(events, key).withColumnRenamed("category_code", "known_code")
    missing = events.filter(F.col("category_code").isNull()).join(lookup, key, "left")
    filled = missing.withColumn("category_code", F.col("known_code")).select(*events.columns)
    return events.filter(F.col("category_code").isNotNull()).unionByName(filled)
