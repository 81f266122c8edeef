"""Scalar expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: datetime) -> Column:
    """A timestamp literal without time zone, which Parquet filters can use."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def strip_utc(text: Column) -> Column:
    return F.regexp_replace(text, " UTC$", "")


def parse_event_time(text: Column) -> Column:
    """Strict parse of ``2019-10-01 00:00:00 UTC``: malformed text fails the job under ANSI."""
    return F.to_timestamp_ntz(strip_utc(text), F.lit("yyyy-MM-dd HH:mm:ss"))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def top_level(code: Column) -> Column:
    """``electronics.audio.headphone`` -> ``electronics``."""
    return F.split_part(code, F.lit("."), F.lit(1))


def second_level(code: Column) -> Column:
    """``electronics.audio.headphone`` -> ``audio``; null where there is no second level."""
    return F.get(F.split(code, "[.]"), F.lit(1))


def elapsed_days(since: Column, until: Column) -> Column:
    """Whole elapsed days (24 hours each), not calendar days."""
    return F.timestamp_diff("DAY", since, until)


def at_least(value: Column, bound: int) -> Column:
    """Lower clip that keeps null."""
    return F.when(value < bound, F.lit(bound)).otherwise(value)


def cart_view_ratio(carts: Column, views: Column) -> Column:
    return carts / at_least(views, 1)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.try_divide(part, whole) * 100, places)


def is_kind(kind: str) -> Column:
    return F.col("event_type") == kind


def in_period(start: datetime | None = None, end: datetime | None = None) -> Column:
    """``start <= event_time < end``; an absent bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col("event_time") >= instant(start))
    if end is not None:
        condition = condition & (F.col("event_time") < instant(end))
    return condition
