"""Behavioural features as of the cutoff.

The first five functions are the single feature groups. ``pair_activity`` and ``user_profile``
compute all of them in one aggregation per grain; ``feature_matrix`` is what the staged run uses.
All of them expect events from before the cutoff (``history``).
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, KINDS, PAIR_KEY, USER_KEY, Settings
from shoptrail.functions.columns import cart_view_ratio, elapsed_days, in_period, instant, is_kind
from shoptrail.operators.population import scaffold
from shoptrail.session import fits

PAIR = list(PAIR_KEY)


def history(events: DataFrame, cfg: Settings) -> DataFrame:
    return events.filter(in_period(end=cfg.cutoff))


def _counts(suffix: str, start: datetime | None = None) -> list[Column]:
    return [F.count_if(is_kind(k) & in_period(start)).alias(f"{k}s_{suffix}") for k in KINDS]


def _last_seen() -> list[Column]:
    return [F.max(F.when(is_kind(k), F.col("event_time"))).alias(f"last_{k}") for k in KINDS]


def _mean_prices(cfg: Settings) -> list[Column]:
    price = F.col("price").cast("double")
    return [F.avg(F.when(is_kind(k), price)).alias(c) for k, c in zip(KINDS, cfg.price_columns)]


def _recency(frame: DataFrame, cfg: Settings) -> DataFrame:
    days = {f"days_since_{k}": elapsed_days(F.col(f"last_{k}"), instant(cfg.cutoff)) for k in KINDS}
    return frame.withColumns(days).drop(*[f"last_{k}" for k in KINDS])


def pair_counts(past: DataFrame, suffix: str, start: datetime | None = None) -> DataFrame:
    """Views, carts and purchases per (user, category) since ``start``."""
    return past.filter(in_period(start)).groupBy(*PAIR).agg(*_counts(suffix))


def pair_window_counts(past: DataFrame, cfg: Settings) -> DataFrame:
    """The counts of all windows side by side; null where a pair is absent from a window."""
    frames = [pair_counts(past, suffix, start) for suffix, start in cfg.windows]
    return reduce(lambda left, right: left.join(right, PAIR, "left"), frames)


def pair_recency(past: DataFrame, cfg: Settings) -> DataFrame:
    """Whole days from the last view, cart and purchase to the cutoff."""
    return _recency(past.groupBy(*PAIR).agg(*_last_seen()), cfg)


def pair_brands(past: DataFrame, cfg: Settings) -> DataFrame:
    branded = past.filter(F.col("brand").isNotNull())
    return branded.groupBy(*PAIR).agg(F.count_distinct("brand").alias(cfg.brand_column))


def pair_prices(past: DataFrame, cfg: Settings) -> DataFrame:
    return past.groupBy(*PAIR).agg(*_mean_prices(cfg))


def user_engagement(past: DataFrame, cfg: Settings) -> DataFrame:
    """User totals, active days, categories touched and sessions."""
    totals = [F.count_if(is_kind(k)).alias(f"total_{k}s_{cfg.full}") for k in KINDS]
    return past.groupBy(USER_KEY).agg(
        *totals,
        F.count_distinct(F.to_date("event_time")).alias(f"active_days_{cfg.full}"),
        F.count_distinct(CATEGORY).alias(f"category_breadth_{cfg.full}"),
        F.count_distinct("user_session").alias(f"session_count_{cfg.full}"),
    )


def assemble(
    labelled: DataFrame,
    counts: DataFrame,
    recency: DataFrame,
    users: DataFrame,
    brands: DataFrame,
    prices: DataFrame,
    cfg: Settings,
) -> DataFrame:
    """Feature groups joined onto labelled pairs.

    Ratios come before the zero fill, so a pair without events in a window has counts 0 and a
    null ratio. User-level columns join first, while rows are narrow.
    """
    rows = labelled.join(users, USER_KEY, "left")
    for frame in (counts, recency, brands, prices):
        rows = rows.join(frame, PAIR, "left")
    return _finish(rows, cfg)


def _finish(rows: DataFrame, cfg: Settings) -> DataFrame:
    ratios = {
        f"cart_view_ratio_{s}": cart_view_ratio(F.col(f"carts_{s}"), F.col(f"views_{s}"))
        for s in cfg.ratio_windows
    }
    features = set(cfg.stored_features)
    carried = [c for c in rows.columns if c not in features]
    return rows.withColumns(ratios).fillna(0, cfg.count_columns).select(*carried, *cfg.stored_features)


def pair_activity(past: DataFrame, cfg: Settings) -> DataFrame:
    """Counts of every window, recency, prices and brands per pair, in one aggregation.

    The only distinct count is over brands. Spark then shuffles partial results by (user,
    category, brand) first, so one very busy user or category is spread over many tasks. Counts
    of a window in which the pair has no event at all are null, as after a left join of windows.
    """
    present = {s: F.count_if(in_period(start)).alias(f"events_{s}") for s, start in cfg.windows[1:]}
    columns = [c for suffix, start in cfg.windows for c in _counts(suffix, start)]
    grouped = past.groupBy(*PAIR).agg(
        *columns,
        *present.values(),
        *_last_seen(),
        *_mean_prices(cfg),
        F.nullif(F.count_distinct("brand"), F.lit(0)).alias(cfg.brand_column),
    )
    absent_is_null = {
        f"{k}s_{s}": F.when(F.col(f"events_{s}") > 0, F.col(f"{k}s_{s}")) for s in present for k in KINDS
    }
    return _recency(grouped.withColumns(absent_is_null), cfg).drop(*[f"events_{s}" for s in present])


def user_visits(past: DataFrame, cfg: Settings) -> DataFrame:
    """Active days and sessions per user: the two values that need the events themselves.

    Spark shuffles (user, day) and (user, session) after removing repeats on the map side, and
    only then counts per user, so a busy user's events are spread by day and session.
    """
    return past.groupBy(USER_KEY).agg(
        F.count_distinct(F.to_date("event_time")).alias(f"active_days_{cfg.full}"),
        F.count_distinct("user_session").alias(f"session_count_{cfg.full}"),
    )


def user_profile(past: DataFrame, cfg: Settings) -> DataFrame:
    """One row per user: user-level features, and a map from category to the pair's features.

    Totals and breadth roll up from the pairs. The map holds configured categories only, so it
    has at most ``len(cfg.categories)`` entries however busy the user is.
    """
    pairs = pair_activity(past, cfg)
    details = F.struct(*[c for c in pairs.columns if c not in PAIR])
    wanted = F.when(F.col(CATEGORY).isin(list(cfg.categories)), F.struct(F.col(CATEGORY), details))
    rolled = pairs.groupBy(USER_KEY).agg(
        *[F.sum(f"{k}s_{cfg.full}").alias(f"total_{k}s_{cfg.full}") for k in KINDS],
        F.count("*").alias(f"category_breadth_{cfg.full}"),
        F.map_from_entries(F.collect_list(wanted)).alias("by_category"),
    )
    return rolled.join(user_visits(past, cfg), USER_KEY)


def restrict_to_users(past: DataFrame, users: DataFrame, cfg: Settings) -> DataFrame:
    """Drop other users' events before aggregating, if the user set is small enough to send
    to every task. Otherwise return all events: aggregating them first and joining the results
    shuffles less than joining the events, and a busy user's events never meet in one task.
    """
    ids = users.select(USER_KEY)
    if fits(ids, cfg.broadcast_rows):
        return past.join(F.broadcast(ids), USER_KEY, "left_semi")
    return past


def feature_matrix(users: DataFrame, events: DataFrame, pairs: DataFrame, cfg: Settings) -> DataFrame:
    """One row per (user, configured category) with label and stored features.

    ``users`` is the materialized pool (any further columns, such as ``split``, are kept);
    ``pairs`` are the label pairs. Everything is brought to one row per user, joined on the
    user, and only then spread over the categories: the wide scaffold itself is never shuffled.
    """
    past = restrict_to_users(history(events, cfg), users, cfg)
    bought = (
        pairs.filter(F.col(CATEGORY).isin(list(cfg.categories)))
        .groupBy(USER_KEY)
        .agg(F.collect_set(CATEGORY).alias("bought"))
    )
    per_user = users.join(user_profile(past, cfg), USER_KEY, "left").join(bought, USER_KEY, "left")
    rows = scaffold(per_user, cfg.categories)
    label = F.coalesce(F.array_contains("bought", F.col(CATEGORY)), F.lit(False)).cast("int")
    rows = rows.withColumns({"label": label, "pair": F.try_element_at("by_category", F.col(CATEGORY))})
    return _finish(rows.select(*users.columns, CATEGORY, "label", *cfg.user_columns, "pair.*"), cfg)
