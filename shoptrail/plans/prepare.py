"""Raw log -> clean log -> population -> feature matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.config import USER_KEY, Settings
from shoptrail.operators.behaviour import feature_matrix
from shoptrail.operators.cleaning import (
    add_category_l1,
    drop_duplicates,
    drop_incomplete,
    keep_view_users,
    viewless_users,
)
from shoptrail.operators.population import build_population, label_pairs
from shoptrail.session import fits, materialize


def clean_log(raw: DataFrame) -> DataFrame:
    """The cleaning rules as one lazy query. Who has viewed is decided on all raw rows."""
    return add_category_l1(drop_duplicates(keep_view_users(drop_incomplete(raw), raw))).select(*raw.columns, "category_l1")


def clean_events(raw: DataFrame, cfg: Settings) -> DataFrame:
    """The same result for a very large log.

    Users without a view are rare, so they are listed and removed. While that list is small it
    is broadcast and the log is shuffled once, by the full duplicate key, which no busy user can
    skew. If it is large, duplicates go first and the rest is joined; nothing above that join
    needs its partitioning, so adaptive execution may split a busy user's partition.
    """
    complete = drop_incomplete(raw).filter(F.col(USER_KEY).isNotNull())
    viewless = materialize(viewless_users(raw), "viewless")
    if fits(viewless, cfg.broadcast_rows):
        kept = drop_duplicates(complete.join(F.broadcast(viewless), USER_KEY, "left_anti"))
    else:
        kept = drop_duplicates(complete).join(viewless, USER_KEY, "left_anti")
    return add_category_l1(kept).select(*raw.columns, "category_l1")


def build_matrix(events: DataFrame, cfg: Settings) -> DataFrame:
    """Train and test feature matrix of a clean log, with ``split``."""
    pool = materialize(build_population(events, cfg).select(USER_KEY, "split"), "pool-split")
    return feature_matrix(pool, events, label_pairs(events, cfg), cfg)
