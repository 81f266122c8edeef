"""Ranks and running totals over very large ordered sets.

A window without a small partition key would sort everything in one task. Instead rows are range
partitioned by their sort key, written out with the number of their range, and each range adds
the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.session import materialize

OVERALL = "overall"


def running_totals(
    rows: DataFrame, slices: Sequence[str], order: Sequence[Column], sums: Sequence[str], suffix: str = "_upto"
) -> DataFrame:
    """Adds ``<sum>_upto`` (inclusive running total within the slice) and ``position`` (1, 2, ...).

    ``order`` should identify rows within a slice; then no range holds more than its share, even
    where one score or one slice has a third of the rows. The range number is stored, not
    recomputed, so a retried task cannot see other ranges.
    """
    ranged = rows.repartitionByRange(*slices, *order).withColumn("range", F.spark_partition_id())
    placed = materialize(ranged, "ranked")
    earlier = Window.partitionBy(*slices).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    measures = {name: F.col(name) for name in sums} | {"position": F.lit(1).cast("bigint")}
    # One row per slice and range: as many as there are shuffle partitions and slices.
    per_range = placed.groupBy(*slices, "range").agg(*[F.sum(c).alias(f"{n}_in") for n, c in measures.items()])
    offsets = per_range.select(
        *slices,
        "range",
        *[F.coalesce(F.sum(f"{n}_in").over(earlier), F.lit(0)).alias(f"{n}_before") for n in measures],
    )
    inside = Window.partitionBy(*slices, "range").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = {n: n if n == "position" else f"{n}{suffix}" for n in measures}
    totals = {named[n]: F.col(f"{n}_before") + F.sum(c).over(inside) for n, c in measures.items()}
    joined = placed.join(offsets, [*slices, "range"])
    return joined.withColumns(totals).drop("range", *[f"{n}_before" for n in measures])


def with_overall(rows: DataFrame, by: str = CATEGORY) -> DataFrame:
    """Each row in its own slice and again in the slice ``overall``."""
    return rows.withColumn("slice", F.explode(F.array(F.col(by), F.lit(OVERALL))))


def top_per_category(scored: DataFrame, n: int, score: str = "propensity_score") -> DataFrame:
    """The ``n`` best rows per category; Spark limits each task's groups before the shuffle."""
    best = Window.partitionBy(CATEGORY).orderBy(F.desc(score), F.asc(USER_KEY))
    return scored.withColumn("position", F.row_number().over(best)).filter(F.col("position") <= n).drop("position")


def target_list(scored: DataFrame, score: str = "propensity_score") -> DataFrame:
    """Category ascending, score descending, ties by user: a range-partitioned sort."""
    return scored.orderBy(F.asc(CATEGORY), F.desc(score), F.asc(USER_KEY))
