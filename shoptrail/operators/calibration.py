"""Isotonic calibration of scores, pooled range by range.

Rows are first reduced to one weighted point per distinct score. Points are range partitioned by score; every task pools adjacent
violators of its range, in whole numbers. Pools that violate across a boundary are found from the first and last pool of each
range; then the pools, far fewer than points, are dealt to shifted ranges and pooled again, until none is left. The order in which
violators are pooled does not matter, so the result is that of one long sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from shoptrail.operators.metrics import log_loss_of
from shoptrail.operators.ranking import running_totals
from shoptrail.session import fits, materialize

RANGE_ROWS = 500_000
# Pools up to which their bounds are sent to every task (24 bytes each).
MOST_SENT = 1_000_000
_POOLS = "low double, high double, pos bigint, n bigint"


def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pools of one range, whose points or pools arrive in the order of their scores."""
    stack: list[list] = []
    for batch in batches:
        for low, high, pos, n in zip(*[batch.column(c).to_pylist() for c in ("low", "high", "pos", "n")]):
            while stack and stack[-1][2] * n >= pos * stack[-1][3]:
                last = stack.pop()
                low, pos, n = last[0], pos + last[2], n + last[3]
            stack.append([low, high, pos, n])
    types = [pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    for k in range(0, len(stack), 10_000):
        columns = zip(*stack[k : k + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["low", "high", "pos", "n"])


def _ends(pools: DataFrame) -> DataFrame:
    """Per range its first and last pool: as many rows as ranges."""
    pool = F.struct("low", "pos", "n")
    return pools.groupBy("range").agg(F.min_by(pool, "low").alias("first"), F.max_by(pool, "low").alias("last"))


def isotonic_pools(points: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(range, low, high, pos, n): pools of rising rate; points: score, pos, n with distinct scores."""
    given = points.select(F.col("score").alias("low"), F.col("score").alias("high"), "pos", "n")
    pools, turn = materialize(given, "points"), 0
    while True:
        ranges = max(1, -(-pools.count() // range_rows) >> turn // 4)  # fewer if violations should keep returning
        dealt = pools.repartitionByRange(ranges + turn % 2 * (ranges > 1), "low").sortWithinPartitions("low")
        pools = materialize(dealt.mapInArrow(pooled, _POOLS).withColumn("range", F.spark_partition_id()), "pools")
        before = F.lag("last").over(Window.orderBy("range"))
        crossed = _ends(pools).withColumn("before", before).filter(
            F.col("before.pos").cast("decimal(38,0)") * F.col("first.n") >= F.col("first.pos").cast("decimal(38,0)") * F.col("before.n"))
        if ranges == 1 or crossed.isEmpty():
            return pools
        pools, turn = pools.drop("range"), turn + 1


@dataclass(frozen=True)
class Isotonic:
    """Stored pools: low, high, value, and low and value of the next pool (null for the last)."""

    pools: DataFrame


def fit_calibrator(scored: DataFrame, score: str = "score", range_rows: int = RANGE_ROWS) -> Isotonic:
    """Isotonic regression of label on score; rows without a score are left out."""
    points = scored.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.sum("label").cast("bigint").alias("pos"), F.count("*").alias("n"))
    pools = isotonic_pools(points, range_rows)
    following = _ends(pools).select("range", F.lead("first").over(Window.orderBy("range")).alias("following"))
    inside = Window.partitionBy("range").orderBy("low")
    known = pools.withColumn("next", F.lead(F.struct("low", "pos", "n")).over(inside)).join(following, "range")
    known = known.withColumn("next", F.coalesce("next", "following"))
    return Isotonic(materialize(known.select(
        "low", "high", (F.col("pos") / F.col("n")).alias("value"), F.col("next.low").alias("next_low"),
        (F.col("next.pos") / F.col("next.n")).alias("next_value")), "calibration"))


def calibrate(model: Isotonic, scored: DataFrame, score: str = "score", most_sent: int = MOST_SENT) -> DataFrame:
    """Adds ``calibrated``: the pool's rate, between pools the straight line, outside the nearest pool's rate.

    A checked, small number of pools goes to every task. A larger one is ranked together with the rows, and each row joined
    with the pool before it. Without any pool, and for a null score, ``calibrated`` is null.
    """
    if fits(model.pools, most_sent):
        return _by_lookup(model, scored, score)
    return _by_rank(model, scored, score)


def _by_lookup(model: Isotonic, scored: DataFrame, score: str) -> DataFrame:
    bounds = model.pools.select("low", "high", "value").toArrow().to_pydict()
    order = np.argsort(bounds["low"]) if bounds["low"] else []
    low, high, value = (np.array(bounds[c])[order] for c in ("low", "high", "value")) if len(order) else (np.empty(0),) * 3
    inner = np.stack([np.ones(len(low), bool), high > low], axis=1).ravel()  # a pool of one score is one knot
    knots = np.stack([low, high], axis=1).ravel()[inner], np.repeat(value, 2)[inner]
    shared = scored.sparkSession.sparkContext.broadcast(knots)
    at = scored.columns.index(score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = shared.value
        for batch in batches:
            given = batch.column(at).cast(pa.float64())
            values = given.to_numpy(zero_copy_only=False).astype(np.float64)
            unknown = np.isnan(values) if len(xs) else np.ones(len(values), bool)
            found = np.interp(values, xs, ys) if len(xs) else np.zeros(len(values))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, mask=unknown)], names=[*batch.schema.names, "calibrated"])

    return scored.mapInArrow(run, StructType([f for f in scored.schema.fields]).add("calibrated", DoubleType()))


def _by_rank(model: Isotonic, scored: DataFrame, score: str) -> DataFrame:
    pools = model.pools.select(F.struct("low", "high", "value", "next_low", "next_value").alias("pool"))
    kept = [F.col(f"`{c}`") for c in scored.columns]
    rows = scored.select(F.struct(*kept).alias("row"), F.col(score).cast("double").alias("s"), F.lit(None).cast(pools.schema["pool"].dataType).alias("pool"))
    both = rows.union(pools.select(F.lit(None).cast(rows.schema["row"].dataType), F.col("pool.low"), "pool"))
    both = both.withColumns({"pools": F.col("pool").isNotNull().cast("bigint"), "tie": F.monotonically_increasing_id()})
    ranked = materialize(running_totals(both, [], [F.asc("s"), F.desc("pools"), F.asc("tie")], ["pools"]), "ranked-scores")
    at = ranked.filter("pool is not null").select(F.col("pools_upto").alias("at"), "pool")
    asked = ranked.filter("pool is null").select("row", "s", F.greatest("pools_upto", F.lit(1)).alias("at"))
    x, p = F.col("s"), "pool."
    slope = (F.col(p + "next_value") - F.col(p + "value")) / (F.col(p + "next_low") - F.col(p + "high"))
    value = F.when(x.isNull() | F.isnan(x), None).when((x <= F.col(p + "high")) | F.col(p + "next_low").isNull(), F.col(p + "value")).otherwise(
        F.col(p + "value") + slope * (x - F.col(p + "high")))
    return asked.join(at, "at", "left").select("row.*", value.alias("calibrated"))


def calibration_report(scored: DataFrame) -> DataFrame:
    """Log loss and mean probability before and after calibration, with the true rate."""
    return scored.agg(
        log_loss_of("score").alias("log_loss_before"),
        log_loss_of("calibrated").alias("log_loss_after"),
        F.avg("score").alias("mean_prob_before"),
        F.avg("calibrated").alias("mean_prob_after"),
        F.avg("label").alias("true_rate"),
    )
