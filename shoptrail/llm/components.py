"""Connected components of an edge list that stays distributed, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.session import materialize

# A node's larger neighbours are looked up in as many tasks.
SALTS = 16


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _tidy(a: Column, b: Column, edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least neighbour of that node.

    A node that is the least of its own neighbourhood changes nothing, so only the others that have larger neighbours are
    looked up, each by ``SALTS`` keys: the edges of a hub never meet in one task.
    """
    lower = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    lower = lower.join(edges.select(F.col("b").alias("node")).distinct(), "node", "left_semi")
    lower = lower.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    found = salted.join(lower, (salted["b"] == lower["node"]) & (salted["salt"] == lower["salt"]), "left")
    return _tidy(F.col("a"), F.coalesce("least", "b"), found.select("a", "b", "least"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, are linked to its least neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select("b", "least")
    return _tidy(F.col("b"), F.col("least"), moved.union(least.select("a", "least")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns a, b); a component is named after its least node.

    Nodes should be integers: their least ones are then found by hash aggregation. Large-star links every larger neighbour
    of a node to the least neighbour, small-star does so with the smaller ones, until only stars around the least nodes are left: a
    logarithmic number of rounds. Each round is written to the shared folder, so it neither grows the lineage nor depends on the
    executors that made it. Nothing but a count and a checksum reaches the driver. Loops and repeated edges are ignored; no
    edges give no rows.
    """
    edges = materialize(_tidy(F.col("a"), F.col("b"), edges), "edges")
    before = _state(edges)
    while before[0]:
        edges = materialize(_small_star(materialize(_large_star(edges), "edges")), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
