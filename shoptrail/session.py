"""Session settings, and tables written to the cluster's shared folder to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions at run time, splits join partitions that one heavy
# shopper makes large (even if that costs one more shuffle), and turns a join into a broadcast
# join only after the size of the small side has been measured. The advisory size is of compressed shuffle bytes;
# sorted and aggregated they take up to 40 times as much memory.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# It only ever merges partitions, so a large job starts from many of them.
LARGE_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
}


def build_session(app: str = "shoptrail", **conf: str) -> SparkSession:
    """A session with the settings above; on a cluster the master comes from spark-submit.

    ``conf`` overrides them, for instance the initial number of partitions for small data.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME_CONF, **LARGE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that somebody else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so there it is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="shoptrail-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


_SCOPES: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    path = f"{work_dir(spark)}/shoptrail/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that were materialized inside it; their readers must be done by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, if it is there."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(name, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages then neither recompute it nor depend on the executors that made it, and Spark
    knows its size from the files.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], Sequence[DataFrame]], *labels: str) -> list[DataFrame]:
    """The tables that ``make`` returns, written one after the other; what was materialized on the way to them is removed.

    Spark deletes shuffle files when the JVM has collected the plans they belong to, so it is asked to collect.
    """
    paths, schemas = [fresh_path(spark, label) for label in labels], []
    with temporary_tables(spark):
        for df, path in zip(make(), paths, strict=True):
            df.write.parquet(path)
            schemas.append(df.schema)
        del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return [spark.read.schema(schema).parquet(path) for schema, path in zip(schemas, paths)]


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows: a count from the file footers of a materialized table."""
    return df.count() <= rows
