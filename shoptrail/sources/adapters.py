"""Event logs derived from order and activity tables.

``shopper_log`` reads order lines as shopping events: the line status is the behaviour, the part
its product, the account and basket position the shopper, the order the session. Some fields are
missing and some lines are delivered twice, as in a real log.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.config import Settings
from shoptrail.functions.columns import empty_to_null

SHOPPER_SETTINGS = Settings(
    cutoff=datetime(1998, 7, 1),
    target_end=datetime(1998, 9, 1),
    windows=(("30d", None), ("14d", datetime(1998, 1, 1)), ("7d", datetime(1998, 4, 1))),
    categories=("standard", "medium", "large", "promo"),
)
ACTIVITY_SETTINGS = Settings(
    cutoff=datetime(2024, 1, 25),
    target_end=datetime(2024, 1, 25, 12),
    windows=(("30d", None), ("14d", datetime(2024, 1, 11)), ("7d", datetime(2024, 1, 18))),
    categories=tuple(f"c{i}" for i in range(8)),
)


def _spread(table: DataFrame, key: str) -> DataFrame:
    """Use all cores on a table that is stored in fewer splits than there are cores.

    A table of many files or row groups is left as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table


def shopper_log(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem, orders and part as an event log. Join strategies are left to Spark."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_brand", "p_type", "p_size")
    lines = _spread(lines, "l_orderkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey)

    kind = F.when(F.col("l_returnflag") == "N", "view").when(F.col("l_returnflag") == "A", "cart").otherwise("purchase")
    top = F.lower("p_type")
    code = F.when((F.col("p_type") == "SMALL") | (F.col("l_tax") == 0.05), F.lit(None).cast("string"))
    code = code.when(F.col("p_size") < 10, top)
    code = code.otherwise(F.concat(top, F.lit("."), F.replace(F.lower("p_brand"), F.lit("#"), F.lit(""))))
    brand = F.when(F.col("p_brand") == "Brand#1", F.lit(None).cast("string"))
    brand = brand.when(F.col("p_brand") == "Brand#2", F.lit("")).otherwise(F.col("p_brand"))
    deliveries = F.when(F.col("l_discount") == 0.0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0)))
    rows = joined.withColumn("factor", F.explode(deliveries))
    return rows.select(
        F.expr("o_orderdate + make_dt_interval(0, cast(l_quantity AS int))").alias("event_time"),
        kind.alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_size").cast("bigint").alias("category_id"),
        code.alias("category_code"),
        empty_to_null(brand).alias("brand"),
        (F.col("l_extendedprice") / F.col("l_quantity") * F.col("factor")).alias("price"),
        (F.col("o_custkey") * 10 + F.col("l_linenumber")).alias("user_id"),
        F.when(F.col("l_tax") != 0.08, F.col("o_orderkey").cast("string")).alias("user_session"),
    )


def activity_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as an event log: sub-second times, five behaviours, clicks as carts."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    key = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))
    group = F.floor(key / 10).cast("string")
    return events.select(
        F.col("ts").alias("event_time"),
        kind.alias("event_type"),
        F.col("event_id").alias("product_id"),
        key.alias("category_id"),
        F.concat(F.lit("c"), group, F.lit("."), key.cast("string")).alias("category_code"),
        F.lit(None).cast("string").alias("brand"),
        F.col("value").alias("price"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("user_session"),
        F.concat(F.lit("c"), group).alias("category_l1"),
    )
