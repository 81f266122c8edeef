"""Small frames used by several test modules."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

EVENT_COLUMNS = (
    "event_time timestamp_ntz, event_type string, user_id int, category_l1 string, brand string, "
    "price double, user_session string"
)


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


def three_users(spark: SparkSession) -> DataFrame:
    """A shopper active in the last week, one active early in the month, one seen only later."""
    rows = [
        (day("2019-10-28"), "view", 1, "electronics", "acme", 100.0, "s1"),
        (day("2019-10-29"), "view", 1, "electronics", "acme", 100.0, "s1"),
        (day("2019-10-30"), "view", 1, "electronics", "acme", 100.0, "s2"),
        (day("2019-10-30"), "purchase", 1, "electronics", "acme", 100.0, "s2"),
        (day("2019-10-05"), "view", 2, "apparel", "beta", 20.0, "s3"),
        (day("2019-11-02"), "view", 3, "apparel", "gamma", 30.0, "s4"),
    ]
    return spark.createDataFrame(rows, EVENT_COLUMNS)


def random_events(spark: SparkSession, n: int, seed: int, hot_user: bool = False) -> DataFrame:
    """Random events around the default cutoff; with ``hot_user`` a third belong to user 1."""
    draw = random.Random(seed)
    categories = ["electronics", "apparel", "kids", "stationery"]
    rows = []
    for _ in range(n):
        user = 1 if hot_user and draw.random() < 1 / 3 else draw.randint(1, 40)
        at = datetime(2019, 10, 1) + timedelta(seconds=draw.randint(0, 40 * 86400))
        rows.append(
            (
                at,
                draw.choice(["view", "view", "view", "cart", "purchase"]),
                user,
                draw.choice(categories),
                draw.choice(["acme", "beta", None]),
                float(draw.randint(1, 500)),
                f"{user}-{draw.randint(1, 6)}",
            )
        )
    return spark.createDataFrame(rows, EVENT_COLUMNS)


def by_key(df: DataFrame, *key: str) -> dict:
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}
