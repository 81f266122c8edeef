"""The register of queries, the tables they start from, and the same tables as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.functions.columns import in_period, is_kind
from shoptrail.operators.population import label_pairs, labelled_scaffold
from shoptrail.plans.prepare import clean_log
from shoptrail.session import materialize, tune
from shoptrail.sources.adapters import ACTIVITY_SETTINGS, SHOPPER_SETTINGS, activity_log, shopper_log

CFG = SHOPPER_SETTINGS
ACT = ACTIVITY_SETTINGS
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None, ctes: str = "") -> Callable[[Query], Query]:
    """Register a query under ``name``; ``ctes`` names the shared tables that ``sql`` needs."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return query(tune(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql, ctes.split())
        return query

    return register


# --- starting tables ----------------------------------------------------------------------------


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return shopper_log(spark, folder)


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_log(shopper_log(spark, folder))


def stored_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw log parsed once into a table, for reports that scan it column by column."""
    return materialize(raw(spark, folder), "events")


def stored_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The clean log as a written table, for queries that read it more than once."""
    return materialize(clean(spark, folder), "clean")


def activity(spark: SparkSession, folder: str) -> DataFrame:
    return activity_log(spark, folder)


def pseudo_score() -> F.Column:
    """A repeatable score with many ties, 0 and 1 included, that any engine can compute."""
    text = F.concat_ws(":", F.col(USER_KEY).cast("string"), F.col(CATEGORY))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 201) / 200.0


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Every user of the clean log with every category: label, earlier views, pseudo-score."""
    events = clean(spark, folder)
    seen = F.count_if(is_kind("view") & in_period(end=CFG.cutoff))
    before = F.max(in_period(end=CFG.cutoff))
    users = events.groupBy(USER_KEY).agg(F.when(before, seen).alias("total_views_30d"))
    rows = labelled_scaffold(users, label_pairs(events, CFG), CFG.categories)
    return rows.withColumn("score", pseudo_score())


def stored_scores(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(scored(spark, folder), "scored")


# --- the same tables as SQL ---------------------------------------------------------------------

# Added before rounding: an exact half then goes up in every engine.
NUDGE = 1e-9

_C, _E = CFG.cutoff.date(), CFG.target_end.date()
_W14, _W7 = (start.date() for _, start in CFG.windows[1:])
_IN_WINDOW = f"event_type = 'purchase' AND event_time >= TIMESTAMP '{_C}' AND event_time < TIMESTAMP '{_E}'"
_CATS = "[" + ", ".join(f"'{c}'" for c in CFG.categories) + "]"


def _kinds(template: str) -> str:
    return ",\n ".join(template.format(k=k) for k in ("view", "cart", "purchase"))


def _counts(suffix: str) -> str:
    return _kinds("CAST(count(*) FILTER (event_type = '{k}') AS BIGINT) AS {k}s_" + suffix)


TABLES: dict[str, tuple[str, str]] = {
    # name: (needed tables, SQL)
    "raw": (
        "",
        """
SELECT o_orderdate + to_hours(CAST(l_quantity AS BIGINT)) AS event_time,
 CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'cart' ELSE 'purchase' END AS event_type,
 l_partkey AS product_id, CAST(p_size AS BIGINT) AS category_id,
 CASE WHEN p_type = 'SMALL' OR l_tax = 0.05 THEN NULL WHEN p_size < 10 THEN lower(p_type)
  ELSE lower(p_type) || '.' || replace(lower(p_brand), '#', '') END AS category_code,
 CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN NULL ELSE p_brand END AS brand,
 l_extendedprice / l_quantity
  * unnest(CASE WHEN l_discount = 0 THEN [CAST(1 AS DOUBLE), CAST(2 AS DOUBLE)] ELSE [CAST(1 AS DOUBLE)] END) AS price,
 o_custkey * 10 + l_linenumber AS user_id,
 CASE WHEN l_tax <> 0.08 THEN CAST(o_orderkey AS VARCHAR) END AS user_session
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    ),
    "clean": (
        "raw",
        """
SELECT * EXCLUDE (copy), split_part(category_code, '.', 1) AS category_l1 FROM (
 SELECT *, row_number() OVER (PARTITION BY event_time, user_id, event_type, product_id, user_session
  ORDER BY price, brand NULLS FIRST, category_code, category_id) AS copy
 FROM raw WHERE category_code IS NOT NULL AND user_session IS NOT NULL
  AND user_id IN (SELECT user_id FROM raw WHERE event_type = 'view'))
WHERE copy = 1""",
    ),
    "act": (
        "",
        """
SELECT ts AS event_time, CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
 event_id AS product_id, k AS category_id, 'c' || (k // 10) || '.' || k AS category_code,
 CAST(NULL AS VARCHAR) AS brand, value AS price, user_id,
 user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS user_session, 'c' || (k // 10) AS category_l1
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
    ),
    "past": ("clean", f"SELECT * FROM clean WHERE event_time < TIMESTAMP '{_C}'"),
    "pairs": ("clean", f"SELECT DISTINCT user_id, category_l1 FROM clean WHERE {_IN_WINDOW}"),
    "flags": (
        "clean",
        f"""
SELECT user_id, bool_or({_IN_WINDOW}) AS purchaser, bool_or(event_time < TIMESTAMP '{_C}') AS active_before
FROM clean GROUP BY user_id""",
    ),
    "pool": (
        "flags",
        """
SELECT user_id, purchaser, active_before FROM (
 SELECT *, row_number() OVER (PARTITION BY purchaser ORDER BY md5('42:pool:' || user_id), user_id) AS turn FROM flags)
WHERE purchaser OR turn <= 3 * (SELECT count(*) FROM flags WHERE purchaser)""",
    ),
    "splits": (
        "pool",
        """
SELECT user_id, CASE WHEN row_number() OVER (ORDER BY md5('42:train:' || user_id), user_id)
  <= floor((SELECT count(*) FROM pool) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM pool""",
    ),
    "labelled": (
        "splits pairs",
        f"""
SELECT s.user_id, s.split, s.category_l1, CAST(p.user_id IS NOT NULL AS INTEGER) AS label
FROM (SELECT user_id, split, unnest({_CATS}) AS category_l1 FROM splits) s
LEFT JOIN pairs p ON p.user_id = s.user_id AND p.category_l1 = s.category_l1""",
    ),
    "parts": (
        "labelled",
        """
SELECT *, CASE WHEN split = 'test' THEN 'test' WHEN user_id IN (
  SELECT user_id FROM (SELECT user_id, row_number() OVER (ORDER BY md5('42:validation:' || user_id), user_id) AS turn,
    count(*) OVER () AS n FROM (SELECT DISTINCT user_id FROM labelled WHERE split = 'train'))
  WHERE turn <= floor(n * CAST(0.2 AS DOUBLE))) THEN 'validation' ELSE 'pool' END AS part
FROM labelled""",
    ),
    "prior": (
        "parts",
        "SELECT category_l1, avg(label) AS cat_purchase_rate FROM parts WHERE part = 'pool' GROUP BY category_l1",
    ),
    "counts_30d": ("past", f"SELECT user_id, category_l1, {_counts('30d')} FROM past GROUP BY ALL"),
    "counts_14d": (
        "past",
        f"SELECT user_id, category_l1, {_counts('14d')} FROM past WHERE event_time >= TIMESTAMP '{_W14}' GROUP BY ALL",
    ),
    "counts_7d": (
        "past",
        f"SELECT user_id, category_l1, {_counts('7d')} FROM past WHERE event_time >= TIMESTAMP '{_W7}' GROUP BY ALL",
    ),
    "windows": (
        "counts_30d counts_14d counts_7d",
        """
SELECT * FROM counts_30d LEFT JOIN counts_14d USING (user_id, category_l1)
LEFT JOIN counts_7d USING (user_id, category_l1)""",
    ),
    "recency": (
        "past",
        "SELECT user_id, category_l1, "
        + _kinds(
            f"date_sub('day', max(event_time) FILTER (event_type = '{{k}}'), TIMESTAMP '{_C}') AS days_since_{{k}}"
        )
        + " FROM past GROUP BY ALL",
    ),
    "engagement": (
        "past",
        "SELECT user_id, "
        + _kinds("CAST(count(*) FILTER (event_type = '{k}') AS BIGINT) AS total_{k}s_30d")
        + """,
 count(DISTINCT CAST(event_time AS DATE)) AS active_days_30d, count(DISTINCT category_l1) AS category_breadth_30d,
 count(DISTINCT user_session) AS session_count_30d FROM past GROUP BY user_id""",
    ),
    "brands": (
        "past",
        """
SELECT user_id, category_l1, count(DISTINCT brand) AS brand_count_30d FROM past WHERE brand IS NOT NULL GROUP BY ALL""",
    ),
    "prices": (
        "past",
        """
SELECT user_id, category_l1, avg(price) FILTER (event_type = 'view') AS avg_price_viewed_30d,
 avg(price) FILTER (event_type = 'cart') AS avg_price_carted_30d FROM past GROUP BY ALL""",
    ),
    "joined": (
        "labelled windows recency engagement brands prices",
        """
SELECT * FROM labelled LEFT JOIN windows USING (user_id, category_l1) LEFT JOIN recency USING (user_id, category_l1)
LEFT JOIN engagement USING (user_id) LEFT JOIN brands USING (user_id, category_l1)
LEFT JOIN prices USING (user_id, category_l1)""",
    ),
    "matrix": (
        "joined",
        "SELECT user_id, split, category_l1, label, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in CFG.count_columns)
        + ", " + ", ".join([*CFG.recency_columns, *CFG.user_columns, CFG.brand_column])
        + ", " + ", ".join(f"round({c} + {NUDGE}, 4) AS {c}" for c in CFG.price_columns)
        + ", " + ", ".join(
            f"round(carts_{s} / CASE WHEN views_{s} < 1 THEN 1 ELSE views_{s} END + {NUDGE}, 6) AS cart_view_ratio_{s}"
            for s in ("30d", "7d")
        )
        + " FROM joined",
    ),
    "scored": (
        "clean pairs",
        f"""
SELECT u.user_id, u.category_l1, CAST(p.user_id IS NOT NULL AS INTEGER) AS label, total_views_30d,
 (CAST('0x' || substr(md5(u.user_id || ':' || u.category_l1), 1, 8) AS BIGINT) % 201) / CAST(200 AS DOUBLE) AS score
FROM (SELECT user_id, unnest({_CATS}) AS category_l1, total_views_30d FROM (
  SELECT user_id, CASE WHEN bool_or(event_time < TIMESTAMP '{_C}') THEN CAST(count(*) FILTER (
   event_type = 'view' AND event_time < TIMESTAMP '{_C}') AS BIGINT) END AS total_views_30d
  FROM clean GROUP BY user_id)) u
LEFT JOIN pairs p ON p.user_id = u.user_id AND p.category_l1 = u.category_l1""",
    ),
    "temps": (
        "scored",
        "SELECT *, CASE WHEN coalesce(total_views_30d, 0) = 0 THEN 'cold' ELSE 'warm' END AS slice FROM scored",
    ),
    "sliced": ("scored", "SELECT *, unnest([category_l1, 'overall']) AS slice FROM scored"),
}


def with_tables(sql: str, names: list[str]) -> str:
    """``sql`` preceded by the shared tables it uses, in order of dependence."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name not in ordered:
            for other in TABLES[name][0].split():
                need(other)
            ordered.append(name)

    for name in names:
        need(name)
    if not ordered:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n][1]})" for n in ordered) + "\n" + sql.strip()
