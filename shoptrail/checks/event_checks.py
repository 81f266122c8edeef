"""Sources, row expressions, cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.checks.base import _C, _E, ACT, CFG, activity, check, clean, raw, stored_raw
from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.functions import columns as X
from shoptrail.operators import cleaning, profiling
from shoptrail.operators.population import overlapping_users
from shoptrail.plans.prepare import clean_events
from shoptrail.schemas import EVENT_RAW
from shoptrail.session import fresh_path
from shoptrail.sources.events import read_csv_log, read_log, write_log
from shoptrail.sources.tables import literal_table, schema_table

# --- sources and sinks ----------------------------------------------------------------------------

# Product and user numbers of the given tables are longs.
WIDE_RAW = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name in ("product_id", "user_id") else f.dataType)
        for f in EVENT_RAW.fields
    ]
)
TYPED = """event_time, event_type, product_id, category_id, category_code, brand,
 round(CAST(CAST(price AS FLOAT) AS DOUBLE), 3) AS price, user_id, user_session"""


def text_time():
    """The event time as it is delivered: text with a trailing zone."""
    return F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def _csv_round_trip(spark, folder, parts: int):
    """The raw log as delivered text, in as many folders as there are deliveries."""
    text = raw(spark, folder).withColumn("event_time", text_time()).select(*[f.name for f in WIDE_RAW.fields])
    paths = []
    for part in range(parts):
        paths.append(fresh_path(spark, "csv"))
        mine = X.in_period(end=CFG.cutoff) if part == 0 else X.in_period(start=CFG.cutoff)
        rows = text if parts == 1 else text.filter(mine)
        rows.write.option("header", True).csv(paths[-1])
    return read_csv_log(spark, paths, WIDE_RAW).withColumn("price", F.round(F.col("price").cast("double"), 3))


@check("s1_csv_scan", f"SELECT {TYPED} FROM raw", "raw")
def s1(spark, folder):
    return _csv_round_trip(spark, folder, 1)


@check("u4_multi_file_scan", f"SELECT {TYPED} FROM raw", "raw")
def u4(spark, folder):
    return _csv_round_trip(spark, folder, 2)


@check("s2_parquet_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s2(spark, folder):
    return read_log(spark, f"{folder}/events.parquet")


@check("s3_parquet_sink", "SELECT * FROM raw", "raw")
def s3(spark, folder):
    path = fresh_path(spark, "log")
    write_log(raw(spark, folder), path)
    return read_log(spark, path)


@check(
    "s10_literal_table",
    """
SELECT category_l1, count(*) AS rows FROM clean WHERE category_l1 IN ('standard', 'medium', 'large', 'promo')
GROUP BY category_l1""",
    "clean",
)
def s10(spark, folder):
    names = literal_table(spark, [(c,) for c in CFG.categories], f"{CATEGORY} string")
    return clean(spark, folder).groupBy(CATEGORY).agg(F.count("*").alias("rows")).join(names, CATEGORY, "left_semi")


_TYPES = {"event_time": "timestamp_ntz", "event_type": "string", "product_id": "bigint", "category_id": "bigint",
          "category_code": "string", "brand": "string", "price": "double", "user_id": "bigint", "user_session": "string"}


@check(
    "s11_schema",
    " UNION ALL ".join(f"SELECT '{n}' AS name, '{t}' AS type, count({n}) AS known FROM raw" for n, t in _TYPES.items()),
    "raw",
)
def s11(spark, folder):
    return schema_table(spark, raw(spark, folder), with_counts=True)


# --- row expressions ------------------------------------------------------------------------------


@check("p1_strip_utc", "SELECT user_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS text FROM raw", "raw")
def p1(spark, folder):
    return raw(spark, folder).select(USER_KEY, X.strip_utc(text_time()).alias("text"))


@check("p2_parse_time", "SELECT user_id, event_time FROM raw", "raw")
def p2(spark, folder):
    return raw(spark, folder).select(USER_KEY, X.parse_event_time(text_time()).alias("event_time"))


@check("p3_empty_to_null", "SELECT l_orderkey, nullif(replace(l_returnflag, 'R', ''), '') AS flag FROM lineitem")
def p3(spark, folder):
    lines = read_log(spark, f"{folder}/lineitem.parquet")
    blanked = F.replace("l_returnflag", F.lit("R"), F.lit(""))
    return lines.select("l_orderkey", X.empty_to_null(blanked).alias("flag"))


@check(
    "p4_complete_rows",
    "SELECT * FROM raw WHERE category_code IS NOT NULL AND user_session IS NOT NULL",
    "raw",
)
def p4(spark, folder):
    return cleaning.drop_incomplete(raw(spark, folder))


@check("p5_type_filter", "SELECT user_id, event_time FROM raw WHERE event_type = 'view'", "raw")
def p5(spark, folder):
    return raw(spark, folder).filter(X.is_kind("view")).select(USER_KEY, "event_time")


@check(
    "p6_label_window_filter",
    f"""
SELECT user_id, event_time, product_id FROM raw
WHERE event_type = 'purchase' AND event_time >= TIMESTAMP '{_C}' AND event_time < TIMESTAMP '{_E}'""",
    "raw",
)
def p6(spark, folder):
    wanted = X.is_kind("purchase") & X.in_period(CFG.cutoff, CFG.target_end)
    return raw(spark, folder).filter(wanted).select(USER_KEY, "event_time", "product_id")


@check("p7_before_cutoff", f"SELECT user_id, event_time FROM raw WHERE event_time < TIMESTAMP '{_C}'", "raw")
def p7(spark, folder):
    return raw(spark, folder).filter(X.in_period(end=CFG.cutoff)).select(USER_KEY, "event_time")


@check("p8_since_start", "SELECT user_id, event_time FROM raw WHERE event_time >= TIMESTAMP '1998-01-01'", "raw")
def p8(spark, folder):
    return raw(spark, folder).filter(X.in_period(CFG.windows[1][1])).select(USER_KEY, "event_time")


@check("p9_branded", "SELECT user_id, brand FROM raw WHERE brand IS NOT NULL", "raw")
def p9(spark, folder):
    return raw(spark, folder).filter(F.col("brand").isNotNull()).select(USER_KEY, "brand")


@check(
    "p10_kept_categories",
    "SELECT user_id, category_l1 FROM clean WHERE category_l1 IN ('standard', 'medium', 'large', 'promo')",
    "clean",
)
def p10(spark, folder):
    return clean(spark, folder).filter(F.col(CATEGORY).isin(list(CFG.categories))).select(USER_KEY, CATEGORY)


@check("p12_category_l1", "SELECT product_id, split_part(category_code, '.', 1) AS category_l1 FROM raw", "raw")
def p12(spark, folder):
    return raw(spark, folder).select("product_id", X.top_level(F.col("category_code")).alias(CATEGORY))


@check(
    "p13_category_l2",
    "SELECT product_id, nullif(split_part(category_code, '.', 2), '') AS category_l2 FROM raw",
    "raw",
)
def p13(spark, folder):
    return raw(spark, folder).select("product_id", X.second_level(F.col("category_code")).alias("category_l2"))


@check("p14_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def p14(spark, folder):
    return read_log(spark, f"{folder}/events.parquet").select("event_id", F.to_date("ts").alias("day"))


@check("p15_instant_literal", f"SELECT event_id, ts < TIMESTAMP '{ACT.cutoff}' AS before FROM events")
def p15(spark, folder):
    events = read_log(spark, f"{folder}/events.parquet")
    return events.select("event_id", (F.col("ts") < X.instant(ACT.cutoff)).alias("before"))


@check("p16_elapsed_days", f"SELECT event_id, date_sub('day', ts, TIMESTAMP '{ACT.cutoff}') AS days FROM events")
def p16(spark, folder):
    events = read_log(spark, f"{folder}/events.parquet")
    return events.select("event_id", X.elapsed_days(F.col("ts"), X.instant(ACT.cutoff)).alias("days"))


@check(
    "p17_fill_null",
    "SELECT user_id, coalesce(brand, 'none') AS brand, coalesce(category_code, 'none') AS category_code FROM raw",
    "raw",
)
def p17(spark, folder):
    return raw(spark, folder).select(USER_KEY, "brand", "category_code").fillna("none", ["brand", "category_code"])


@check(
    "p20_percent",
    """
SELECT event_type, round(count(*) FILTER (brand IS NULL) / CAST(count(*) AS DOUBLE) * 100, 2) AS brand_null_pct
FROM raw GROUP BY event_type""",
    "raw",
)
def p20(spark, folder):
    share = X.percent(F.count_if(F.col("brand").isNull()), F.count("*"))
    return raw(spark, folder).groupBy("event_type").agg(share.alias("brand_null_pct"))


@check("p21_round", "SELECT event_id, round(value / 3, 4) AS four, round(value / 3, 6) AS six FROM events")
def p21(spark, folder):
    third = F.col("value") / 3
    events = read_log(spark, f"{folder}/events.parquet")
    return events.select("event_id", F.round(third, 4).alias("four"), F.round(third, 6).alias("six"))


@check(
    "p23_select_drop_alias",
    "SELECT event_time AS at, event_type, user_id, product_id FROM raw",
    "raw",
)
def p23(spark, folder):
    dropped = raw(spark, folder).drop("category_id", "category_code", "brand", "price", "user_session")
    return dropped.withColumnRenamed("event_time", "at")


@check(
    "p25_lossy_number",
    "SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 25 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS v FROM part",
)
def p25(spark, folder):
    text = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.col("p_size").cast("string"))
    return read_log(spark, f"{folder}/part.parquet").select("p_partkey", text.try_cast("double").alias("v"))


# --- cleaning -------------------------------------------------------------------------------------


@check(
    "j1_view_users_semi",
    """
SELECT * EXCLUDE (seen) FROM (SELECT *, bool_or(event_type = 'view') OVER (PARTITION BY user_id) AS seen FROM raw)
WHERE seen AND user_id IS NOT NULL""",
    "raw",
)
def j1(spark, folder):
    events = stored_raw(spark, folder)
    return cleaning.keep_view_users(events, events)


@check(
    "j2_purchase_only_anti",
    """
SELECT DISTINCT user_id FROM raw WHERE event_type = 'purchase'
 AND user_id NOT IN (SELECT user_id FROM raw WHERE event_type = 'view')""",
    "raw",
)
def j2(spark, folder):
    return profiling.purchase_only_users(raw(spark, folder))


@check(
    "j1_rows_of_purchase_only_users",
    """
SELECT count(*) AS rows FROM raw WHERE user_id IN (SELECT user_id FROM raw WHERE event_type = 'purchase')
 AND user_id NOT IN (SELECT user_id FROM raw WHERE event_type = 'view')""",
    "raw",
)
def j1_rows(spark, folder):
    events = raw(spark, folder)
    return profiling.rows_of_users(events, profiling.purchase_only_users(events))


@check("a11_distinct_users", "SELECT DISTINCT user_id FROM raw WHERE event_type = 'view'", "raw")
def a11(spark, folder):
    return cleaning.view_users(raw(spark, folder))


@check(
    "a12_dedup",
    """
SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (
  PARTITION BY event_time, user_id, event_type, product_id, user_session
  ORDER BY price, brand NULLS FIRST, category_code NULLS FIRST, category_id) AS copy FROM raw) WHERE copy = 1""",
    "raw",
)
def a12(spark, folder):
    return cleaning.drop_duplicates(raw(spark, folder))


@check("c1_clean_events", "SELECT * FROM clean", "clean")
def c1(spark, folder):
    return clean_events(stored_raw(spark, folder), CFG)


@check("c1_clean_lazy", "SELECT * FROM clean", "clean")
def c1_lazy(spark, folder):
    return clean(spark, folder)


# --- category recovery ------------------------------------------------------------------------------

_FIRST = """
SELECT {key}, category_code FROM (SELECT {key}, category_code, row_number() OVER (
  PARTITION BY {key} ORDER BY event_time, category_code) AS turn FROM raw WHERE category_code IS NOT NULL)
WHERE turn = 1"""
# The same code beside every row, from one reading of the log.
_KNOWN = """
SELECT *, first_value(category_code) OVER (PARTITION BY product_id ORDER BY category_code IS NULL, event_time, category_code
 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS known FROM raw"""
_REPORT = """
SELECT CAST(count(*) AS BIGINT) AS total_null, CAST(count(k.{key}) AS BIGINT) AS recoverable,
 CAST(count(*) - count(k.{key}) AS BIGINT) AS unrecoverable,
 round(count(k.{key}) / CAST(count(*) AS DOUBLE) * 100, 1) AS recoverable_pct,
 round((count(*) - count(k.{key})) / CAST(count(*) AS DOUBLE) * 100, 1) AS unrecoverable_pct
FROM (SELECT * FROM raw WHERE event_type = 'purchase' AND category_code IS NULL) r
LEFT JOIN (""" + _FIRST + ") k ON r.{key} = k.{key}"


@check("a13_first_code_by_product", _FIRST.format(key="product_id"), "raw")
def a13_product(spark, folder):
    return cleaning.first_known_code(raw(spark, folder), "product_id")


@check("a13_first_code_by_category_id", _FIRST.format(key="category_id"), "raw")
def a13_id(spark, folder):
    return cleaning.first_known_code(raw(spark, folder), "category_id")


@check("a21_recovery_by_product", _REPORT.format(key="product_id"), "raw")
def a21_product(spark, folder):
    return cleaning.recovery_report(raw(spark, folder), "product_id")


@check("a21_recovery_by_category_id", _REPORT.format(key="category_id"), "raw")
def a21_id(spark, folder):
    return cleaning.recovery_report(raw(spark, folder), "category_id")


@check(
    "j6_recoverable_rows",
    f"""
SELECT product_id, known AS category_code FROM ({_KNOWN})
WHERE event_type = 'purchase' AND category_code IS NULL AND known IS NOT NULL""",
    "raw",
)
def j6(spark, folder):
    events = stored_raw(spark, folder)
    lost = cleaning.uncategorised_purchases(events).select("product_id")
    return lost.join(cleaning.first_known_code(events, "product_id"), "product_id")


@check(
    "j2_unrecoverable_rows",
    f"SELECT product_id FROM ({_KNOWN}) WHERE event_type = 'purchase' AND category_code IS NULL AND known IS NULL",
    "raw",
)
def j2_lost(spark, folder):
    events = stored_raw(spark, folder)
    lost = cleaning.uncategorised_purchases(events).select("product_id")
    return lost.join(cleaning.first_known_code(events, "product_id"), "product_id", "left_anti")


@check(
    "a21_backfill",
    f"SELECT * EXCLUDE (known) REPLACE (coalesce(category_code, known) AS category_code) FROM ({_KNOWN})",
    "raw",
)
def a21_backfill(spark, folder):
    return cleaning.backfill_category(stored_raw(spark, folder), "product_id")


# --- profiling ------------------------------------------------------------------------------------


@check(
    "a6_overview",
    "SELECT count(*) AS total_rows, min(event_time) AS time_min, max(event_time) AS time_max FROM raw",
    "raw",
)
def a6(spark, folder):
    return profiling.overview(raw(spark, folder))


_UNIQUE = {
    "unique_users": "user_id",
    "unique_products": "product_id",
    "unique_sessions": "user_session",
    "unique_brands": "brand",
    "unique_category_codes": "category_code",
}


def _unique_sql(columns: dict[str, str]) -> str:
    return ", ".join(
        f"count(DISTINCT {c}) + CAST(bool_or({c} IS NULL) AS BIGINT) AS {a}" for a, c in columns.items()
    )


@check("a7_distinct_counts", f"SELECT {_unique_sql(_UNIQUE)} FROM raw", "raw")
def a7(spark, folder):
    return profiling.distinct_counts(stored_raw(spark, folder), _UNIQUE)


@check(
    "a7_distinct_levels",
    """
SELECT count(DISTINCT a) + CAST(bool_or(a IS NULL) AS BIGINT) AS unique_l1,
 count(DISTINCT b) + CAST(bool_or(b IS NULL) AS BIGINT) AS unique_l2,
 count(DISTINCT category_code) + CAST(bool_or(category_code IS NULL) AS BIGINT) AS unique_full
FROM (SELECT category_code, split_part(category_code, '.', 1) AS a,
 nullif(split_part(category_code, '.', 2), '') AS b FROM raw)""",
    "raw",
)
def a7_levels(spark, folder):
    names = {"unique_l1": "category_l1", "unique_l2": "category_l2", "unique_full": "category_code"}
    return profiling.distinct_counts(cleaning.add_category_levels(stored_raw(spark, folder)), names)


_RAW_COLUMNS = "event_time event_type product_id category_id category_code brand price user_id user_session".split()


@check(
    "a8_null_counts",
    "SELECT " + ", ".join(f"CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS {c}" for c in _RAW_COLUMNS) + " FROM raw",
    "raw",
)
def a8(spark, folder):
    return profiling.null_counts(raw(spark, folder))


@check(
    "a9_null_percent_by_type",
    """
SELECT event_type,
 round(count(*) FILTER (category_code IS NULL) / CAST(count(*) AS DOUBLE) * 100, 2) AS category_code_null_pct,
 round(count(*) FILTER (brand IS NULL) / CAST(count(*) AS DOUBLE) * 100, 2) AS brand_null_pct
FROM raw GROUP BY event_type""",
    "raw",
)
def a9(spark, folder):
    return profiling.null_percent_by_type(raw(spark, folder), ["category_code", "brand"])


@check(
    "a10_type_shares",
    """
SELECT event_type, count(*) AS count, round(count(*) / CAST((SELECT count(*) FROM raw) AS DOUBLE) * 100, 2) AS pct
FROM raw GROUP BY event_type""",
    "raw",
)
def a10(spark, folder):
    return profiling.share_of_total(raw(spark, folder), "event_type")


@check(
    "a14_duplicate_report",
    """
SELECT CAST(n AS BIGINT) AS total_rows, CAST(u AS BIGINT) AS unique_rows, CAST(n - u AS BIGINT) AS duplicates,
 round((n - u) / CAST(n AS DOUBLE) * 100, 3) AS duplicate_pct
FROM (SELECT (SELECT count(*) FROM raw) AS n, (SELECT count(*) FROM (
 SELECT DISTINCT event_time, user_id, event_type, product_id, user_session FROM raw)) AS u)""",
    "raw",
)
def a14(spark, folder):
    return profiling.duplicate_report(raw(spark, folder))


@check(
    "a15_daily_pivot",
    """
SELECT CAST(event_time AS DATE) AS date,
 CAST(nullif(count(*) FILTER (event_type = 'view'), 0) AS BIGINT) AS view,
 CAST(nullif(count(*) FILTER (event_type = 'cart'), 0) AS BIGINT) AS cart,
 CAST(nullif(count(*) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS purchase
FROM act GROUP BY 1""",
    "act",
)
def a15(spark, folder):
    return profiling.daily_counts(activity(spark, folder))


_FUNNEL = """
SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS unique_users,
 round(count(*) / CAST((SELECT count(*) FROM {t} WHERE event_type = 'view') AS DOUBLE) * 100, 2) AS pct_of_view_events,
 round(count(DISTINCT user_id) / CAST((SELECT count(DISTINCT user_id) FROM {t} WHERE event_type = 'view') AS DOUBLE)
  * 100, 2) AS pct_of_view_users
FROM {t} GROUP BY event_type"""


@check("a16_conversion_funnel", _FUNNEL.format(t="raw"), "raw")
def a16(spark, folder):
    return profiling.conversion_funnel(raw(spark, folder))


@check("a16_activity_funnel", _FUNNEL.format(t="act"), "act")
def a16_activity(spark, folder):
    return profiling.conversion_funnel(activity(spark, folder))


@check(
    "a19_window_purchases",
    f"""
SELECT category_l1, count(*) AS purchases, count(DISTINCT user_id) AS unique_buyers FROM clean
WHERE event_type = 'purchase' AND event_time >= TIMESTAMP '{_C}' AND event_time < TIMESTAMP '{_E}'
GROUP BY category_l1""",
    "clean",
)
def a19(spark, folder):
    return profiling.window_purchases(clean(spark, folder), CFG.cutoff, CFG.target_end)


@check(
    "a20_purchase_null_share",
    """
SELECT count(*) AS total_purchases, CAST(count(*) FILTER (category_code IS NULL) AS BIGINT) AS null_category,
 round(count(*) FILTER (category_code IS NULL) / CAST(count(*) AS DOUBLE) * 100, 2) AS null_pct
FROM raw WHERE event_type = 'purchase'""",
    "raw",
)
def a20(spark, folder):
    return profiling.purchase_null_share(raw(spark, folder))


@check("o1_sorted_type_counts", "SELECT event_type, count(*) AS count FROM act GROUP BY event_type ORDER BY count DESC", "act")
def o1(spark, folder):
    return activity(spark, folder).groupBy("event_type").agg(F.count("*").alias("count")).orderBy(F.desc("count"))


@check("o2_head", "SELECT event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT 5")
def o2(spark, folder):
    events = read_log(spark, f"{folder}/events.parquet")
    return events.select("event_id", "ts", "user_id").orderBy("ts", "event_id").limit(5)


@check(
    "o3_top_categories",
    """
SELECT category_l1, count(*) AS count FROM (SELECT split_part(category_code, '.', 1) AS category_l1 FROM raw)
GROUP BY category_l1 ORDER BY count DESC, category_l1 NULLS FIRST LIMIT 20""",
    "raw",
)
def o3(spark, folder):
    return profiling.top_groups(cleaning.add_category_l1(raw(spark, folder)), CATEGORY)


@check(
    "o3_top_purchased_codes",
    """
SELECT category_code, count(*) AS purchase_count FROM raw WHERE event_type = 'purchase'
GROUP BY category_code ORDER BY purchase_count DESC, category_code NULLS FIRST LIMIT 20""",
    "raw",
)
def o3_purchases(spark, folder):
    bought = raw(spark, folder).filter(X.is_kind("purchase"))
    return profiling.top_groups(bought, "category_code", 20, "purchase_count")


@check(
    "c11_profile_report",
    f"""
SELECT count(*) AS total_rows, min(event_time) AS time_min, max(event_time) AS time_max,
 CAST(count(*) FILTER (category_code IS NULL) AS BIGINT) AS null_category_code,
 CAST(count(*) FILTER (brand IS NULL) AS BIGINT) AS null_brand,
 CAST(count(*) FILTER (user_session IS NULL) AS BIGINT) AS null_user_session,
 {_unique_sql(_UNIQUE)},
 CAST(count(*) - (SELECT count(*) FROM (
  SELECT DISTINCT event_time, user_id, event_type, product_id, user_session FROM raw)) AS BIGINT) AS duplicates
FROM raw""",
    "raw",
)
def c11(spark, folder):
    return profiling.profile_report(stored_raw(spark, folder))


@check(
    "u3_window_overlap",
    f"""
SELECT DISTINCT user_id FROM raw WHERE event_time < TIMESTAMP '{_C}'
 AND user_id IN (SELECT user_id FROM raw WHERE event_time >= TIMESTAMP '{_E}')""",
    "raw",
)
def u3(spark, folder):
    events = raw(spark, folder)
    early = events.filter(X.in_period(end=CFG.cutoff)).select(USER_KEY).distinct()
    late = events.filter(X.in_period(start=CFG.target_end)).select(USER_KEY).distinct()
    return overlapping_users(early, late)
