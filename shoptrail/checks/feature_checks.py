"""Behavioural features: the single groups, the fused form and the matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptrail.checks.base import ACT, CFG, NUDGE, activity, check, clean, stored_clean
from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.functions import columns as X
from shoptrail.operators import behaviour as B
from shoptrail.operators import population as P
from shoptrail.plans.prepare import build_matrix

_PRICES = ", ".join(f"round({c} + {NUDGE}, 4) AS {c}" for c in CFG.price_columns)


def _rounded(rows):
    """Averages and ratios as the SQL rounds them; sums of doubles depend on their order."""
    prices = {c: F.round(F.col(c) + NUDGE, 4) for c in CFG.price_columns if c in rows.columns}
    ratios = {c: F.round(F.col(c) + NUDGE, 6) for c in CFG.ratio_columns if c in rows.columns}
    return rows.withColumns(prices | ratios)


def _past(spark, folder):
    return B.history(clean(spark, folder), CFG)


@check("a1_user_cat_counts", "SELECT * FROM counts_30d", "counts_30d")
def a1(spark, folder):
    return B.pair_counts(_past(spark, folder), "30d")


@check("a1_user_cat_counts_14d", "SELECT * FROM counts_14d", "counts_14d")
def a1_14d(spark, folder):
    return B.pair_counts(_past(spark, folder), *CFG.windows[1])


@check("a1_user_cat_counts_7d", "SELECT * FROM counts_7d", "counts_7d")
def a1_7d(spark, folder):
    return B.pair_counts(_past(spark, folder), *CFG.windows[2])


@check("j7_window_counts", "SELECT * FROM windows", "windows")
def j7(spark, folder):
    return B.pair_window_counts(_past(spark, folder), CFG)


@check("a2_user_cat_recency", "SELECT * FROM recency", "recency")
def a2(spark, folder):
    return B.pair_recency(_past(spark, folder), CFG)


@check(
    "a2_activity_recency",
    "SELECT user_id, category_l1, "
    + ", ".join(
        f"date_sub('day', max(event_time) FILTER (event_type = '{k}'), TIMESTAMP '{ACT.cutoff}') AS days_since_{k}"
        for k in ("view", "cart", "purchase")
    )
    + f" FROM act WHERE event_time < TIMESTAMP '{ACT.cutoff}' GROUP BY ALL",
    "act",
)
def a2_activity(spark, folder):
    return B.pair_recency(B.history(activity(spark, folder), ACT), ACT)


@check("a3_user_cat_prices", f"SELECT user_id, category_l1, {_PRICES} FROM prices", "prices")
def a3(spark, folder):
    return _rounded(B.pair_prices(_past(spark, folder), CFG))


@check("a4_user_cat_brands", "SELECT * FROM brands", "brands")
def a4(spark, folder):
    return B.pair_brands(_past(spark, folder), CFG)


@check("a5_user_engagement", "SELECT * FROM engagement", "engagement")
def a5(spark, folder):
    return B.user_engagement(_past(spark, folder), CFG)


@check(
    "a5_user_profile",
    "SELECT * FROM engagement",
    "engagement",
)
def a5_profile(spark, folder):
    return B.user_profile(_past(spark, folder), CFG).select(USER_KEY, *CFG.user_columns)


@check(
    "c6_fused_pair_activity",
    f"""
SELECT * EXCLUDE (avg_price_viewed_30d, avg_price_carted_30d), {_PRICES}
FROM windows LEFT JOIN recency USING (user_id, category_l1)
LEFT JOIN brands USING (user_id, category_l1) LEFT JOIN prices USING (user_id, category_l1)""",
    "windows recency brands prices",
)
def fused(spark, folder):
    return _rounded(B.pair_activity(_past(spark, folder), CFG))


def _labelled_pairs(events):
    pool = P.build_population(events, CFG).select(USER_KEY, "split")
    return P.labelled_scaffold(pool, P.label_pairs(events, CFG), CFG.categories)


@check("c6_assemble_features", "SELECT * FROM matrix", "matrix")
def c6(spark, folder):
    events = stored_clean(spark, folder)
    past = B.history(events, CFG)
    frames = (
        B.pair_window_counts(past, CFG),
        B.pair_recency(past, CFG),
        B.user_engagement(past, CFG),
        B.pair_brands(past, CFG),
        B.pair_prices(past, CFG),
    )
    return _rounded(B.assemble(_labelled_pairs(events), *frames, CFG))


@check("c6_feature_matrix", "SELECT * FROM matrix", "matrix")
def matrix(spark, folder):
    return _rounded(build_matrix(stored_clean(spark, folder), CFG))


@check(
    "j3_join_pair_features",
    "SELECT user_id, category_l1, label, views_30d, carts_30d, purchases_30d FROM joined",
    "joined",
)
def j3(spark, folder):
    events = stored_clean(spark, folder)
    counts = B.pair_counts(B.history(events, CFG), "30d")
    rows = _labelled_pairs(events).drop("split")
    return rows.join(counts, [USER_KEY, CATEGORY], "left")


@check(
    "j4_join_user_features",
    "SELECT user_id, category_l1, total_views_30d, active_days_30d, session_count_30d FROM joined",
    "joined",
)
def j4(spark, folder):
    events = stored_clean(spark, folder)
    users = B.user_engagement(B.history(events, CFG), CFG)
    rows = _labelled_pairs(events).select(USER_KEY, CATEGORY)
    wanted = ["total_views_30d", "active_days_30d", "session_count_30d"]
    return rows.join(users.select(USER_KEY, *wanted), USER_KEY, "left")


@check(
    "p18_lower_clip",
    "SELECT user_id, category_l1, CASE WHEN views_7d < 1 THEN 1 ELSE views_7d END AS views_7d FROM windows",
    "windows",
)
def p18(spark, folder):
    counts = B.pair_window_counts(_past(spark, folder), CFG)
    return counts.select(USER_KEY, CATEGORY, X.at_least(F.col("views_7d"), 1).alias("views_7d"))


@check(
    "p19_ratio",
    """
SELECT user_id, category_l1, round(carts_30d / CASE WHEN views_30d < 1 THEN 1 ELSE views_30d END, 6) AS ratio
FROM counts_30d""",
    "counts_30d",
)
def p19(spark, folder):
    counts = B.pair_counts(_past(spark, folder), "30d")
    ratio = X.cart_view_ratio(F.col("carts_30d"), F.col("views_30d"))
    return counts.select(USER_KEY, CATEGORY, F.round(ratio, 6).alias("ratio"))
