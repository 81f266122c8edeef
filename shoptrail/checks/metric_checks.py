"""Evaluation of scored rows, on a pseudo-score that every engine can compute."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoptrail.checks.base import NUDGE, check, scored, stored_scores
from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.operators import metrics as M
from shoptrail.operators import ranking as R

_COUNTS = """
SELECT slice, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
FROM sliced GROUP BY slice, score"""
_AUC = f"""
SELECT slice, CAST(p AS BIGINT) AS positives, round(p / (p + q) + {NUDGE}, 6) AS positive_rate, round(w / p / q, 6) AS auc
FROM (SELECT slice, sum(pos) AS p, sum(neg) AS q, sum(pos * (below + neg / 2)) AS w FROM (
 SELECT *, coalesce(sum(neg) OVER (PARTITION BY slice ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS below FROM ({_COUNTS})) GROUP BY slice) WHERE p > 0 AND q > 0"""
_CLIPPED = f"least(greatest(score, {M.PROBABILITY_MARGIN}), CAST(1 - {M.PROBABILITY_MARGIN} AS DOUBLE))"
_LOG_LOSS = f"avg(-(label * ln({_CLIPPED}) + (1 - label) * ln(1 - {_CLIPPED})))"
_GRID = "[" + ", ".join(f"CAST({s!r} AS DOUBLE)" for s in M.RECALL_SHARES) + "]"
_RECALL = f"""
SELECT g.slice, round(g.share, 6) AS share, g.k, round(coalesce(CAST(o.captured AS DOUBLE) / nullif(g.positives, 0), 0), 6) AS recall
FROM (SELECT slice, positives, share, greatest(1, CAST(floor(n * share) AS BIGINT)) AS k FROM (
  SELECT slice, count(*) AS n, sum(label) AS positives, unnest({_GRID}) AS share FROM sliced GROUP BY slice)) g
JOIN (SELECT slice, row_number() OVER w AS k, sum(label) OVER w AS captured FROM sliced
  WINDOW w AS (PARTITION BY slice ORDER BY score DESC, user_id, category_l1
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) o
ON o.slice = g.slice AND o.k = g.k"""
_AS_TARGETS = "SELECT user_id, category_l1, score AS propensity_score FROM scored"


def _targets(spark, folder):
    return scored(spark, folder).select(USER_KEY, CATEGORY, F.col("score").alias("propensity_score"))


def _six(rows, *columns):
    return rows.withColumns({c: F.round(c, 6) for c in columns})


# --- ranking --------------------------------------------------------------------------------------


@check(
    "w1_top_per_category",
    f"""
SELECT * EXCLUDE (turn) FROM (SELECT *, row_number() OVER (
  PARTITION BY category_l1 ORDER BY propensity_score DESC, user_id) AS turn FROM ({_AS_TARGETS})) WHERE turn <= 5""",
    "scored",
)
def w1(spark, folder):
    return R.top_per_category(_targets(spark, folder), 5)


@check(
    "w2_cumulative_positives",
    """
SELECT slice, user_id, category_l1, row_number() OVER w AS position, CAST(sum(label) OVER w AS BIGINT) AS captured
FROM sliced WINDOW w AS (PARTITION BY slice ORDER BY score DESC, user_id, category_l1
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "sliced",
)
def w2(spark, folder):
    ordered = M.positives_in_order(scored(spark, folder))
    return ordered.select("slice", USER_KEY, CATEGORY, "position", F.col("label_upto").alias("captured"))


@check(
    "o8_score_order",
    """
SELECT user_id, category_l1, row_number() OVER (ORDER BY score DESC, user_id, category_l1) AS position FROM scored""",
    "scored",
)
def o8(spark, folder):
    rows = scored(spark, folder).select(USER_KEY, CATEGORY, "score")
    ordered = R.running_totals(rows, [], [F.desc("score"), F.asc(USER_KEY), F.asc(CATEGORY)], [])
    return ordered.select(USER_KEY, CATEGORY, "position")


@check(
    "w3_score_ranks",
    f"""
SELECT slice, score, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, CAST(sum(neg) OVER (
 PARTITION BY slice ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS neg_upto
FROM ({_COUNTS})""",
    "sliced",
)
def w3(spark, folder):
    counts = M.score_counts(scored(spark, folder))
    return R.running_totals(counts, ["slice"], [F.asc("score")], ["neg"]).drop("position")


@check("o5_target_order", _AS_TARGETS + " ORDER BY category_l1, propensity_score DESC, user_id", "scored")
def o5(spark, folder):
    return R.target_list(_targets(spark, folder))


@check(
    "o6_ranked_response",
    "SELECT user_id, category_l1, round(score, 6) AS propensity_score FROM scored ORDER BY propensity_score DESC, user_id",
    "scored",
)
def o6(spark, folder):
    rounded = _targets(spark, folder).withColumn("propensity_score", F.round("propensity_score", 6))
    return rounded.orderBy(F.desc("propensity_score"), F.asc(USER_KEY))


# --- metrics --------------------------------------------------------------------------------------


@check("v1_auc_overall", f"SELECT auc FROM ({_AUC}) WHERE slice = 'overall'", "sliced")
def v1(spark, folder):
    return _six(M.overall_auc(scored(spark, folder)), "auc")


@check("v3_auc_by_category", _AUC, "sliced")
def v3(spark, folder):
    areas = M.auc_by_slice(scored(spark, folder)).withColumn("positive_rate", F.col("positive_rate") + NUDGE)
    return _six(areas, "auc", "positive_rate")


@check(
    "v3_auc_delta",
    f"""
SELECT slice, base_auc, round(other, 6) AS other_auc FROM (SELECT slice, auc AS base_auc, 1 - auc AS other FROM ({_AUC}))
WHERE slice <> 'overall'""",
    "sliced",
)
def v3_delta(spark, folder):
    rows = stored_scores(spark, folder).withColumn("flipped", 1 - F.col("score"))
    both = M.compare_auc(rows, "score", "flipped").select("slice", "base_auc", "other_auc")
    return _six(both, "base_auc", "other_auc")


@check("v2_log_loss", f"SELECT round({_LOG_LOSS}, 6) AS log_loss FROM scored", "scored")
def v2(spark, folder):
    return _six(M.log_loss(scored(spark, folder)), "log_loss")


@check("v4_top_k_recall", _RECALL, "sliced")
def v4(spark, folder):
    return _six(M.top_k_recall(stored_scores(spark, folder)), "share", "recall")


@check(
    "v5_captured_at_20",
    f"""
SELECT slice, round(recall * 100, 1) AS captured_pct FROM ({_RECALL})
WHERE slice <> 'overall' AND share = CAST(0.2 AS DOUBLE)""",
    "sliced",
)
def v5(spark, folder):
    return M.captured_at(stored_scores(spark, folder))


_EDGES = "[" + ", ".join(f"CAST({i / 10!r} AS DOUBLE)" for i in range(1, 10)) + "]"


@check(
    "v6_reliability_curve",
    f"""
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS rows, round(avg(score), 6) AS mean_predicted,
 round(avg(label), 6) AS observed_rate
FROM scored JOIN (SELECT d.score, count(e.edge) AS bin FROM (SELECT DISTINCT score FROM scored) d
 LEFT JOIN (SELECT unnest(quantile_cont(score, {_EDGES})) AS edge FROM scored) e ON e.edge < d.score
 GROUP BY d.score) USING (score) GROUP BY bin""",
    "scored",
)
def v6(spark, folder):
    return _six(M.reliability_curve(stored_scores(spark, folder)), "mean_predicted", "observed_rate")


@check(
    "a22_score_summary",
    """
SELECT min(score) AS min_score, quantile_cont(score, CAST(0.5 AS DOUBLE)) AS median_score, max(score) AS max_score,
 round(avg(score), 6) AS mean_score FROM scored""",
    "scored",
)
def a22(spark, folder):
    return _six(M.score_summary(stored_scores(spark, folder)), "mean_score")


@check(
    "a23_score_histogram",
    """
SELECT CAST(CASE WHEN score >= hi THEN 50 ELSE least(floor((score - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin,
 CAST(count(*) AS BIGINT) AS count
FROM scored, (SELECT min(score) AS lo, max(score) AS hi FROM scored) GROUP BY 1""",
    "scored",
)
def a23(spark, folder):
    return M.score_histogram(scored(spark, folder))


@check(
    "a24_mean_score_by_category",
    "SELECT category_l1, round(avg(score), 6) AS mean_score FROM scored GROUP BY category_l1",
    "scored",
)
def a24(spark, folder):
    return _six(M.mean_score_by_category(scored(spark, folder)), "mean_score")


@check(
    "a25_cold_users",
    "SELECT user_id, coalesce(max(total_views_30d), 0) = 0 AS is_cold FROM scored GROUP BY user_id",
    "scored",
)
def a25(spark, folder):
    return M.cold_users(scored(spark, folder))


@check(
    "p27_slice_masks",
    """
SELECT user_id, category_l1, coalesce(total_views_30d, 0) = 0 AS is_cold FROM scored WHERE category_l1 = 'promo'""",
    "scored",
)
def p27(spark, folder):
    rows = M.with_cold_flag(scored(spark, folder)).filter(F.col(CATEGORY) == "promo")
    return rows.select(USER_KEY, CATEGORY, "is_cold")


@check(
    "a27_mean_by_slice",
    """
SELECT slice, count(*) AS rows, round(avg(score), 6) AS mean_prob, round(avg(label), 6) AS true_rate
FROM (SELECT score, label, unnest([CASE WHEN coalesce(total_views_30d, 0) = 0 THEN 'cold' ELSE 'warm' END, 'all']) AS slice
 FROM scored) GROUP BY slice""",
    "scored",
)
def a27(spark, folder):
    return _six(M.mean_by_slice(scored(spark, folder)), "mean_prob", "true_rate")


@check(
    "v9_cold_start_report",
    """
SELECT b.slice, users, round(users / CAST((SELECT count(DISTINCT user_id) FROM scored) AS DOUBLE), 6) AS user_share,
 b.positives, true_rate, CASE WHEN b.positives >= 2 THEN a.auc END AS auc, mean_prob
FROM (SELECT slice, count(DISTINCT user_id) AS users, CAST(sum(label) AS BIGINT) AS positives,
  round(avg(label), 6) AS true_rate, round(avg(score), 6) AS mean_prob FROM temps GROUP BY slice) b
LEFT JOIN (SELECT slice, round(sum(pos * (below + neg / 2)) / sum(pos) / sum(neg), 6) AS auc FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY slice ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
   AS below FROM (SELECT slice, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
    FROM temps GROUP BY slice, score)) GROUP BY slice) a ON a.slice = b.slice""",
    "temps",
)
def v9(spark, folder):
    report = M.cold_start_report(stored_scores(spark, folder))
    return _six(report, "user_share", "true_rate", "auc", "mean_prob")


@check(
    "v10_mean_vs_true",
    "SELECT round(avg(score), 6) AS mean_prob, round(avg(label), 6) AS true_rate FROM scored",
    "scored",
)
def v10(spark, folder):
    return _six(M.mean_vs_true(scored(spark, folder)), "mean_prob", "true_rate")
