"""Evaluation of scored rows: (user_id, category_l1, label, score).

Scores are first counted per distinct value, which collapses ties before any shuffle of rows;
ranks then come from ``ranking.running_totals``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, USER_KEY
from shoptrail.operators.ranking import OVERALL, running_totals, with_overall
from shoptrail.session import fits, materialize

# Fixed value: probabilities are kept this far from 0 and 1 (double rounding unit).
PROBABILITY_MARGIN = 2.220446049250313e-16
# The shares of users at which recall is read, 0.01, 0.02, ... 1.0.
RECALL_SHARES = tuple(0.01 + i * 0.01 for i in range(100))

# Slices up to which the recall grid (100 rows each) is sent to every task.
MOST_BROADCAST_SLICES = 10_000


def score_counts(scored: DataFrame, score: str = "score") -> DataFrame:
    """(slice, score) -> positives and negatives; slices are the categories and ``overall``."""
    counts = scored.groupBy(F.col(CATEGORY).alias("slice"), F.col(score).alias("score")).agg(
        F.sum("label").cast("bigint").alias("pos"), F.sum(1 - F.col("label")).cast("bigint").alias("neg")
    )
    everything = counts.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return counts.unionByName(everything.select(F.lit(OVERALL).alias("slice"), "score", "pos", "neg"))


def auc_from_counts(counts: DataFrame) -> DataFrame:
    """Area under the ROC curve per slice; ties count half. Single-class slices are left out."""
    curve = running_totals(counts, ["slice"], [F.asc("score")], ["neg"])
    wins = F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg") / 2)
    return (
        curve.groupBy("slice")
        .agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(wins).alias("wins"))
        .filter((F.col("positives") > 0) & (F.col("negatives") > 0))
        .select(
            "slice",
            "positives",
            (F.col("positives") / (F.col("positives") + F.col("negatives"))).alias("positive_rate"),
            (F.col("wins") / F.col("positives").cast("double") / F.col("negatives")).alias("auc"),
        )
    )


def auc_by_slice(scored: DataFrame, score: str = "score") -> DataFrame:
    """AUC of every category and of ``overall``, from one range-partitioned pass."""
    return auc_from_counts(score_counts(scored, score))


def overall_auc(scored: DataFrame, score: str = "score") -> DataFrame:
    counts = scored.groupBy(F.col(score).alias("score")).agg(
        F.sum("label").cast("bigint").alias("pos"), F.sum(1 - F.col("label")).cast("bigint").alias("neg")
    )
    return auc_from_counts(counts.withColumn("slice", F.lit(OVERALL))).select("auc")


def compare_auc(scored: DataFrame, base: str, other: str) -> DataFrame:
    """Per-category AUC of two scores side by side, with the difference ``other - base``."""
    left = auc_by_slice(scored, base).withColumnRenamed("auc", "base_auc")
    right = auc_by_slice(scored, other).select("slice", F.col("auc").alias("other_auc"))
    both = left.join(right, "slice").filter(F.col("slice") != OVERALL)
    return both.withColumn("delta", F.col("other_auc") - F.col("base_auc"))


def log_loss_of(score: str = "score", label: str = "label") -> Column:
    """Aggregate column: mean negative log likelihood with clipped probabilities."""
    p = F.least(F.greatest(F.col(score), F.lit(PROBABILITY_MARGIN)), F.lit(1 - PROBABILITY_MARGIN))
    y = F.col(label)
    return F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p)))


def log_loss(scored: DataFrame, score: str = "score") -> DataFrame:
    return scored.agg(log_loss_of(score).alias("log_loss"))


def mean_vs_true(scored: DataFrame, score: str = "score") -> DataFrame:
    return scored.agg(F.avg(score).alias("mean_prob"), F.avg("label").alias("true_rate"))


def positives_in_order(scored: DataFrame, score: str = "score") -> DataFrame:
    """Rows best first within each slice, with ``position`` and positives so far.

    Ties are ordered by user, then category.
    """
    rows = with_overall(scored.select(USER_KEY, CATEGORY, "label", F.col(score).alias("score")))
    order = [F.desc("score"), F.asc(USER_KEY), F.asc(CATEGORY)]
    return running_totals(rows, ["slice"], order, ["label"])


def top_k_recall(
    scored: DataFrame, shares: Sequence[float] = RECALL_SHARES, score: str = "score"
) -> DataFrame:
    """Share of positives among the best ``max(1, floor(n * share))`` rows, per slice and share.

    Totals per slice and score give every cut between two scores. Only the rows that share a score with a cut through it are
    put in order (ties by user, then category): at most ``len(shares)`` scores a slice. ``scored`` should be materialized.
    """
    counts = score_counts(scored, score).withColumn("n", F.col("pos") + F.col("neg"))
    placed = materialize(running_totals(counts, ["slice"], [F.desc("score")], ["n", "pos"]), "score-places")
    sizes = materialize(placed.groupBy("slice").agg(F.sum("n").alias("rows"), F.sum("pos").alias("positives")), "slice-sizes")
    cut = [F.struct(F.lit(float(s)).alias("share"),
                    F.greatest(F.lit(1), F.floor(F.col("rows") * float(s))).cast("bigint").alias("k")) for s in shares]
    grid = sizes.select("slice", "positives", F.array(*cut).alias("cuts"))
    few = fits(sizes, MOST_BROADCAST_SLICES)
    before = F.col("n_upto") - F.col("n")
    inside = F.filter("cuts", lambda c: (c["k"] > before) & (c["k"] <= F.col("n_upto")))
    hits = materialize(
        placed.join(F.broadcast(grid) if few else grid, "slice").withColumn("cut", F.explode(inside)).select(
            "slice", "score", "cut.share", "cut.k", "positives", (F.col("cut.k") - before).alias("position"),
            (F.col("n_upto") == F.col("cut.k")).alias("whole"), "pos", (F.col("pos_upto") - F.col("pos")).alias("pos_before")), "cuts")
    tied = hits.filter("not whole").select("slice", "score").distinct()
    rows = with_overall(scored.select(USER_KEY, CATEGORY, "label", F.col(score).alias("score")))
    rows = rows.join(F.broadcast(tied) if few else tied, ["slice", "score"], "left_semi")
    ordered = running_totals(rows, ["slice", "score"], [F.asc(USER_KEY), F.asc(CATEGORY)], ["label"])
    reached = ordered.select("slice", "score", "position", F.col("label_upto").alias("inside"))
    found = hits.filter("whole").select("slice", "share", "k", "positives", (F.col("pos_before") + F.col("pos")).alias("captured"))
    cuts = hits.filter("not whole")
    part = reached.join(F.broadcast(cuts) if few else cuts, ["slice", "score", "position"])
    found = found.union(part.select("slice", "share", "k", "positives", F.col("pos_before") + F.col("inside")))
    recall = F.coalesce(F.try_divide(F.col("captured"), F.col("positives")), F.lit(0.0))
    return found.select("slice", "share", "k", recall.cast("double").alias("recall"))


def captured_at(scored: DataFrame, share_index: int = 19, score: str = "score") -> DataFrame:
    """Percent of buyers captured at one share of the grid (index 19 is 20 %), by category."""
    at = top_k_recall(scored, [RECALL_SHARES[share_index]], score).filter(F.col("slice") != OVERALL)
    return at.select("slice", F.round(F.col("recall") * 100, 1).alias("captured_pct"))


def exact_quantiles(values: DataFrame, probabilities: Sequence[float]) -> list[float]:
    """Linearly interpolated quantiles of a (score, n) count table, as Python floats.

    Exact at any size: no sorted set is held in one task. A quantile between two ranks needs the
    two scores whose position ranges contain them, so at most two rows per probability come back.
    """
    counted = materialize(values.select("score", "n"), "score-counts")
    total = counted.agg(F.sum("n")).first()[0]
    if not total:
        return []
    spots = [p * (total - 1) for p in probabilities]
    ranks = sorted({r for s in spots for r in (int(s), min(int(s) + 1, total - 1))})
    placed = running_totals(counted, [], [F.asc("score")], ["n"])
    rank = F.explode(F.array(*[F.lit(r).cast("bigint") for r in ranks]))
    first = F.col("n_upto") - F.col("n")
    holds = F.exists(
        F.array(*[F.lit(r).cast("bigint") for r in ranks]), lambda r: (r >= first) & (r < F.col("n_upto"))
    )
    hits = (
        placed.filter(holds)
        .withColumn("rank", rank)
        .filter((F.col("rank") >= first) & (F.col("rank") < F.col("n_upto")))
        .select("rank", "score")
        .collect()
    )
    at = {row["rank"]: row["score"] for row in hits}
    low = [(int(s), s - int(s)) for s in spots]
    return [at[i] + (at[min(i + 1, total - 1)] - at[i]) * part for i, part in low]


def _counted(scored: DataFrame, score: str) -> DataFrame:
    return scored.groupBy(F.col(score).alias("score")).agg(F.count("*").alias("n"))


def score_summary(scored: DataFrame, score: str = "score") -> DataFrame:
    """Minimum, median, maximum and mean score."""
    middle = exact_quantiles(_counted(scored, score), [0.5])
    median = F.lit(middle[0] if middle else None).cast("double")
    return scored.agg(
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score")
    ).select("min_score", median.alias("median_score"), "max_score", "mean_score")


def score_histogram(scored: DataFrame, bins: int = 50, score: str = "score") -> DataFrame:
    """Equal-width bins between the smallest and the largest score; the largest is in the last.

    Rows are counted per score into a stored table, from which the bounds and the bins are taken.
    """
    counted = materialize(_counted(scored, score), "score-counts")
    bounds = counted.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    smallest, largest = (F.lit(bounds[k]).cast("double") for k in ("low", "high"))
    # All scores equal: a unit interval around the value.
    low = F.when(smallest == largest, smallest - 0.5).otherwise(smallest)
    high = F.when(smallest == largest, largest + 0.5).otherwise(largest)
    number = F.when(F.col("score") >= high, F.lit(bins)).otherwise(
        F.least(F.floor((F.col("score") - low) / (high - low) * bins) + 1, F.lit(bins))
    )
    return counted.groupBy(number.cast("int").alias("bin")).agg(F.sum("n").alias("count"))


def mean_score_by_category(scored: DataFrame, score: str = "score") -> DataFrame:
    return scored.groupBy(CATEGORY).agg(F.avg(score).alias("mean_score"))


def reliability_curve(scored: DataFrame, bins: int = 10, score: str = "score") -> DataFrame:
    """Mean predicted and observed rate in quantile bins; empty bins are absent."""
    inner = [i / bins for i in range(1, bins)]
    edges = exact_quantiles(_counted(scored, score), inner)
    number = sum(((F.col(score) > F.lit(e)).cast("int") for e in edges), F.lit(0))
    return scored.groupBy(number.alias("bin")).agg(
        F.count("*").alias("rows"), F.avg(score).alias("mean_predicted"), F.avg("label").alias("observed_rate")
    )


def cold_users(rows: DataFrame, views: str = "total_views_30d") -> DataFrame:
    """user -> is_cold: no view before the cutoff. The column is constant per user."""
    seen = F.coalesce(F.max(views), F.lit(0))
    return rows.groupBy(USER_KEY).agg((seen == 0).alias("is_cold"))


def with_cold_flag(rows: DataFrame, views: str = "total_views_30d") -> DataFrame:
    """The same flag straight from each row, without a shuffle."""
    return rows.withColumn("is_cold", F.coalesce(F.col(views), F.lit(0)) == 0)


def mean_by_slice(scored: DataFrame, views: str = "total_views_30d", score: str = "score") -> DataFrame:
    """Rows, mean score and true rate of cold, warm and all rows."""
    kind = F.explode(
        F.array(F.when(F.col("is_cold"), F.lit("cold")).otherwise(F.lit("warm")), F.lit("all"))
    )
    return (
        with_cold_flag(scored, views)
        .select(kind.alias("slice"), score, "label")
        .groupBy("slice")
        .agg(F.count("*").alias("rows"), F.avg(score).alias("mean_prob"), F.avg("label").alias("true_rate"))
    )


def cold_start_report(scored: DataFrame, views: str = "total_views_30d", score: str = "score") -> DataFrame:
    """Users, user share, positives, AUC and mean score for cold and warm users.

    AUC is null with fewer than two positives or without negatives.
    """
    kind = F.when(F.col("is_cold"), F.lit("cold")).otherwise(F.lit("warm"))
    rows = with_cold_flag(scored, views).withColumn("slice", kind)
    base = rows.groupBy("slice").agg(
        F.count_distinct(USER_KEY).alias("users"),
        F.sum("label").cast("bigint").alias("positives"),
        F.avg("label").alias("true_rate"),
        F.avg(score).alias("mean_prob"),
    )
    everyone = scored.agg(F.count_distinct(USER_KEY).alias("n")).scalar()
    counts = rows.groupBy("slice", F.col(score).alias("score")).agg(
        F.sum("label").cast("bigint").alias("pos"), F.sum(1 - F.col("label")).cast("bigint").alias("neg")
    )
    areas = auc_from_counts(counts).select("slice", F.when(F.col("positives") >= 2, F.col("auc")).alias("auc"))
    return (
        base.join(areas, "slice", "left")
        .withColumn("user_share", F.try_divide(F.col("users"), everyone))
        .select("slice", "users", "user_share", "positives", "true_rate", "auc", "mean_prob")
    )


def metric_values(scored: DataFrame, score: str = "score") -> dict[str, float | None]:
    """AUC, log loss, mean score and true rate as Python numbers (one row to the driver)."""
    means = scored.agg(
        log_loss_of(score).alias("log_loss"), F.avg(score).alias("mean_prob"), F.avg("label").alias("true_rate")
    ).first()
    area = overall_auc(scored, score).first()
    return {"auc": area["auc"] if area else None, **means.asDict()}
