"""Category prior, feature preparation, model fitting and model comparison."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.config import CATEGORY, PRIOR, USER_KEY, Settings
from shoptrail.operators.boosting import (
    MISSING,
    BinnedRows,
    Bins,
    BoostedTrees,
    Fit,
    TreeParams,
    best_round,
    binned,
    boost,
    loss_history,
    score_frame,
    scores_by_part,
    scores_of_all,
    split_table,
)
from shoptrail.operators.calibration import calibrate, calibration_report, fit_calibrator
from shoptrail.operators.metrics import auc_from_counts, metric_values
from shoptrail.operators.population import positive_users_rows, with_fold
from shoptrail.session import materialize


# --- category prior -----------------------------------------------------------------------------


def category_prior(rows: DataFrame, cfg: Settings, places: int | None = None) -> DataFrame:
    """category -> mean label, at most one row per configured category.

    Pass the training pool only: a prior that has seen validation labels leaks them.
    """
    rate = F.avg("label")
    rate = rate if places is None else F.round(rate, places)
    known = rows.filter(F.col(CATEGORY).isin(list(cfg.categories)))
    return known.groupBy(CATEGORY).agg(rate.alias(PRIOR))


def attach_prior(rows: DataFrame, prior: DataFrame, fill_mean: bool = False) -> DataFrame:
    """Adds ``cat_purchase_rate``. ``prior`` may be any table, so how it is joined is left to Spark: a small
    stored one is broadcast. With ``fill_mean`` an unseen category gets the mean of the rates.
    """
    joined = rows.join(prior, CATEGORY, "left")
    if fill_mean:
        mean_rate = prior.agg(F.avg(PRIOR)).scalar()
        joined = joined.withColumn(PRIOR, F.coalesce(F.col(PRIOR), mean_rate))
    return joined.select(*rows.columns, PRIOR)


def naive_scores(rows: DataFrame, prior: DataFrame) -> DataFrame:
    """The baseline model: a row's score is the purchase rate of its category."""
    return attach_prior(rows, prior, fill_mean=True).withColumnRenamed(PRIOR, "score")


# --- feature preparation --------------------------------------------------------------------------


def impute(rows: DataFrame, cfg: Settings) -> DataFrame:
    """Numeric features as doubles, nulls replaced by -1."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in cfg.numeric_features}
    return rows.withColumns(filled)


def category_indexer(cfg: Settings) -> StringIndexerModel:
    """Category -> index in alphabetical order, built from the configuration without a data pass.

    An unknown category gets an extra index.
    """
    return StringIndexerModel.from_labels(
        sorted(cfg.categories), inputCol=CATEGORY, outputCol="category_index", handleInvalid="keep"
    )


def tree_inputs(cfg: Settings) -> list:
    """Numeric features plus the category as a nominal feature (the index carries its metadata)."""
    columns = [*cfg.numeric_features, "category_index"]
    return [category_indexer(cfg), VectorAssembler(inputCols=columns, outputCol="features")]


def linear_inputs(cfg: Settings) -> list:
    """Standardised numeric features and one-hot categories; an unknown category is all zeros
    (the extra index is the slot that the encoder drops).
    """
    return [
        VectorAssembler(inputCols=cfg.numeric_features, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        category_indexer(cfg),
        OneHotEncoder(inputCols=["category_index"], outputCols=["category_slots"], dropLast=True),
        VectorAssembler(inputCols=["scaled", "category_slots"], outputCol="features"),
    ]


# --- models -----------------------------------------------------------------------------------------


# The ranges of the random search (leaves, rows per leaf, learning rate, row share, feature share, penalties).
LEAVES, LEAF_ROWS, LEARNING_RATE, ROW_SHARE, FEATURE_SHARE = (15, 127), (20, 199), (0.02, 0.15), (0.6, 1.0), (0.6, 1.0)
PENALTIES = (0.0, 0.1, 0.5, 1.0)


def draw_params(cfg: Settings, trials: int) -> list[TreeParams]:
    """Seeded random search space of seven parameters. The depth is the least that holds the drawn leaves."""
    draw = random.Random(cfg.seed)
    drawn = []
    for _ in range(trials):
        leaves = draw.randint(*LEAVES)
        drawn.append(TreeParams(
            max_depth=math.ceil(math.log2(leaves)),
            leaves=leaves,
            min_instances=draw.randint(*LEAF_ROWS),
            step_size=draw.uniform(*LEARNING_RATE),
            subsampling=draw.uniform(*ROW_SHARE),
            feature_share=draw.uniform(*FEATURE_SHARE),
            l1=draw.choice(PENALTIES),
            l2=draw.choice(PENALTIES),
        ))
    return drawn


def probability() -> Column:
    return vector_to_array("probability")[1]


def score_rows(model: PipelineModel | BoostedTrees, rows: DataFrame, cfg: Settings, name: str = "score") -> DataFrame:
    """Keys and label of the input rows, as they were before imputation, with the probability of 1."""
    if isinstance(model, BoostedTrees):
        return score_frame(model, rows, _keys(rows), name)
    kept = rows.withColumn("kept", F.struct(*_keys(rows)))
    scored = model.transform(impute(kept, cfg))
    return scored.select("kept.*", probability().alias(name))


def _keys(rows: DataFrame) -> list[str]:
    """What a scored table keeps: keys, label, and what slices need."""
    keep = {USER_KEY, CATEGORY, "label", "fold", "split", "record_id", "request_no"}
    return [c for c in rows.columns if c in keep or c.startswith("total_views_")]


def fit_trees(
    rows: DataFrame, cfg: Settings, params: TreeParams, trees: int, early_stop_column: str | None = None, bins: Bins | None = None
) -> BoostedTrees:
    """Boosted trees. With ``early_stop_column``, the rows it marks are held out and decide how many, with patience. ``bins`` found on
    the same rows before need not be found again.
    """
    part = F.col(early_stop_column).cast("int") if early_stop_column else F.lit(0)
    given = binned(rows, cfg, [], part, bins, params.max_bins)
    return boost(given, [Fit(params, trees, (0,), (1,) if early_stop_column else ())], cfg)[0]


def fit_linear(rows: DataFrame, cfg: Settings, c: float = 1.0) -> PipelineModel:
    """Logistic regression with inverse regularisation strength ``c``.

    MLlib averages the loss over rows, so the penalty is divided by their number.
    """
    classifier = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=1000,
        regParam=1.0 / (c * max(rows.count(), 1)),
        elasticNetParam=0.0,
        standardization=False,
    )
    return Pipeline(stages=[*linear_inputs(cfg), classifier]).fit(impute(rows, cfg))


def fit_forest(rows: DataFrame, cfg: Settings, trees: int | None = None) -> PipelineModel:
    """Bagged trees, the second family of trees in the comparison."""
    classifier = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees or cfg.bagged_trees, maxDepth=8, minInstancesPerNode=20,
        maxBins=64, seed=cfg.seed)
    return Pipeline(stages=[*tree_inputs(cfg), classifier]).fit(impute(rows, cfg))


def tree_count(model: BoostedTrees) -> int:
    return len(model.trees)


def feature_names(cfg: Settings) -> list[str]:
    return [*cfg.numeric_features, CATEGORY]


def split_counts(model: BoostedTrees, cfg: Settings) -> DataFrame:
    """feature -> number of splits in the model's trees."""
    return split_table(SparkSession.builder.getOrCreate(), [model], feature_names(cfg)).drop("model")


def mean_over_models(splits: DataFrame) -> DataFrame:
    """Split counts (model, feature, splits) averaged over models."""
    return splits.groupBy("feature").agg(F.avg("splits").alias("importance"))


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


# --- cross-validation and search ----------------------------------------------------------------


@dataclass
class CrossValidation:
    """Held-out scores of every fold, with what the refit needs; ``history`` and ``splits`` are tables by fold (``model``)."""

    scores: DataFrame
    best_trees: list[int] = field(default_factory=list)
    importance: DataFrame | None = None
    history: DataFrame | None = None
    splits: DataFrame | None = None

    @property
    def mean_trees(self) -> int:
        """Half-to-even rounding of the mean, at least one tree."""
        return max(1, round(sum(self.best_trees) / len(self.best_trees)))

    def reported(self, tuning_fold: int | None = 0) -> DataFrame:
        """Scores without the fold that tuned the parameters."""
        return self.scores if tuning_fold is None else self.scores.filter(F.col("fold") != tuning_fold)


def folded(pool: DataFrame, cfg: Settings) -> DataFrame:
    """The training rows with ``fold``, written once and read by every fit."""
    return materialize(with_fold(pool, cfg), "folded")


def by_fold(rows: DataFrame | BinnedRows, cfg: Settings) -> BinnedRows:
    """Rows with ``fold`` on one matrix of bins, for every fold and trial; such a matrix is taken as it is."""
    return rows if isinstance(rows, BinnedRows) else binned(rows, cfg, _keys(rows), F.col("fold"))


def together(spark: SparkSession, jobs: Sequence[Callable], cfg: Settings) -> list:
    """Results of independent driver-side jobs, several at a time, in the order given."""
    with ThreadPoolExecutor(max(1, cfg.parallel_fits)) as workers:
        waiting = [workers.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [w.result() for w in waiting]


def _others(cfg: Settings, fold: int) -> tuple[int, ...]:
    return tuple(k for k in range(cfg.folds) if k != fold)


def fold_models(matrix: BinnedRows, cfg: Settings, params: TreeParams, trees: int) -> list[BoostedTrees]:
    """One boosted model per fold, stopped early on that fold; all of them share every pass."""
    return boost(matrix, [Fit(params, trees, _others(cfg, k), (k,)) for k in range(cfg.folds)], cfg)


def crossed(matrix: BinnedRows, models: Sequence[BoostedTrees], cfg: Settings) -> CrossValidation:
    """Every row scored by the model that has not seen its fold."""
    keep = [c for c in matrix.table.columns if c not in ("part", "row_hash", "bins")]
    scores = materialize(scores_by_part(matrix, dict(enumerate(models)), keep), "held-out-scores")
    spark = scores.sparkSession
    splits = materialize(split_table(spark, models, feature_names(cfg)), "splits")
    history = materialize(loss_history(spark, models), "history")
    return CrossValidation(scores, [tree_count(m) for m in models], mean_over_models(splits), history, splits)


def cross_validate_trees(rows: DataFrame | BinnedRows, cfg: Settings, params: TreeParams, trees: int) -> CrossValidation:
    matrix = by_fold(rows, cfg)
    return crossed(matrix, fold_models(matrix, cfg, params, trees), cfg)


def cross_validate(rows: DataFrame, cfg: Settings, fit: Callable[[DataFrame, Settings], PipelineModel]) -> CrossValidation:
    """One model per fold from the other folds' rows, scoring that fold."""

    def one(fold: int):
        model = fit(rows.filter(F.col("fold") != fold), cfg)
        return score_rows(model, rows.filter(F.col("fold") == fold), cfg)

    parts = together(rows.sparkSession, [partial(one, k) for k in range(cfg.folds)], cfg)
    return CrossValidation(materialize(reduce(DataFrame.unionByName, parts), "held-out-scores"))


def cross_validate_linear(rows: DataFrame, cfg: Settings) -> CrossValidation:
    return cross_validate(rows, cfg, fit_linear)


@dataclass
class Search:
    """A random search: a row per trial, the drawn parameters, and the held-out loss of every trial and round."""

    table: DataFrame
    params: list[TreeParams]
    history: DataFrame

    def best(self) -> dict:
        """The row of the highest AUC, the earlier trial on ties."""
        return best_trial(self.table).first().asDict()


TRIAL_COLUMNS = (
    "trial int, best_trees int, leaves int, max_depth int, min_instances int, step_size double, subsampling double, "
    "feature_share double, l1 double, l2 double"
)


def trial_models(
    matrix: BinnedRows, cfg: Settings, trees: int, trials: int | None = None, tuning_fold: int = 0
) -> list[BoostedTrees]:
    """A model per drawn set of parameters, all learning on the same matrix of bins in the same passes."""
    drawn = draw_params(cfg, trials or cfg.search_trials)
    return boost(matrix, [Fit(p, trees, _others(cfg, tuning_fold), (tuning_fold,)) for p in drawn], cfg)


def judged(matrix: BinnedRows, models: Sequence[BoostedTrees], tuning_fold: int = 0) -> Search:
    """The area of every trial on the tuning fold, from one pass over its rows."""
    spark = matrix.table.sparkSession
    scored = scores_of_all(matrix, models, tuning_fold, ["label"])
    counts = scored.groupBy(F.col("trial").alias("slice"), "score").agg(
        F.sum("label").cast("bigint").alias("pos"), F.sum(1 - F.col("label")).cast("bigint").alias("neg"))
    areas = auc_from_counts(counts).select(F.col("slice").alias("trial"), "auc")
    names = [part.split()[0] for part in TRIAL_COLUMNS.split(", ")][2:]
    listed = [(k, tree_count(m), *[getattr(m.params, n) for n in names]) for k, m in enumerate(models)]
    table = spark.createDataFrame(listed, TRIAL_COLUMNS).join(areas, "trial", "left")
    history = materialize(loss_history(spark, models), "history")
    return Search(materialize(table, "trials"), [m.params for m in models], history)


def run_search(rows: DataFrame | BinnedRows, cfg: Settings, trees: int, trials: int | None = None, tuning_fold: int = 0) -> Search:
    """Random search on one fold."""
    matrix = by_fold(rows, cfg)
    return judged(matrix, trial_models(matrix, cfg, trees, trials, tuning_fold), tuning_fold)


def best_trial(trials: DataFrame) -> DataFrame:
    """The row of the highest AUC, the earlier trial on ties; trials without an AUC come last."""
    order = F.struct(F.coalesce("auc", F.lit(-1.0)), -F.col("trial"))
    return trials.agg(F.max_by(F.struct(*trials.columns), order).alias("best")).select("best.*")


def search_params(
    rows: DataFrame | BinnedRows, cfg: Settings, trees: int, trials: int | None = None, tuning_fold: int = 0
) -> list[dict]:
    """A record per trial of ``run_search``, best AUC first, earlier trial on ties."""
    search = run_search(rows, cfg, trees, trials, tuning_fold)
    records = [r.asDict() | {"params": search.params[r["trial"]]} for r in search.table.collect()]
    return sorted(records, key=lambda r: (r["auc"] is None, -(r["auc"] or 0.0), r["trial"]))


def comparison_table(
    spark: SparkSession, records: Sequence[dict], columns: str
) -> DataFrame:
    """A handful of per-model records as a table."""
    names = [part.split()[0] for part in columns.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in records], columns)


COMPARISON_COLUMNS = (
    "model string, oof_auc double, oof_log_loss double, val_auc double, val_log_loss double, "
    "val_mean_prob double, seconds double"
)


def compare_models(pool: DataFrame, validation: DataFrame, cfg: Settings, trees: int) -> DataFrame:
    """Naive, logistic, boosted and bagged models: out-of-fold and validation metrics.

    Both frames carry the prior of the pool. The naive baseline's pool score is in-sample.
    """
    rows = folded(pool, cfg)
    prior = materialize(category_prior(pool, cfg), "prior")
    records = []

    def record(name, started, oof, val):
        out, new = metric_values(oof), metric_values(materialize(val, "val-scores"))
        records.append(
            {
                "model": name,
                "oof_auc": out["auc"],
                "oof_log_loss": out["log_loss"],
                "val_auc": new["auc"],
                "val_log_loss": new["log_loss"],
                "val_mean_prob": new["mean_prob"],
                "seconds": time.monotonic() - started,
            }
        )

    started = time.monotonic()
    bare = [c for c in pool.columns if c != PRIOR]
    naive = materialize(naive_scores(pool.select(*bare), prior), "naive-scores")
    record("naive", started, naive, naive_scores(validation.select(*bare), prior))
    started = time.monotonic()
    linear = cross_validate_linear(rows, cfg)
    record("logistic", started, linear.scores, score_rows(fit_linear(pool, cfg), validation, cfg))
    started = time.monotonic()
    boosted = cross_validate_trees(rows, cfg, TreeParams(), trees)
    refit = fit_trees(pool, cfg, TreeParams(), boosted.mean_trees)
    record("boosted", started, boosted.scores, score_rows(refit, validation, cfg))
    started = time.monotonic()
    bagged = cross_validate(rows, cfg, fit_forest)
    record("bagged", started, bagged.scores, score_rows(fit_forest(pool, cfg), validation, cfg))
    return comparison_table(pool.sparkSession, records, COMPARISON_COLUMNS).orderBy(F.desc("val_auc"))


def sampling_experiment(pool: DataFrame, validation: DataFrame, cfg: Settings, trees: int | None = None) -> DataFrame:
    """Full pool against buyers-only rows, boosted and logistic, on the same validation rows.

    Both boosted fits share their passes: the rows of buyers are one part of the matrix, the others another.
    """
    subsets = {"train_pool": pool, "train_purchaser": materialize(positive_users_rows(pool), "buyers-only")}
    buyers = subsets["train_purchaser"].select(USER_KEY).distinct().withColumn("bought", F.lit(1))
    marked = pool.join(buyers, USER_KEY, "left")
    matrix = binned(marked, cfg, [], F.coalesce("bought", F.lit(0)))
    most = trees or cfg.experiment_trees
    boosted = boost(matrix, [Fit(TreeParams(), most, (0, 1)), Fit(TreeParams(), most, (1,))], cfg)
    models = {("boosted", s): m for s, m in zip(subsets, boosted)}
    linear = together(pool.sparkSession, [partial(fit_linear, rows, cfg) for rows in subsets.values()], cfg)
    models |= {("logistic", s): m for s, m in zip(subsets, linear)}

    def one(name: str, subset: str) -> dict:
        values = metric_values(materialize(score_rows(models[name, subset], validation, cfg), "val-scores"))
        return {
            "model": name,
            "scaffold": subset,
            "val_auc": values["auc"],
            "val_log_loss": values["log_loss"],
            "val_mean_prob": values["mean_prob"],
        }

    records = together(pool.sparkSession, [partial(one, *key) for key in models], cfg)
    columns = "model string, scaffold string, val_auc double, val_log_loss double, val_mean_prob double"
    return comparison_table(pool.sparkSession, records, columns)
