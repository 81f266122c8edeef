"""Search, cross-validation, validation, final model and the run record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.config import USER_KEY, Settings
from shoptrail.operators.boosting import BinnedRows, BoostedTrees, TreeParams
from shoptrail.operators.learning import (
    Search,
    attach_prior,
    by_fold,
    category_prior,
    cross_validate_trees,
    fit_trees,
    folded,
    run_search,
    score_rows,
)
from shoptrail.operators.metrics import cold_start_report, metric_values
from shoptrail.operators.population import validation_cut
from shoptrail.session import materialize

RECORD_COLUMNS = (
    "trees int, max_depth int, min_instances int, step_size double, subsampling double, feature_share double, "
    "leaves int, l1 double, l2 double, "
    "oof_auc double, oof_log_loss double, val_auc double, val_log_loss double, val_mean_prob double, "
    "test_auc double, test_log_loss double, test_mean_prob double, val_cold_auc double, val_cold_user_share double"
)


@dataclass
class TrainingRun:
    """What a training run leaves behind; ``history`` has the held-out loss of every fold and round."""

    model: BoostedTrees
    prior: DataFrame
    validation: DataFrame
    predictions: DataFrame
    importance: DataFrame
    record: DataFrame
    search: Search
    history: DataFrame


def pool_and_validation(train: DataFrame, cfg: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pool, validation, prior): users held out by hash, the prior learned from the pool only.

    Both frames are filters on the stored matrix plus a join with one row per category.
    """
    users = materialize(train.select(USER_KEY).distinct(), "train-users")  # read several times for the threshold
    is_validation = validation_cut(users, cfg).member()
    pool, validation = train.filter(~is_validation), train.filter(is_validation)
    prior = materialize(category_prior(pool, cfg), "prior")
    return attach_prior(pool, prior), attach_prior(validation, prior), prior


def train_model(
    train: DataFrame, test: DataFrame, cfg: Settings, trees: int | None = None, trials: int | None = None,
    search: Search | Callable[[BinnedRows], Search] | None = None,
) -> TrainingRun:
    """The full run. Test labels are read once, at the very end. A ``search`` over the same pool may be handed in, or how to make it
    from the matrix of bins.
    """
    trees = trees or cfg.max_trees
    pool, validation, prior = pool_and_validation(train, cfg)
    rows = folded(pool, cfg)
    matrix = by_fold(rows, cfg)  # one matrix of bins for all trials and folds
    search = search(matrix) if callable(search) else search or run_search(matrix, cfg, trees, trials)
    params: TreeParams = search.params[search.best()["trial"]]
    crossed = cross_validate_trees(matrix, cfg, params, trees)
    held_out = metric_values(crossed.reported())

    count = crossed.mean_trees
    refit = fit_trees(rows, cfg, params, count, bins=matrix.bins)
    scored_validation = materialize(score_rows(refit, validation, cfg), "validation-scores")
    val = metric_values(scored_validation)
    slices = {r["slice"]: r for r in cold_start_report(scored_validation, f"total_views_{cfg.full}").collect()}
    cold = slices.get("cold")

    final = fit_trees(attach_prior(train, prior), cfg, params, count)
    scored_test = materialize(score_rows(final, attach_prior(test, prior), cfg), "test-scores")
    new = metric_values(scored_test)

    values = (
        [count] + [v for k, v in asdict(params).items() if k != "max_bins"]
        + [_round(held_out["auc"]), _round(held_out["log_loss"])]
        + [_round(val[k]) for k in ("auc", "log_loss", "mean_prob")]
        + [_round(new[k]) for k in ("auc", "log_loss", "mean_prob")]
        + [_round(cold["auc"]) if cold else None, _round(cold["user_share"]) if cold else 0.0]
    )
    record = train.sparkSession.createDataFrame([tuple(values)], RECORD_COLUMNS)
    predictions = scored_test.select(USER_KEY, "category_l1", F.col("score").alias("propensity_score"))
    return TrainingRun(final, prior, scored_validation, predictions, crossed.importance, record, search, crossed.history)


def _round(value: float | None) -> float | None:
    return None if value is None else round(value, 4)
