"""Priors, models, calibration, scoring and the staged run.

Priors, joins, feature preparation, calibration and request preparation are compared with SQL. Fitted models have no SQL
counterpart; their properties are asserted in ``tests/``. All models have the sizes of ``Settings``: up to
``max_trees`` trees with patience, ``folds`` folds, ``search_trials`` trials. Queries of one session that need the same
fitted models (the folds', the trials') learn them once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.checks.base import CFG, NUDGE, check, clean, raw, scored, stored_clean, stored_scores
from shoptrail.checks.event_checks import WIDE_RAW, text_time
from shoptrail.checks.population_checks import labelled_parts
from shoptrail.config import CATEGORY, PRIOR, USER_KEY

from shoptrail.operators import behaviour as B
from shoptrail.operators import learning as L
from shoptrail.operators import metrics as M
from shoptrail.operators import population as P
from shoptrail.plans import scoring
from shoptrail.plans.prepare import build_matrix
from shoptrail.plans.stages import StagedRun
from shoptrail.plans.training import pool_and_validation, train_model
from shoptrail.session import fresh_path, materialize, settled
from shoptrail.sources import tables as S

PARAMS = L.TreeParams()
_LEARNT: dict[tuple[str, str, str], list] = {}


def _matrix(spark, folder) -> DataFrame:
    """The feature matrix; the clean log and the user tables behind it are removed."""
    return settled(spark, lambda: [build_matrix(stored_clean(spark, folder), CFG)], "matrix")[0]


def _train(spark, folder) -> DataFrame:
    return _matrix(spark, folder).filter(F.col("split") == "train").drop("split")


def _pool_and_validation(spark, folder):
    pool, validation, _ = pool_and_validation(_train(spark, folder), CFG)
    return pool, validation


def _binned(pool) -> L.BinnedRows:
    return L.by_fold(L.folded(pool, CFG), CFG)


def _folds(spark, folder) -> L.BinnedRows:
    pool, _ = _pool_and_validation(spark, folder)
    return _binned(pool)


def _learnt(spark, folder, name, learn) -> list:
    """Models of this session and folder; a model is its trees, no stored table is kept."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _LEARNT:
        _LEARNT[key] = learn()
    return _LEARNT[key]


def _crossed(spark, folder) -> L.CrossValidation:
    matrix = _folds(spark, folder)
    models = _learnt(spark, folder, "folds", lambda: L.fold_models(matrix, CFG, PARAMS, CFG.max_trees))
    return L.crossed(matrix, models, CFG)


def _searched(spark, folder, matrix) -> L.Search:
    return L.judged(matrix, _learnt(spark, folder, "trials", lambda: L.trial_models(matrix, CFG, CFG.max_trees)))


def _search(spark, folder) -> L.Search:
    return _searched(spark, folder, _folds(spark, folder))


def _mean_trees(spark, folder, matrix) -> int:
    models = _learnt(spark, folder, "folds", lambda: L.fold_models(matrix, CFG, PARAMS, CFG.max_trees))
    return L.CrossValidation(matrix.table, [L.tree_count(m) for m in models]).mean_trees


def _refit(spark, folder, pool):
    """The model on the whole pool, with the mean number of trees of its folds."""
    matrix = _binned(pool)
    return L.fit_trees(pool, CFG, PARAMS, _mean_trees(spark, folder, matrix), bins=matrix.bins)


def _fitted_scores(spark, folder) -> DataFrame:
    """Validation rows scored by the refitted model."""
    pool, validation = _pool_and_validation(spark, folder)
    model = _refit(spark, folder, pool)
    return materialize(L.score_rows(model, validation, CFG), "validation-scores")


# --- category prior -------------------------------------------------------------------------------


@check("a17_category_prior", "SELECT category_l1, round(cat_purchase_rate, 6) AS cat_purchase_rate FROM prior", "prior")
def a17(spark, folder):
    return L.category_prior(labelled_parts(spark, folder).filter("part = 'pool'"), CFG, 6)


@check(
    "l1_attach_prior",
    """
SELECT p.user_id, p.category_l1, p.part, round(cat_purchase_rate, 6) AS cat_purchase_rate
FROM parts p LEFT JOIN prior USING (category_l1)""",
    "parts prior",
)
def l1(spark, folder):
    rows = materialize(labelled_parts(spark, folder), "parts")
    prior = L.category_prior(rows.filter("part = 'pool'"), CFG)
    joined = L.attach_prior(rows.select(USER_KEY, CATEGORY, "part"), prior)
    return joined.withColumn(PRIOR, F.round(PRIOR, 6))


_UNSEEN = """
SELECT c.user_id, c.event_time, c.category_l1,
 round(coalesce(p.cat_purchase_rate, (SELECT avg(cat_purchase_rate) FROM prior)), 6) AS cat_purchase_rate
FROM clean c LEFT JOIN prior p ON p.category_l1 = c.category_l1"""


def _prior_and_events(spark, folder):
    prior = L.category_prior(labelled_parts(spark, folder).filter("part = 'pool'"), CFG)
    return materialize(prior, "prior"), clean(spark, folder).select(USER_KEY, "event_time", CATEGORY)


@check("j8_prior_lookup", _UNSEEN, "prior clean")
def j8(spark, folder):
    """Events in a category outside the prediction get the mean of the rates."""
    prior, events = _prior_and_events(spark, folder)
    return L.attach_prior(events, prior, fill_mean=True).withColumn(PRIOR, F.round(PRIOR, 6))


@check(
    "p24_map_lookup",
    """
SELECT c.user_id, c.event_time, c.category_l1, round(p.cat_purchase_rate, 6) AS cat_purchase_rate
FROM clean c LEFT JOIN prior p ON p.category_l1 = c.category_l1""",
    "prior clean",
)
def p24(spark, folder):
    prior, events = _prior_and_events(spark, folder)
    return L.attach_prior(events, prior).withColumn(PRIOR, F.round(PRIOR, 6))


@check(
    "l12_naive_baseline",
    """
SELECT user_id, category_l1, label, round(cat_purchase_rate, 6) AS score FROM parts JOIN prior USING (category_l1)
WHERE part = 'validation'""",
    "parts prior",
)
def l12(spark, folder):
    rows = materialize(labelled_parts(spark, folder), "parts")
    prior = L.category_prior(rows.filter("part = 'pool'"), CFG)
    held_out = rows.filter("part = 'validation'").select(USER_KEY, CATEGORY, "label")
    return L.naive_scores(held_out, prior).withColumn("score", F.round("score", 6))


# --- feature preparation --------------------------------------------------------------------------


@check(
    "l3_impute",
    "SELECT user_id, category_l1, "
    + ", ".join(f"CAST(coalesce({c}, -1) AS DOUBLE) AS {c}" for c in CFG.recency_columns + CFG.user_columns)
    + " FROM matrix",
    "matrix",
)
def l3(spark, folder):
    rows = _matrix(spark, folder).withColumn(PRIOR, F.lit(0.0))
    return L.impute(rows, CFG).select(USER_KEY, CATEGORY, *CFG.recency_columns, *CFG.user_columns)


def _prepared(spark, folder, stages) -> DataFrame:
    pool, _ = _pool_and_validation(spark, folder)
    rows = L.impute(pool, CFG)
    return Pipeline(stages=stages).fit(rows).transform(rows)


_POOL_ROWS = """
(SELECT m.*, cat_purchase_rate FROM matrix m JOIN parts p ON p.user_id = m.user_id AND p.category_l1 = m.category_l1
 JOIN prior r ON r.category_l1 = m.category_l1 WHERE part = 'pool')"""


def _numbers(vector: str, names) -> list:
    """The places of a vector as columns with four decimals; adding 0 turns a negative zero into a zero."""
    values = L.vector_to_array(vector)
    return [(F.round(F.get(values, F.lit(i)) + NUDGE, 4) + 0.0).alias(n) for i, n in enumerate(names)]


@check(
    "l2_tree_features",
    "SELECT user_id, category_l1, "
    + ", ".join(f"round(coalesce({c}, -1) + {NUDGE}, 4) + CAST(0 AS DOUBLE) AS {c}" for c in CFG.numeric_features)
    + f", CAST(list_position({sorted(CFG.categories)}, category_l1) - 1 AS DOUBLE) AS category_index FROM {_POOL_ROWS}",
    "matrix parts prior",
)
def l2(spark, folder):
    """What a tree model is given: numbers with nulls as -1, and the category by its place in the alphabet."""
    rows = _prepared(spark, folder, L.tree_inputs(CFG))
    index = F.round(F.get(L.vector_to_array("features"), F.lit(len(CFG.numeric_features))), 6).alias("category_index")
    return rows.select(USER_KEY, CATEGORY, *_numbers("features", CFG.numeric_features), index)


@check(
    "l4_standard_scaling",
    "SELECT user_id, category_l1, "
    + ", ".join(
        f"round(CASE WHEN stddev_samp(x.{c}) OVER () > 0 THEN (x.{c} - avg(x.{c}) OVER ()) / stddev_samp(x.{c}) OVER () ELSE 0 END"
        f" + {NUDGE}, 4) + CAST(0 AS DOUBLE) AS {c}" for c in CFG.numeric_features)
    + " FROM (SELECT user_id, category_l1, "
    + ", ".join(f"CAST(coalesce({c}, -1) AS DOUBLE) AS {c}" for c in CFG.numeric_features) + f" FROM {_POOL_ROWS}) x",
    "matrix parts prior",
)
def l4(spark, folder):
    """Numbers less their mean, in standard deviations of the pool; a constant column is 0."""
    rows = _prepared(spark, folder, L.linear_inputs(CFG))
    return rows.select(USER_KEY, CATEGORY, *_numbers("scaled", CFG.numeric_features))


@check(
    "l5_one_hot",
    "SELECT user_id, part, category_l1, "
    + ", ".join(f"CAST(category_l1 = '{c}' AS DOUBLE) AS is_{c}" for c in sorted(CFG.categories))
    + " FROM parts WHERE part <> 'test'",
    "parts",
)
def l5(spark, folder):
    rows = labelled_parts(spark, folder).filter("part <> 'test'").select(USER_KEY, "part", CATEGORY)
    encode = [L.category_indexer(CFG), L.OneHotEncoder(inputCols=["category_index"], outputCols=["slots"], dropLast=True)]
    slots = Pipeline(stages=encode).fit(rows).transform(rows).withColumn("slots", L.vector_to_array("slots"))
    named = [F.get("slots", F.lit(i)).alias(f"is_{c}") for i, c in enumerate(sorted(CFG.categories))]
    return slots.select(USER_KEY, "part", CATEGORY, *named)


# --- models ---------------------------------------------------------------------------------------


@check("l6_logistic")
def l6(spark, folder):
    pool, validation = _pool_and_validation(spark, folder)
    return L.score_rows(L.fit_linear(pool, CFG), validation, CFG)


@check("l7_boosted_trees")
def l7(spark, folder):
    pool, validation = _pool_and_validation(spark, folder)
    rows = pool.withColumn("held_out", F.lit(False)).unionByName(validation.withColumn("held_out", F.lit(True)))
    model = L.fit_trees(materialize(rows, "marked"), CFG, L.TreeParams(), CFG.max_trees, "held_out")
    return L.score_rows(model, validation, CFG)


@check("l8_cross_validation")
def l8(spark, folder):
    return _crossed(spark, folder).reported()


@check("l9_random_search")
def l9(spark, folder):
    """A row per trial: its seven drawn parameters, the number of trees kept and the area on the tuning fold."""
    return _search(spark, folder).table


@check("o9_best_trial")
def o9(spark, folder):
    return L.best_trial(_search(spark, folder).table)


@check("l10_refit_mean_trees")
def l10(spark, folder):
    return _fitted_scores(spark, folder)


@check("l11_final_fit")
def l11(spark, folder):
    matrix = _matrix(spark, folder)
    train, test = (matrix.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    pool, _, prior = pool_and_validation(train, CFG)
    count = _mean_trees(spark, folder, _binned(pool))
    model = L.fit_trees(L.attach_prior(train, prior), CFG, PARAMS, count)
    return L.score_rows(model, L.attach_prior(test, prior), CFG)


@check("l13_model_comparison")
def l13(spark, folder):
    pool, validation = _pool_and_validation(spark, folder)
    return L.compare_models(materialize(pool, "pool"), materialize(validation, "validation"), CFG, CFG.max_trees)


@check("l14_split_importance")
def l14(spark, folder):
    """fold, feature, number of splits."""
    return _crossed(spark, folder).splits.withColumnRenamed("model", "fold")


@check("a26_mean_over_folds")
def a26(spark, folder):
    return _crossed(spark, folder).importance


@check("o7_top_features")
def o7(spark, folder):
    return L.top_features(_crossed(spark, folder).importance, 20)


@check("l8_training_history")
def l8_history(spark, folder):
    """The held-out loss of every fold after every round, and which round was kept."""
    return _crossed(spark, folder).history.withColumnRenamed("model", "fold")


@check("l15_sampling_experiment")
def l15(spark, folder):
    pool, validation = _pool_and_validation(spark, folder)
    return L.sampling_experiment(materialize(pool, "pool"), materialize(validation, "validation"), CFG)


# --- calibration and reports on fitted scores -------------------------------------------------------


# The isotonic value of a point is the greatest, over all starts before it, of the least mean of any run from there past it.
_ISOTONIC = f"""
, halves AS (SELECT user_id, row_number() OVER (ORDER BY md5('42:calibration:' || user_id), user_id)
  <= floor(count(*) OVER () * CAST({CFG.calibration_share} AS DOUBLE)) AS fitted FROM (SELECT DISTINCT user_id FROM scored)),
points AS (SELECT score, sum(label) AS pos, count(*) AS n FROM scored JOIN halves USING (user_id) WHERE fitted GROUP BY score),
sums AS MATERIALIZED (SELECT row_number() OVER (ORDER BY score) AS i, score, sum(pos) OVER (ORDER BY score) AS p,
  sum(n) OVER (ORDER BY score) AS c FROM points),
means AS MATERIALIZED (SELECT a.i AS j, b.i AS k, (b.p - coalesce(z.p, 0)) / (b.c - coalesce(z.c, 0)) AS m
 FROM sums a JOIN sums b ON b.i >= a.i LEFT JOIN sums z ON z.i = a.i - 1),
fit AS (SELECT s.score, max(m) AS value FROM (SELECT s.i, j, min(m) AS m FROM sums s JOIN means ON j <= s.i AND k >= s.i GROUP BY s.i, j) x
 JOIN sums s ON s.i = x.i GROUP BY s.score),
near AS (SELECT s.score, max(f.score) FILTER (f.score <= s.score) AS low, min(f.score) FILTER (f.score >= s.score) AS high
 FROM (SELECT DISTINCT score FROM scored) s CROSS JOIN fit f GROUP BY s.score),
known AS (SELECT n.score, CASE WHEN low IS NULL THEN h.value WHEN high IS NULL OR high = low THEN l.value
  ELSE l.value + (h.value - l.value) * (n.score - low) / (high - low) END AS calibrated
 FROM near n LEFT JOIN fit l ON l.score = low LEFT JOIN fit h ON h.score = high),
calibrated AS (SELECT user_id, category_l1, label, score, calibrated FROM scored JOIN halves USING (user_id) JOIN known USING (score)
 WHERE NOT fitted)"""


def _calibrated(spark, folder) -> DataFrame:
    """Half of the users teach the calibration of the pseudo-score, the rows of the others are calibrated."""
    rows = stored_scores(spark, folder)
    users = materialize(rows.select(USER_KEY).distinct(), "scored-users")
    half = P.calibration_cut(users, CFG).member()
    return L.calibrate(L.fit_calibrator(rows.filter(half)), rows.filter(~half))


@check(
    "v7_isotonic_calibration",
    _ISOTONIC + f" SELECT user_id, category_l1, score, round(calibrated + {NUDGE}, 6) AS calibrated FROM calibrated",
    "scored",
)
def v7(spark, folder):
    rows = _calibrated(spark, folder).withColumn("calibrated", F.round(F.col("calibrated") + NUDGE, 6))
    return rows.select(USER_KEY, CATEGORY, "score", "calibrated")


def _loss_sql(score: str) -> str:
    margin = M.PROBABILITY_MARGIN
    p = f"least(greatest({score}, CAST({margin!r} AS DOUBLE)), 1 - CAST({margin!r} AS DOUBLE))"
    return f"round(avg(-(label * ln({p}) + (1 - label) * ln(1 - {p}))), 6)"


@check(
    "v8_calibration_report",
    _ISOTONIC + f""" SELECT {_loss_sql('score')} AS log_loss_before, {_loss_sql('calibrated')} AS log_loss_after,
 round(avg(score), 6) AS mean_prob_before, round(avg(calibrated), 6) AS mean_prob_after, round(avg(label), 6) AS true_rate FROM calibrated""",
    "scored",
)
def v8(spark, folder):
    report = L.calibration_report(_calibrated(spark, folder))
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


@check("v11_run_record")
def v11(spark, folder):
    matrix = _matrix(spark, folder)
    train, test = (matrix.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    return train_model(train, test, CFG, search=lambda rows: _searched(spark, folder, rows)).record


# --- tables written and read back -------------------------------------------------------------------


@check("s4_matrix_sink", "SELECT user_id, split, category_l1, label FROM labelled", "labelled")
def s4(spark, folder):
    path = fresh_path(spark, "matrix")
    S.write_matrix(_matrix(spark, folder), path)
    both = [S.read_matrix(spark, path, s).withColumn("split", F.lit(s)) for s in S.SPLITS]
    return reduce(DataFrame.unionByName, both).select(USER_KEY, "split", CATEGORY, "label")


@check(
    "s5_matrix_read",
    "SELECT user_id, category_l1, label, views_30d, total_views_30d FROM matrix WHERE split = 'test'",
    "matrix",
)
def s5(spark, folder):
    path = fresh_path(spark, "matrix")
    S.write_matrix(_matrix(spark, folder), path)
    return S.read_matrix(spark, path, "test").select(USER_KEY, CATEGORY, "label", "views_30d", "total_views_30d")


_PREDICTED = "SELECT user_id, category_l1, score AS propensity_score FROM scored"
_BEST = f"""
SELECT * EXCLUDE (turn) FROM (SELECT *, row_number() OVER (
  PARTITION BY category_l1 ORDER BY propensity_score DESC, user_id) AS turn FROM ({_PREDICTED})) WHERE turn <= 5"""


def _written_predictions(spark, folder) -> str:
    path = fresh_path(spark, "predictions")
    rows = stored_scores(spark, folder).select(USER_KEY, CATEGORY, F.col("score").alias("propensity_score"))
    S.write_predictions(rows, path)
    return path


@check("s6_predictions_parquet", _PREDICTED, "scored")
def s6(spark, folder):
    return spark.read.parquet(f"{_written_predictions(spark, folder)}/parquet")


@check("s7_predictions_csv", _PREDICTED, "scored")
def s7(spark, folder):
    return S.read_prediction_csv(spark, f"{_written_predictions(spark, folder)}/csv", T.LongType())


@check("c7_target_sample_csv", _BEST, "scored")
def c7(spark, folder):
    return S.read_prediction_csv(spark, f"{_written_predictions(spark, folder)}/sample", T.LongType())


@check("s8_run_record_json", "SELECT category_l1, round(cat_purchase_rate, 6) AS cat_purchase_rate FROM prior", "prior")
def s8(spark, folder):
    path = fresh_path(spark, "run")
    prior = L.category_prior(labelled_parts(spark, folder).filter("part = 'pool'"), CFG)
    record = M.mean_vs_true(scored(spark, folder))
    S.write_run_record(record, prior, path)
    assert S.read_run_record(spark, path, record.schema).count() == 1
    return S.read_prior(spark, path).withColumn(PRIOR, F.round(PRIOR, 6))


@check("s9_model_save_load")
def s9(spark, folder):
    pool, validation = _pool_and_validation(spark, folder)
    model = _refit(spark, folder, pool)
    path = fresh_path(spark, "model")
    S.save_model(model, path)
    return L.score_rows(S.load_model(path), validation, CFG)


# --- scoring requests -------------------------------------------------------------------------------

_ASKED = "category_l1 IN ('standard', 'medium', 'large', 'promo')"


def _requests(spark, folder) -> DataFrame:
    """One request per active pair, whatever its category, with its latest counts."""
    return _requested(clean(spark, folder))


def _requested(events) -> DataFrame:
    past = B.history(events, CFG)
    pairs = B.pair_activity(past, CFG)
    record = F.concat_ws("/", F.col(USER_KEY).cast("string"), F.col(CATEGORY))
    return pairs.withColumn("record_id", record).drop(USER_KEY)


@check(
    "s12_request_source",
    """
SELECT user_id || '/' || category_l1 AS record_id, category_l1, views_30d, views_7d FROM windows""",
    "windows",
)
def s12(spark, folder):
    """Requests delivered as JSON text and read with the request schema."""
    from shoptrail.schemas import request_schema

    path = fresh_path(spark, "requests")
    _requests(spark, folder).write.json(path)
    asked = spark.read.schema(request_schema(CFG)).option("mode", "FAILFAST").json(path)
    return asked.select("record_id", CATEGORY, "views_30d", "views_7d")


@check(
    "p26_request_guard",
    f"""
SELECT user_id || '/' || category_l1 AS record_id, category_l1, 'unknown category: ' || category_l1 AS reason
FROM windows WHERE NOT {_ASKED}""",
    "windows",
)
def p26(spark, folder):
    return scoring.rejected(_requests(spark, folder), CFG).select("record_id", CATEGORY, "reason")


@check(
    "c8_request_features",
    f"""
SELECT user_id || '/' || category_l1 AS record_id, category_l1,
 CAST(coalesce(views_7d, 0) AS DOUBLE) AS views_7d, CAST(coalesce(carts_14d, 0) AS DOUBLE) AS carts_14d,
 round(coalesce(carts_30d, 0) / greatest(coalesce(views_30d, 0), 1) + {NUDGE}, 6) AS cart_view_ratio_30d,
 round(coalesce(carts_7d, 0) / greatest(coalesce(views_7d, 0), 1) + {NUDGE}, 6) AS cart_view_ratio_7d,
 round(cat_purchase_rate, 6) AS cat_purchase_rate
FROM windows JOIN prior USING (category_l1) WHERE {_ASKED}""",
    "windows prior",
)
def c8_features(spark, folder):
    prior = L.category_prior(labelled_parts(spark, folder).filter("part = 'pool'"), CFG)
    rows = scoring.request_features(_requests(spark, folder), materialize(prior, "prior"), CFG)
    ratios = {c: F.round(F.col(c) + NUDGE, 6) for c in CFG.ratio_columns}
    return rows.withColumns(ratios).select(
        "record_id", CATEGORY, "views_7d", "carts_14d", *CFG.ratio_columns, PRIOR
    )


@check("c8_score_batch")
def c8(spark, folder):
    """The log is cleaned once, for the matrix and the requests; only these two are kept while the model is learned."""

    def tables() -> list[DataFrame]:
        events = stored_clean(spark, folder)
        return [build_matrix(events, CFG), _requested(events)]

    matrix, requests = settled(spark, tables, "matrix", "requests")
    pool, _, prior = pool_and_validation(matrix.filter(F.col("split") == "train").drop("split"), CFG)
    return scoring.score_batch(_refit(spark, folder, pool), requests, prior, CFG)


@check("c10_staged_run")
def c10(spark, folder):
    """Text files to predictions, stage by stage."""
    home, csv = fresh_path(spark, "run"), fresh_path(spark, "csv")
    text = raw(spark, folder).withColumn("event_time", text_time()).select(*[f.name for f in WIDE_RAW.fields])
    text = text.withColumns({c: F.col(c).cast("int") for c in ("product_id", "user_id")})
    text.write.option("header", True).csv(csv)
    StagedRun(spark, home, CFG, [csv]).run()
    return spark.read.parquet(f"{home}/predictions/parquet")
