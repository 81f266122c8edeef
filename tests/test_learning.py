"""Models on rows with a planted signal: views drive purchases, and categories differ."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shoptrail.config import PRIOR, Settings
from shoptrail.operators import learning as L
from shoptrail.operators.metrics import log_loss, metric_values
from shoptrail.plans.training import pool_and_validation, train_model
from shoptrail.session import materialize

CFG = Settings(folds=2)
RATES = {"electronics": 0.3, "apparel": 0.1, "kids": 0.02}


def _planted(spark, users, seed):
    draw = random.Random(seed)
    columns = [c for c in CFG.stored_features]
    rows = []
    for user in range(users):
        cold = draw.random() < 0.3
        for category, rate in RATES.items():
            views = 0 if cold else draw.randint(0, 20)
            label = int(draw.random() < min(0.95, rate + 0.03 * views))
            value = dict.fromkeys(columns)
            value.update({c: 0 for c in CFG.count_columns})
            if not cold:
                value.update(views_30d=views, views_14d=views // 2, total_views_30d=3 * views + 1, days_since_view=3)
            rows.append((user, category, label, *[None if value[c] is None else float(value[c]) for c in columns]))
    schema = "user_id int, category_l1 string, label int, " + ", ".join(f"{c} double" for c in columns)
    return materialize(spark.createDataFrame(rows, schema).coalesce(2), "planted")


@pytest.fixture(scope="module")
def train(spark):
    return _planted(spark, 700, 1)


@pytest.fixture(scope="module")
def parts(train):
    pool, validation, prior = pool_and_validation(train, CFG)
    return materialize(pool, "pool"), materialize(validation, "validation"), prior


def test_validation_users_are_unseen(parts, train):
    pool, validation, _ = parts
    assert validation.select("user_id").distinct().count() == 140
    assert pool.join(validation, "user_id", "left_semi").count() == 0
    assert pool.count() + validation.count() == train.count()


def test_prior_ignores_validation_labels(train, parts):
    _, validation, prior = parts
    held_out = validation.select("user_id").distinct()
    altered = train.join(held_out.withColumn("v", F.lit(True)), "user_id", "left").withColumn(
        "label", F.when(F.col("v"), 1 - F.col("label")).otherwise(F.col("label"))
    )
    _, _, again = pool_and_validation(altered.drop("v"), CFG)
    assert sorted(map(tuple, prior.collect())) == sorted(map(tuple, again.collect()))


def test_unseen_category_gets_the_mean_of_rates(spark, parts):
    _, _, prior = parts
    rows = spark.createDataFrame([(1, "kids"), (2, "spaceship")], "user_id int, category_l1 string")
    rates = [r[PRIOR] for r in prior.collect()]
    got = {r.category_l1: r[PRIOR] for r in L.attach_prior(rows, prior, fill_mean=True).collect()}
    assert got["spaceship"] == pytest.approx(sum(rates) / len(rates))
    plain = {r.category_l1: r[PRIOR] for r in L.attach_prior(rows, prior).collect()}
    assert plain["spaceship"] is None and plain["kids"] == got["kids"]


def test_linear_preparation(parts):
    pool, _, _ = parts
    rows = L.impute(pool, CFG)
    model = L.Pipeline(stages=L.linear_inputs(CFG)).fit(rows)
    unknown = rows.limit(1).withColumn("category_l1", F.lit("spaceship"))
    slots = model.transform(unknown).select(L.vector_to_array("category_slots").alias("s")).first().s
    assert slots == [0.0] * len(CFG.categories)
    views = model.transform(rows).select(F.get(L.vector_to_array("scaled"), F.lit(0)).alias("v"))
    mean, std = views.agg(F.avg("v"), F.stddev("v")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)


def test_models_beat_the_naive_baseline(parts):
    pool, validation, prior = parts
    bare = [c for c in validation.columns if c != PRIOR]
    naive = metric_values(L.naive_scores(validation.select(*bare), prior))
    linear = metric_values(materialize(L.score_rows(L.fit_linear(pool, CFG), validation, CFG), "s"))
    model = L.fit_trees(pool, CFG, L.TreeParams(max_depth=4), 12)
    scores = materialize(L.score_rows(model, validation, CFG), "s")
    boosted = metric_values(scores)
    assert linear["auc"] > naive["auc"] + 0.02 and boosted["auc"] > naive["auc"] + 0.02
    assert linear["log_loss"] < naive["log_loss"]
    assert scores.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    again = L.score_rows(L.fit_trees(pool, CFG, L.TreeParams(max_depth=4), 12), validation, CFG)
    assert sorted(map(str, again.collect())) == sorted(map(str, scores.collect()))
    splits = {r.feature: r.splits for r in L.split_counts(model, CFG).collect()}
    assert len(splits) == 25 and splits["views_30d"] > 0 and splits["carts_7d"] == 0


def test_scored_rows_keep_missing_values(parts):
    """A null count of views marks a cold user; it must not come back as the imputed number."""
    pool, validation, _ = parts
    scored = L.score_rows(L.fit_linear(pool, CFG), validation, CFG)
    nulls = validation.filter(F.col("total_views_30d").isNull()).count()
    assert 0 < nulls == scored.filter(F.col("total_views_30d").isNull()).count()


def test_cross_validation_scores_every_row_once(parts):
    pool, _, _ = parts
    rows = L.folded(pool, CFG)
    crossed = L.cross_validate_trees(rows, CFG, L.TreeParams(max_depth=3), 4)
    assert crossed.scores.count() == pool.count()
    assert crossed.scores.groupBy("user_id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    assert len(crossed.best_trees) == CFG.folds and 1 <= crossed.mean_trees <= 4
    assert crossed.reported().filter("fold = 0").count() == 0
    assert crossed.importance.count() == 25


def test_search_is_seeded_and_sorted(parts):
    pool, _, _ = parts
    first, second = L.draw_params(CFG, 4), L.draw_params(CFG, 4)
    assert first == second and len({p.step_size for p in first}) == 4
    assert all(4 <= p.max_depth <= 7 for p in L.draw_params(CFG, 200))
    records = L.search_params(L.folded(pool, CFG), CFG, 3, 2)
    assert records[0]["auc"] >= records[1]["auc"]


def test_mean_trees_rounds_half_to_even():
    assert L.CrossValidation(None, [2, 3]).mean_trees == 2
    assert L.CrossValidation(None, [3, 4]).mean_trees == 4


def test_isotonic_calibration(parts):
    pool, validation, _ = parts
    squeezed = L.score_rows(L.fit_linear(pool, CFG), validation, CFG).withColumn("score", F.pow("score", 3))
    scores = materialize(squeezed, "squeezed")
    model = L.fit_calibrator(scores)
    fitted = materialize(L.calibrate(model, scores), "calibrated")
    ordered = [r.calibrated for r in fitted.orderBy("score").collect()]
    assert ordered == sorted(ordered) and 0 <= ordered[0] and ordered[-1] <= 1
    report = L.calibration_report(fitted).first()
    assert report.log_loss_after < report.log_loss_before
    assert report.mean_prob_after == pytest.approx(report.true_rate)
    outside = scores.limit(2).withColumn("score", F.lit(5.0))
    assert {r.calibrated for r in L.calibrate(model, outside).collect()} == {ordered[-1]}


def test_comparison_and_sampling_tables(parts):
    pool, validation, _ = parts
    table = {r.model: r for r in L.compare_models(pool, validation, CFG, 3).collect()}
    assert set(table) == {"naive", "logistic", "boosted", "bagged"}
    assert table["bagged"].val_auc > table["naive"].val_auc
    assert table["boosted"].val_auc > table["naive"].val_auc
    cases = {(r.model, r.scaffold): r for r in L.sampling_experiment(pool, validation, CFG, 3).collect()}
    assert len(cases) == 4
    full, buyers = cases[("logistic", "train_pool")], cases[("logistic", "train_purchaser")]
    assert buyers.val_mean_prob > full.val_mean_prob and buyers.val_log_loss > full.val_log_loss


def test_training_run(spark, train):
    run = train_model(train, _planted(spark, 150, 2), CFG, trees=4, trials=1)
    record = run.record.first()
    assert record.val_auc > 0.6 and record.test_auc > 0.6 and 0 < record.val_cold_user_share < 1
    assert run.predictions.columns == ["user_id", "category_l1", "propensity_score"]
    assert run.predictions.count() == 450
    assert log_loss(run.validation).first().log_loss == pytest.approx(record.val_log_loss, abs=1e-3)


def test_patience_waits_for_a_later_round():
    losses = [1.0, 0.9, 0.95, 0.8, 0.85, 0.86, 0.87, 0.5]
    assert L.best_round(losses, 1) == 2
    assert L.best_round(losses, 3) == 4
    assert L.best_round(losses, 50) == 8
    assert L.best_round([0.4], 5) == 1
