"""Model queries at the operators' own sizes."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shoptrail.checks import model_checks as C
from shoptrail.operators import boosting as B
from shoptrail.session import materialize, settled, work_dir

FOLDER = "/root/testdata/sf0.001"


def test_boosted_trees_are_limited_by_the_settings_only(spark, monkeypatch):
    asked = []
    rows = spark.createDataFrame([(1,)], "user_id bigint")
    monkeypatch.setattr(C, "_pool_and_validation", lambda *_: (rows, rows))
    monkeypatch.setattr(C, "materialize", lambda table, name: table)
    monkeypatch.setattr(C.L, "fit_trees", lambda rows, cfg, params, most, *rest: asked.append((params, most, *rest)))
    monkeypatch.setattr(C.L, "score_rows", lambda model, rows, cfg: rows)
    C.l7(spark, "")
    assert asked == [(C.L.TreeParams(), C.CFG.max_trees, "held_out")]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are absent")
def test_boosted_trees_really_run_until_patience_ends_them(spark, monkeypatch):
    """The registered query, with nothing replaced: every round is fitted, judged and kept or dropped."""
    made, boost = [], B.boost
    monkeypatch.setattr(C.L, "boost", lambda *args: made.extend(boost(*args)) or made)
    scores = C.l7(spark, FOLDER)
    model = made[0]
    assert model.params == C.L.TreeParams() and C.CFG.patience == 50 and C.CFG.max_trees == 2000
    assert len(model.losses) == B.best_round(model.losses, 50) + 50
    assert len(model.trees) == max(1, B.best_round(model.losses, 50) - 1)
    assert scores.filter("score between 0 and 1").count() == scores.count() > 0
    assert scores.groupBy("user_id", "category_l1").count().filter(F.col("count") > 1).count() == 0


def test_batch_scoring_cleans_the_log_once_and_keeps_no_log(spark, monkeypatch):
    draw, read = random.Random(4), []
    rows = [(datetime(1998, 1, 1) + timedelta(days=draw.randint(0, 230)), draw.choice(["view", "view", "cart", "purchase"]), user,
             draw.choice(C.CFG.categories), draw.choice(["a", None]), float(draw.randint(1, 9)), f"s{k}") for user in range(60) for k in range(8)]
    events = spark.createDataFrame(
        rows, "event_time timestamp_ntz, event_type string, user_id bigint, category_l1 string, brand string, price double, user_session string")
    tables = lambda: {p.name for p in Path(work_dir(spark).removeprefix("file:")).glob("shoptrail/*")}
    before = tables()
    monkeypatch.setattr(C, "stored_clean", lambda *_: read.append(1) or materialize(events, "clean"))
    monkeypatch.setattr(C, "clean", lambda *_: read.append(1) or events)
    monkeypatch.setattr(C, "CFG", replace(C.CFG, max_trees=2, folds=2))
    monkeypatch.setattr(C, "_LEARNT", {})
    scored = C.c8(spark, "")
    asked = events.filter(F.col("event_time") < C.CFG.cutoff).select("user_id", "category_l1").distinct()
    assert scored.count() == asked.count() > 0 and scored.filter("propensity_score is null").count() == 0
    assert read == [1]
    assert not any(name.startswith(("clean-", "pool-split-", "user-")) for name in tables() - before)


def test_settled_tables_stay_and_the_way_to_them_does_not(spark):
    way = []

    def tables():
        rows = materialize(spark.range(10), "way")
        way.extend(rows.inputFiles())
        return [rows.filter("id < 3"), rows.selectExpr("id + 1 AS next")]

    few, more = settled(spark, tables, "few", "more")
    assert (few.count(), more.count(), more.columns) == (3, 10, ["next"])
    assert way and not any(Path(p.removeprefix("file:")).exists() for p in way)


def test_run_record_builds_one_matrix(spark, monkeypatch):
    built, searches = [], []
    rows = spark.createDataFrame([(1, "train")], "user_id bigint, split string")
    monkeypatch.setattr(C, "_matrix", lambda *_: built.append(1) or rows)
    monkeypatch.setattr(C, "_searched", lambda spark, folder, matrix: matrix)
    monkeypatch.setattr(C, "train_model", lambda train, test, cfg, search: searches.append(search) or SimpleNamespace(record=rows))
    C.v11(spark, "")
    assert built == [1] and searches[0]("the bins") == "the bins"
