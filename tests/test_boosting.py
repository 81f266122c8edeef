"""Boosting on bins: against a plain version, and what its parameters must do."""

from __future__ import annotations

import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from shoptrail.config import Settings
from shoptrail.operators import boosting as B
from shoptrail.operators import learning as L
from shoptrail.operators.metrics import log_loss, metric_values
from shoptrail.session import materialize

CFG = Settings(folds=3, patience=4)
NAMES = ["kids", "auto", "apparel", "computers", None, "spaceship"]


@pytest.fixture(scope="module")
def rows(spark):
    """Views help, some categories help more, everything else is noise or missing."""
    draw = random.Random(3)
    columns = CFG.numeric_features
    out = []
    for user in range(900):
        for k, name in enumerate(draw.sample(NAMES, 2)):
            value = {c: draw.choice([None, 0.0, 1.0, 2.0]) for c in columns}
            value["views_30d"], value["avg_price_viewed_30d"] = float(draw.randint(0, 30)), draw.random() * 100
            lift = {"kids": 2.0, "computers": 1.5}.get(name, -1.0)
            chance = 1 / (1 + math.exp(2 - 0.1 * value["views_30d"] - lift))
            out.append((user, name, int(draw.random() < chance), user % 3, *[value[c] for c in columns]))
    schema = "user_id int, category_l1 string, label int, fold int, " + ", ".join(f"{c} double" for c in columns)
    return materialize(spark.createDataFrame(out, schema).repartition(3), "boost-rows")


@pytest.fixture(scope="module")
def matrix(rows):
    return B.binned(rows, CFG, ["user_id", "category_l1", "fold"], F.col("fold"))


def plain_fit(codes, y, params, rounds):
    """The same greedy trees in the plainest way: every cut of every node tried by itself."""
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))

    def soft(g):
        return math.copysign(max(abs(g) - params.l1, 0.0), g)

    def score(g, h):
        return soft(g) ** 2 / (h + params.l2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, curv = p - y, p * (1 - p)
        value, level, leaves = {0: np.ones(len(y), bool)}, [0], 1
        for _ in range(params.max_depth):
            found = []
            for node in level:
                inside = value[node]
                g, h = grad[inside].sum(), curv[inside].sum()
                best = None
                for f in range(codes.shape[1]):
                    kinds = sorted(set(codes[inside, f]))
                    if f == codes.shape[1] - 1:
                        kinds.sort(key=lambda b: grad[inside & (codes[:, f] == b)].sum() / curv[inside & (codes[:, f] == b)].sum())
                    for cut in range(1, len(kinds)):
                        left = inside & np.isin(codes[:, f], kinds[:cut])
                        right = inside & ~left
                        if min(left.sum(), right.sum()) < params.min_instances:
                            continue
                        gain = score(grad[left].sum(), curv[left].sum()) + score(grad[right].sum(), curv[right].sum()) - score(g, h)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, node, left, right)
                if best:
                    found.append(best)
            found.sort(key=lambda x: -x[0])
            level = []
            for _, node, left, right in found[: params.most_leaves - leaves]:
                leaves += 1
                del value[node]
                for side in (left, right):
                    value[max(value, default=0) + len(value) + 1000] = side
                    level.append(max(value))
        for inside in value.values():
            margin[inside] += -soft(grad[inside].sum()) / (curv[inside].sum() + params.l2) * params.step_size
    return margin


@pytest.mark.parametrize("params", [
    B.TreeParams(max_depth=3, min_instances=15),
    B.TreeParams(max_depth=4, min_instances=5, leaves=6, l1=1.5, l2=3.0, step_size=0.3),
])
def test_trees_equal_the_plain_version(matrix, params):
    model = B.boost(matrix, [B.Fit(params, 4, (0, 1, 2))], CFG, store_every=3)[0]
    table = matrix.table.select("label", "bins").collect()
    codes = np.array([list(r["bins"]) for r in table], np.uint8)
    y = np.array([float(r["label"]) for r in table])
    assert len(model.trees) == 4
    assert np.allclose(model.margins(codes), plain_fit(codes, y, params, 4), atol=1e-8)


def test_fits_do_not_disturb_each_other(matrix, monkeypatch):
    fits = [B.Fit(B.TreeParams(max_depth=3, subsampling=0.7, feature_share=0.5), 30, (1, 2), (0,)), B.Fit(B.TreeParams(max_depth=2), 6, (0, 1)),
            B.Fit(B.TreeParams(max_depth=4, l2=1.0), 30, (0, 2), (1,))]
    together = B.boost(matrix, fits, CFG)
    assert len(together[1].trees) == 6 and not together[1].losses
    assert np.allclose(B.boost(matrix, fits[:1], CFG, store_every=2)[0].losses, together[0].losses)
    monkeypatch.setattr(B, "DRIVER_SUMS", 0)  # sums added by a shuffle
    again = B.boost(matrix, fits, CFG, store_every=1)
    for one, two in zip(together, again):
        assert [t.feature for t in one.trees] == [t.feature for t in two.trees]
        assert np.allclose(one.losses, two.losses)


def test_held_out_loss_and_patience(matrix):
    model = B.boost(matrix, [B.Fit(B.TreeParams(max_depth=4, step_size=0.4), 200, (1, 2), (0,))], CFG)[0]
    best = len(model.trees)
    assert best < 200 and len(model.losses) == best + CFG.patience + 1
    assert model.losses[best] == min(model.losses)
    scored = B.scores_by_part(matrix, {0: model}, ["user_id", "category_l1", "fold", "label"])
    assert scored.filter("fold <> 0").count() == 0
    assert log_loss(scored).first()[0] == pytest.approx(model.losses[best])


def test_a_pass_counts_one_child_of_a_split_and_no_finished_trees(matrix, monkeypatch):
    passes, one_pass = [], B._pass
    monkeypatch.setattr(B, "_pass", lambda blocks, tasks, asked, *rest: passes.append(asked[0]) or one_pass(blocks, tasks, asked, *rest))
    B.boost(matrix, [B.Fit(B.TreeParams(max_depth=4, min_instances=5), 12, (0, 1, 2))], CFG, store_every=5)
    assert [len(a.counted) for a in passes[::4]] == [1] * 12
    assert all(len(a.tree[0]) <= 15 for a in passes)  # the growing tree alone
    for a in passes:
        siblings = {node: pair for pair in zip(a.tree[2], a.tree[3]) for node in pair if any(pair)}
        assert len({siblings.get(node) for node in a.counted}) == len(a.counted)


def test_trees_do_not_depend_on_how_rows_are_dealt(matrix):
    """Half of the features twice: alike cuts have the same gain, and the first one wins, however rows lie."""
    def models(rows):
        return [m.trees for m in B.boost(rows, [B.Fit(B.TreeParams(max_depth=4, min_instances=5), 5, (0, 1)), B.Fit(B.TreeParams(), 5, (1, 2))], CFG)]

    codes = F.col("bins")
    twice = matrix.table.withColumn("bins", F.concat(F.substring(codes, 1, 12), F.substring(codes, 1, 12), F.substring(codes, 25, 1)))
    bins = B.Bins(matrix.bins.features, matrix.bins.edges[:12] * 2, matrix.bins.categories)
    first = models(B.BinnedRows(materialize(twice, "twice"), bins))
    again = models(B.BinnedRows(materialize(twice.repartition(7, "user_id"), "twice"), bins))
    assert first == again
    assert all(not 12 <= f < 24 for trees in first for t in trees for f in t.feature)


def test_joint_cells_route_as_bins_do(matrix):
    """A byte for several features together: trees that ask for cells end every row where trees that ask for bins do."""
    model = B.boost(matrix, [B.Fit(B.TreeParams(max_depth=4, min_instances=5), 6, (0, 1, 2))], CFG)[0]
    codes = np.array([list(r["bins"]) for r in matrix.table.select("bins").collect()], np.uint8)
    cells = B._Cells(matrix.bins.widths)
    joint = cells.of(codes)
    assert joint.dtype == np.uint8 and len(joint) < codes.shape[1] and sorted(f for b in cells.bundles for f in b) == list(range(codes.shape[1]))
    for tree in model.trees:
        node = np.full(len(codes), -1)
        for k, at in B.ends(cells.tree(tree.arrays(matrix.bins.width)), joint, np.arange(len(codes))):
            node[at] = k
        assert (node == B.route(tree.arrays(matrix.bins.width), codes)).all()


def test_passes_read_kept_blocks_and_no_files_stay(spark, matrix, monkeypatch):
    """Blocks are kept arrays, not rows of a cached table; written ones cut the lineage and are removed when nothing starts from them."""
    seen, one_pass = [], B._pass

    def noted(blocks, *rest):
        found = one_pass(blocks, *rest)
        seen.append((type(blocks), blocks.getStorageLevel(), blocks.getCheckpointFile()))
        return found

    monkeypatch.setattr(B, "_pass", noted)
    B.boost(matrix, [B.Fit(B.TreeParams(max_depth=2, min_instances=5), 7, (0, 1, 2))], CFG, store_every=2)
    assert all(issubclass(kind, RDD) and level == B.KEPT for kind, level, _ in seen)
    written = list(dict.fromkeys(path for _, _, path in seen if path))
    assert len(written) == 3
    assert not any(Path(path.removeprefix("file:")).exists() for path in written)


def test_tasks_that_hold_their_blocks_grow_the_same_trees(spark, matrix, monkeypatch):
    """Rounds in a barrier stage: no job a level, the same trees and losses, and no files of sums stay."""
    monkeypatch.setattr(B, "TASK_ROWS", 300)
    fits = [B.Fit(B.TreeParams(max_depth=3, subsampling=0.7, feature_share=0.5), 25, (1, 2), (0,)), B.Fit(B.TreeParams(max_depth=2), 9, (0, 1)),
            B.Fit(B.TreeParams(max_depth=4, min_instances=5, leaves=6, l1=0.5, l2=1.0), 25, (0, 2), (1,))]
    monkeypatch.setattr(B, "JOB_ROUNDS", 1000)
    by_jobs = B.boost(matrix, fits, CFG)
    passes, one_pass = [], B._pass
    monkeypatch.setattr(B, "_pass", lambda *args: passes.append(args[1]) or one_pass(*args))
    monkeypatch.setattr(B, "JOB_ROUNDS", 2)
    monkeypatch.setattr(B, "HELD_ROUNDS", 7)
    held = B.boost(matrix, fits, CFG)
    assert [(m.trees, m.losses) for m in held] == [(m.trees, m.losses) for m in by_jobs]
    assert 0 < len(passes) <= 8 and passes[0] > 1  # two rounds of at most four levels, in several tasks
    assert not list(Path(B.work_dir(spark).removeprefix("file:")).glob("shoptrail/sums-*"))
    monkeypatch.setattr(B, "_may_hold", lambda *_: False)  # more tasks than can run at once
    assert [m.trees for m in B.boost(matrix, fits, CFG)] == [m.trees for m in by_jobs]


def test_many_rows_and_fits_are_held_from_the_first_round(matrix, monkeypatch):
    """Twenty trials on ten million rows are a task a core, so that all tasks can hold their blocks at once; no round goes by jobs."""
    assert B._tasks(10_000_000, 10, 20, 12) == 12 and B._tasks(3 * B.TASK_ROWS - 1, 10, 20, 12) == 3
    assert B._tasks(10**9, 10, 20, 12) == 12 * math.ceil(10**9 * 186 / (12 * B.TASK_BYTES))
    monkeypatch.setattr(B, "TASK_ROWS", 300)
    fits = [B.Fit(p, 4, (1, 2), (0,)) for p in L.draw_params(CFG, 3)]
    by_jobs = B.boost(matrix, fits, CFG)
    monkeypatch.setattr(B, "MANY_ROWS", 0)
    monkeypatch.setattr(B, "_pass", None)
    assert [(m.trees, m.losses) for m in B.boost(matrix, fits, CFG)] == [(m.trees, m.losses) for m in by_jobs]


def test_known_bins_are_not_found_again(rows, matrix, monkeypatch):
    first = L.fit_trees(rows, CFG, B.TreeParams(max_depth=3), 3)
    monkeypatch.setattr(B.Bins, "of", None)
    again = L.fit_trees(rows, CFG, B.TreeParams(max_depth=3), 3, bins=first.bins)
    assert again.trees == first.trees


def test_penalties_shrink_leaves(matrix):
    def largest(**penalty):
        model = B.boost(matrix, [B.Fit(B.TreeParams(max_depth=3, **penalty), 1, (0, 1, 2))], CFG)[0]
        return max((abs(v) for t in model.trees for v, f in zip(t.value, t.feature) if f < 0), default=0.0)

    free = largest()
    assert free > largest(l2=5.0) > largest(l2=500.0) > 0
    assert free > largest(l1=5.0) > 0
    assert largest(l1=1e6) == 0


def test_few_rows_per_leaf_and_leaf_budget(matrix):
    params = B.TreeParams(max_depth=5, leaves=7, min_instances=100)
    model = B.boost(matrix, [B.Fit(params, 3, (0, 1, 2))], CFG)[0]
    codes = np.array([list(r["bins"]) for r in matrix.table.select("bins").collect()], np.uint8)
    for tree in model.trees:
        assert sum(f < 0 for f in tree.feature) <= 7
        ends = np.bincount(B.route(tree.arrays(model.bins.width), codes), minlength=len(tree.feature))
        assert all(n >= 100 for n, f in zip(ends, tree.feature) if f < 0)


def test_as_good_as_the_library(rows, matrix):
    """Depth, rate and rounds alike: the area on rows of another fold is that of MLlib's boosted trees or better."""
    params = B.TreeParams(max_depth=3, step_size=0.1)
    model = B.boost(matrix, [B.Fit(params, 40, (1, 2))], CFG)[0]
    mine = metric_values(materialize(B.scores_by_part(matrix, {0: model}, ["user_id", "category_l1", "label"]), "mine"))
    known = L.impute(rows, CFG).fillna("none", ["category_l1"])
    library = GBTClassifier(featuresCol="features", labelCol="label", maxIter=40, maxDepth=3, stepSize=0.1, maxBins=64, minInstancesPerNode=20, seed=1)
    fitted = Pipeline(stages=[*L.tree_inputs(CFG), library]).fit(known.filter("fold <> 0"))
    theirs = fitted.transform(known.filter("fold = 0")).select("user_id", "category_l1", "label", L.probability().alias("score"))
    theirs = metric_values(materialize(theirs, "theirs"))
    assert mine["auc"] > 0.7 and mine["auc"] > theirs["auc"] - 0.01
    assert mine["log_loss"] < theirs["log_loss"] + 0.02


def test_scores_of_other_rows_and_saved_models(spark, rows, matrix, tmp_path):
    model = B.boost(matrix, [B.Fit(B.TreeParams(max_depth=4), 5, (0, 1, 2))], CFG)[0]
    stored = B.scores_by_part(matrix, dict.fromkeys(range(3), model), ["user_id", "category_l1", "label"])
    fresh = B.score_frame(model, rows, ["user_id", "category_l1", "label"])
    assert sorted(map(str, stored.collect())) == sorted(map(str, fresh.collect()))
    model.save(spark, str(tmp_path))
    loaded = B.BoostedTrees.load(spark, str(tmp_path))
    assert loaded == model
    kept = B.score_frame(model, rows, ["user_id", "views_14d"])
    assert kept.filter("views_14d is null").count() == rows.filter("views_14d is null").count() > 0


def test_bins_keep_missing_apart(rows, matrix):
    bins = matrix.bins
    at = bins.features.index("views_14d")
    assert bins.edges[at][:2] == (-1.0, 0.0)
    codes = {(r["v"], r["bins"][at]) for r in rows.withColumn("v", F.col("views_14d")).select("user_id", "category_l1", "v")
             .join(matrix.table.select("user_id", "category_l1", "bins"), ["user_id", "category_l1"]).collect()}
    assert codes == {(None, 0), (0.0, 1), (1.0, 2), (2.0, 3)}


def test_no_rows_and_one_class(spark, rows):
    for some in (rows.filter("false"), rows.filter("label = 1")):
        matrix = B.binned(some, CFG, ["user_id"], F.lit(0))
        model = B.boost(matrix, [B.Fit(B.TreeParams(), 3, (0,)), B.Fit(B.TreeParams(), 3, (0,), (1,))], CFG)[0]
        scored = B.score_frame(model, rows, ["user_id"])
        assert scored.count() == rows.count() and scored.filter("score < 0 or score > 1 or score is null").count() == 0


def test_search_draws_seven_parameters_and_keeps_every_round(rows):
    drawn = L.draw_params(CFG, 60)
    assert {p.l1 for p in drawn} == {p.l2 for p in drawn} == {0.0, 0.1, 0.5, 1.0}
    assert all(2 ** (p.max_depth - 1) < p.leaves <= 2**p.max_depth and p.most_leaves == p.leaves for p in drawn)
    search = L.run_search(rows, CFG, 12, 3)
    assert search.table.count() == 3
    kept = search.history.filter("best").join(search.table, search.table["trial"] == search.history["model"])
    assert kept.filter("trees = best_trees").count() == 3
    first = search.best()
    assert first["auc"] == search.table.agg(F.max("auc")).first()[0] > 0.6
    tied = search.table.withColumn("auc", F.when(F.col("trial") > 0, F.lit(0.9)))
    assert L.best_trial(tied).first()["trial"] == 1
