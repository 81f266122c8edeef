"""Boosted trees for many fits at once, on one matrix of bin numbers.

Features are quantised once and stored as a byte each. A fit (a fold, a trial, a final model) names the parts of the rows it
learns from and those that are held out. All fits advance together: one pass over the rows counts, for the smaller child of
every node just split, gradients, curvatures and rows per bin; its sibling's sums are the parent's less these, and the splits
follow from them. So folds and trials share every scan, and boosting goes on round after round from the margins of the round
before until the held-out loss of a fit has not improved for ``patience`` rounds; nothing is fitted twice. Leaf values carry an
L1 and an L2 penalty.

While fits grow, rows lie in blocks of some ten thousand rows: a byte for every few features together, and the margins of every fit. Blocks
are arrays in an RDD: a pass over a cached table copied them row by row into Arrow, which took longer than counting. Spark keeps them (in
memory, then on disk) from round to round and writes them every few rounds. After the first rounds (with many rows at once), where a job a
level costs more than its counting, the tasks of a barrier stage hold the blocks for many rounds and meet at every level.
"""

from __future__ import annotations

import json
import math
import os
import pickle
import random
import time
from collections.abc import Iterator, Sequence
from copy import copy
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, BarrierTaskContext, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from shoptrail.config import CATEGORY, PAIR_KEY, Settings
from shoptrail.session import fresh_path, materialize, remove, work_dir

# What a missing number is replaced with, and how far a curvature sum must be from nothing (fixed values).
MISSING = -1.0
LEAST_CURVATURE = 1e-3
# Sums of a pass that are added up on the driver; beyond it they are added by a shuffle first.
DRIVER_SUMS = 64 << 20
# Rows of a block, bytes of blocks in a task, rows that are worth a task of their own, and cells that features are counted in together.
BLOCK_ROWS, TASK_BYTES, TASK_ROWS, JOINT_CELLS = 1 << 15, 64 << 20, 2000, 256
# Blocks are kept in memory as they come from the tasks, then on disk.
KEPT = StorageLevel(True, True, False, True)
# Rounds that go as a job a level, before tasks hold the blocks, and rounds that they hold them for.
JOB_ROUNDS, HELD_ROUNDS = 12, 100
# Rows times fits beyond which a job a level costs more from the first round on: it reads all blocks and routes all rows again.
MANY_ROWS = 1 << 21
# Bytes that a task may hold, and those it holds per row and fit: margin, gradient, curvature, the row's place in an open node.
HELD_BYTES, HELD_ROW = 640 << 20, 32
# Seconds that a task waits for another one before the stage fails.
LONGEST_WAIT = 1200


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters; ``leaves`` bounds a tree together with its depth, nothing else if None."""

    max_depth: int = 5
    min_instances: int = 20
    step_size: float = 0.1
    subsampling: float = 1.0
    feature_share: float = 1.0
    # At least the number of categories plus one for unknown ones.
    max_bins: int = 64
    leaves: int | None = None
    l1: float = 0.0
    l2: float = 0.0

    @property
    def most_leaves(self) -> int:
        return min(self.leaves or 2**self.max_depth, 2**self.max_depth)


# --- bins ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """Upper edges of the bins per numeric feature; the category comes last, a bin per name and one for unknown ones."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    categories: tuple[str, ...]

    @property
    def widths(self) -> list[int]:
        return [len(e) + 1 for e in self.edges] + [len(self.categories) + 1]

    @property
    def width(self) -> int:
        return max(self.widths)

    @staticmethod
    def of(rows: DataFrame, cfg: Settings, most: int) -> Bins:
        """Edges at quantiles of ``rows`` (sketches merged by Spark, error a tenth of a bin), so equal values share a bin."""
        features = tuple(cfg.numeric_features)
        filled = rows.select(*[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in features])
        shares = [k / most for k in range(1, most)]
        found = filled.approxQuantile(list(features), [0.0, *shares, 1.0], 0.1 / most)
        # the least value closes the first bin: nulls, as -1, are told apart from counts of 0
        edges = tuple(tuple(sorted(set(q))[:-1][: most - 1]) for q in found) if found and found[0] else ((),) * len(features)
        return Bins(features, edges, tuple(sorted(cfg.categories)))

    def columns(self) -> list:
        """The features of a row under names of their own, numbers as doubles with nulls as -1."""
        numbers = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(f"_{k}") for k, c in enumerate(self.features)]
        return [*numbers, F.col(CATEGORY).cast("string").alias("_category")]

    def numbers(self, batch: pa.RecordBatch) -> np.ndarray:
        """(rows, features) of bin numbers, from the columns above."""
        out = np.empty((batch.num_rows, len(self.features) + 1), np.uint8)
        for k, edges in enumerate(self.edges):
            values = batch.column(f"_{k}").to_numpy(zero_copy_only=False)
            values = np.where(np.isnan(values), MISSING, values)
            out[:, k] = np.searchsorted(np.array(edges), values, side="left")
        at = pc.index_in(batch.column("_category"), value_set=pa.array(self.categories, pa.string()))
        out[:, -1] = at.fill_null(len(self.categories)).to_numpy(zero_copy_only=False)
        return out


@dataclass(frozen=True)
class BinnedRows:
    """Stored rows: kept columns, ``label``, ``part`` and ``row_hash``, the bin numbers and the margin of every fit so far."""

    table: DataFrame
    bins: Bins


def binned(rows: DataFrame, cfg: Settings, keep: Sequence[str], part: Column, bins: Bins | None = None, most: int = 64) -> BinnedRows:
    """``rows`` with their bin numbers, written once: kept columns, label, ``part`` (an integer that fits choose rows by)."""
    bins = bins or Bins.of(rows, cfg, most)
    own = {"label": F.col("label").cast("int"), "part": part.cast("int"), "row_hash": F.xxhash64(*PAIR_KEY)}
    kept = [c for c in keep if c not in own]
    given = rows.select(*kept, *[c.alias(n) for n, c in own.items()], *bins.columns())
    names = [*kept, *own]
    schema = StructType([given.schema[n] for n in names]).add("bins", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pa.array([r.tobytes() for r in bins.numbers(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], codes], names=[*names, "bins"])

    return BinnedRows(materialize(given.mapInArrow(run, schema), "binned"), bins)


# --- trees --------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as lists; a leaf has feature -1. ``goes_left`` is a truth value per bin of the node's feature."""

    feature: list[int] = field(default_factory=lambda: [-1])
    goes_left: list[list[bool]] = field(default_factory=lambda: [[]])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def add(self, value: float) -> int:
        for column, x in zip((self.feature, self.goes_left, self.left, self.right, self.value), (-1, [], 0, 0, value)):
            column.append(x)
        return len(self.feature) - 1

    def arrays(self, width: int) -> tuple:
        table = np.zeros((len(self.feature), width), bool)
        for k, row in enumerate(self.goes_left):
            table[k, : len(row)] = row
        return list(self.feature), table, list(self.left), list(self.right), list(self.value)


def ends(tree: tuple, columns: np.ndarray, rows: np.ndarray, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, those of ``rows`` that end there); columns: (feature, row). With ``wanted``, only nodes in it are entered."""
    feature, table, left, right, _ = tree
    waiting = [(0, rows)]
    while waiting:
        node, at = waiting.pop()
        if feature[node] < 0:
            yield node, at
            continue
        down = table[node][columns[feature[node]][at]]
        if wanted is None or left[node] in wanted:
            waiting.append((left[node], at[down]))
        if wanted is None or right[node] in wanted:
            waiting.append((right[node], at[~down]))


def route(tree: tuple, codes: np.ndarray) -> np.ndarray:
    """The node in which every row ends; codes: (row, feature)."""
    node = np.zeros(len(codes), np.int64)
    for k, at in ends(tree, codes.T, np.arange(len(codes))):
        node[at] = k
    return node


@dataclass(frozen=True)
class Fit:
    """One model to learn: parameters, the most trees, and which parts are learned from and held out."""

    params: TreeParams
    most: int
    learn: tuple[int, ...]
    held_out: tuple[int, ...] = ()


@dataclass
class BoostedTrees:
    """A model: log odds to start from, trees, and the held-out loss after 0, 1, 2, ... trees (empty without held-out rows)."""

    bins: Bins
    params: TreeParams
    base: float
    trees: list[Tree]
    losses: list[float]

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - the name that MLlib's tree models have
        return len(self.trees)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), self.base)
        columns, rows = np.ascontiguousarray(codes.T), np.arange(len(codes))
        for tree in self.trees:
            for k, at in ends(tree.arrays(self.bins.width), columns, rows):
                out[at] += tree.value[k]
        return out

    def node_rows(self) -> list[tuple]:
        """(tree, node, feature, bins that go left, left, right, value) of every node."""
        return [
            (t, k, f, [b for b, goes in enumerate(g) if goes], left, right, v)
            for t, tree in enumerate(self.trees)
            for k, (f, g, left, right, v) in enumerate(zip(tree.feature, tree.goes_left, tree.left, tree.right, tree.value))]

    def save(self, spark: SparkSession, path: str) -> None:
        """A table of nodes, and a record of the bins and parameters."""
        nodes = "tree int, node int, feature int, left_bins array<int>, left int, right int, value double"
        spark.createDataFrame(self.node_rows(), nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        record = {"bins": asdict(self.bins), "params": asdict(self.params), "base": self.base, "losses": self.losses, "trees": len(self.trees)}
        spark.createDataFrame([(json.dumps(record),)], "record string").write.mode("overwrite").text(f"{path}/record")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        record = json.loads(spark.read.text(f"{path}/record").first()[0])
        b = record["bins"]
        bins = Bins(tuple(b["features"]), tuple(tuple(e) for e in b["edges"]), tuple(b["categories"]))
        trees = [Tree([], [], [], [], []) for _ in range(record["trees"])]
        # a node table is as large as the model, which every task holds anyway
        for r in sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: (r["tree"], r["node"])):
            tree = trees[r["tree"]]
            tree.add(r["value"])
            tree.feature[-1], tree.left[-1], tree.right[-1] = r["feature"], r["left"], r["right"]
            tree.goes_left[-1] = [k in set(r["left_bins"]) for k in range(bins.width)] if r["feature"] >= 0 else []
        return BoostedTrees(bins, TreeParams(**record["params"]), record["base"], trees, record["losses"])


def best_round(losses: Sequence[float], patience: int) -> int:
    """The number of rounds with the least loss, looking no further than ``patience`` rounds past it."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


# --- splits from sums ---------------------------------------------------------------------------------


def _shrunk(gradient, l1: float):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def leaf_value(gradient, curvature, params: TreeParams):
    """The step that lowers the penalised loss most, times the learning rate."""
    return -_shrunk(gradient, params.l1) / np.maximum(curvature + params.l2, 1e-12) * params.step_size


def _score(gradient, curvature, params: TreeParams):
    return _shrunk(gradient, params.l1) ** 2 / np.maximum(curvature + params.l2, 1e-12)


def best_splits(sums: np.ndarray, params: TreeParams, nominal: int) -> list[tuple | None]:
    """Per node the best (gain, feature place, bins that go left, sums left, sums right); sums: (node, feature, bin, 3).

    Bins of the feature at place ``nominal`` (-1: none) are taken in the order of their mean gradient, so any subset that is best
    for the loss can go left. Ties go to the first feature and the first cut.
    """
    nodes, features, width, _ = sums.shape
    order = np.broadcast_to(np.arange(width), (nodes, features, width)).copy()
    if nominal >= 0:
        part = sums[:, nominal]
        mean = np.where(part[..., 2] > 0, part[..., 0] / np.maximum(part[..., 1], 1e-12), np.inf)
        order[:, nominal] = np.argsort(mean, axis=1, kind="stable")
    ordered = np.take_along_axis(sums, order[..., None], axis=2)
    left = np.cumsum(ordered, axis=2)[:, :, :-1]
    whole = ordered.sum(axis=2, keepdims=True)
    right = whole - left
    gain = _score(left[..., 0], left[..., 1], params) + _score(right[..., 0], right[..., 1], params) - _score(whole[..., 0], whole[..., 1], params)
    least = max(1, params.min_instances)
    allowed = (np.minimum(left[..., 2], right[..., 2]) >= least) & (np.minimum(left[..., 1], right[..., 1]) >= LEAST_CURVATURE)
    gain = np.where(allowed, gain, -np.inf).reshape(nodes, -1)
    out: list[tuple | None] = []
    for k in range(nodes):
        best = int(np.argmax(gain[k])) if gain.shape[1] else 0
        if not gain.shape[1] or not gain[k, best] > 1e-9:
            out.append(None)
            continue
        f, cut = divmod(best, width - 1)
        goes = np.zeros(width, bool)
        goes[order[k, f, : cut + 1]] = True
        out.append((float(gain[k, best]), f, goes.tolist(), left[k, f, cut], right[k, f, cut]))
    return out


class _Growing:
    """A fit on its way: finished trees, those not yet in the stored margins, and the tree that grows."""

    def __init__(self, number: int, fit: Fit, base: float, seed: int, features: int):
        self.number, self.fit, self.base = number, fit, base
        self.draw = random.Random(f"{seed}:{number}" if fit.params.feature_share < 1 or fit.params.subsampling < 1 else seed)
        self.seed, self.features = seed, features
        # trees, without the ``earlier`` ones that a task need not know
        self.trees: list[Tree] = []
        self.earlier = 0
        self.losses: list[float] = []
        self.stored = 0
        self.done = False
        self.tree: Tree | None = None

    def full(self) -> bool:
        return self.earlier + len(self.trees) >= self.fit.most

    def start(self) -> None:
        self.tree, self.open, self.leaves, self.depth = Tree(), [0], 1, 0
        # what the next pass counts, and (parent's sums, counted child, its sibling)
        self.counted, self.pairs = [0], []
        n = max(1, round(self.features * self.fit.params.feature_share))
        self.chosen = sorted(self.draw.sample(range(self.features), n))
        self.row_seed = self.draw.getrandbits(63)

    def asks(self, width: int) -> _Asked:
        return _Asked(self.number, self.fit.learn, self.fit.held_out, self.tree.arrays(width), self.counted, self.chosen, self.row_seed,
                      self.fit.params.subsampling, self.depth == 0 and bool(self.fit.held_out))

    def take(self, counted: np.ndarray, loss: np.ndarray, patience: int) -> bool:
        """Goes on with the sums of a pass; False when the tree, or the fit, is finished."""
        if self.depth == 0:
            if self.fit.held_out and loss[1]:
                self.losses.append(float(loss[0] / loss[1]))
                if best_round(self.losses, patience) + patience <= len(self.losses):
                    self.done = True
            if self.done or self.full():
                self.done = True
                return False
        if self.grow(counted, self.depth):
            self.depth += 1
            return True
        self.close()
        return False

    def _open_sums(self, counted: np.ndarray) -> np.ndarray:
        """The sums of the open nodes, from those of the counted ones: a sibling has what its parent has beyond them."""
        known = dict(zip(self.counted, counted))
        for parent, child, sibling in self.pairs:
            rest = parent - known[child]
            known[sibling] = np.where(rest[..., 2:] > 0, rest, 0.0)
        return np.stack([known[node] for node in self.open])

    def grow(self, counted: np.ndarray, depth: int) -> bool:
        """Splits the open nodes; False when the tree is finished."""
        params = self.fit.params
        sums = self._open_sums(counted)
        nominal = self.chosen.index(self.features - 1) if self.chosen[-1] == self.features - 1 else -1
        if depth == 0:
            total = sums[0, 0].sum(axis=0)
            self.tree.value[0] = float(leaf_value(total[0], total[1], params))
        found = [(s, node, own) for s, node, own in zip(best_splits(sums, params, nominal), self.open, sums) if s]
        found.sort(key=lambda x: -x[0][0])
        opened: list[int] = []
        self.counted, self.pairs = [], []
        for (_, f, goes, *sides), node, own in found[: params.most_leaves - self.leaves]:
            self.leaves += 1
            self.tree.feature[node], self.tree.goes_left[node] = self.chosen[f], goes
            children = [self.tree.add(float(leaf_value(s[0], s[1], params))) for s in sides]
            self.tree.left[node], self.tree.right[node] = children
            large = [c for c, s in zip(children, sides) if s[2] >= 2 * max(1, params.min_instances)]
            if large:
                child, sibling = sorted(children, key=lambda c: sides[children.index(c)][2])
                self.counted.append(child)
                self.pairs.append((own, child, sibling))
                opened += large
        self.open = sorted(opened)
        return bool(self.open) and depth + 1 < params.max_depth and self.leaves < params.most_leaves

    def close(self) -> None:
        """A tree without a split ends the fit: no later one could find a split, unless rows or features are drawn."""
        params = self.fit.params
        if len(self.tree.feature) == 1 and params.subsampling >= 1 and params.feature_share >= 1:
            self.done = True
        else:
            self.trees.append(self.tree)
        self.tree, self.open, self.counted, self.pairs = None, [], [], []


def _fixed(column: pa.Array, width: int, kind) -> np.ndarray:
    """Binary values of ``width`` items each as a matrix."""
    if not len(column):
        return np.empty((0, width), kind)
    size = width * np.dtype(kind).itemsize
    fixed = column.cast(pa.binary(size))
    return np.frombuffer(fixed.buffers()[1], kind, len(column) * width, fixed.offset * size).reshape(-1, width)


def _drawn(row_hash: np.ndarray, seed: int, share: float) -> np.ndarray:
    x = row_hash.view(np.uint64) ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * 2**64) if share < 1 else 2**64 - 1)


@dataclass
class _Asked:
    """What a pass needs of one fit."""

    number: int
    learn: tuple[int, ...]
    held_out: tuple[int, ...]
    tree: tuple
    counted: list[int]
    chosen: list[int]
    row_seed: int
    share: float
    wants_loss: bool

    def shape(self, widths: Sequence[int]) -> tuple[int, int, int]:
        """Of its sums: (gradient, curvature, rows), counted node, bins of all chosen features."""
        return 3, len(self.counted), sum(widths[f] for f in self.chosen)

    def by_bin(self, sums: np.ndarray, widths: Sequence[int], scale: float) -> np.ndarray:
        """(counted node, chosen feature, bin, 3) of sums of the shape above."""
        full, start = np.zeros((len(self.counted), len(self.chosen), max(widths), 3)), 0
        for k, f in enumerate(self.chosen):
            full[:, k, : widths[f]] = sums[:, :, start : start + widths[f]].transpose(1, 2, 0) / [scale, scale, 1.0]
            start += widths[f]
        return full

    def on_the_way(self) -> set[int]:
        """The counted nodes and all above them."""
        above = {c: node for side in self.tree[2:4] for node, c in enumerate(side) if c}
        wanted = set()
        for node in self.counted:
            while node not in wanted:
                wanted.add(node)
                node = above.get(node, 0)
        return wanted


class _Cells:
    """Features in joint cells: a byte per row and bundle of features, from which the bin of every feature of the bundle follows."""

    def __init__(self, widths: Sequence[int]):
        self.widths, self.bundles = list(widths), _bundles(widths)
        self.sizes = [math.prod(widths[f] for f in b) for b in self.bundles]
        self.place = {}
        for j, bundle in enumerate(self.bundles):
            found = np.unravel_index(np.arange(self.sizes[j]), [widths[f] for f in bundle])
            self.place |= {f: (j, of_cell) for f, of_cell in zip(bundle, found)}

    def of(self, codes: np.ndarray) -> np.ndarray:
        """(bundle, row) of cells; codes: (row, feature)."""
        out = np.empty((len(self.bundles), len(codes)), np.uint8)
        for j, bundle in enumerate(self.bundles):
            cell = codes[:, bundle[0]].astype(np.intp)
            for f in bundle[1:]:
                cell = cell * self.widths[f] + codes[:, f]
            out[j] = cell
        return out

    def used(self, a: _Asked) -> list[int]:
        return [j for j, b in enumerate(self.bundles) if set(b) & set(a.chosen)]

    def apart(self, sums: dict[int, np.ndarray], a: _Asked) -> np.ndarray:
        """Sums by cell of every bundle as sums by bin of every chosen feature."""
        by_feature = {}
        for j, total in sums.items():
            cube = total.reshape(3, len(a.counted), *[self.widths[f] for f in self.bundles[j]])
            for axis, f in enumerate(self.bundles[j]):
                by_feature[f] = cube.sum(axis=tuple(2 + x for x in range(len(self.bundles[j])) if x != axis))
        return np.concatenate([by_feature[f] for f in a.chosen], axis=2)

    def tree(self, tree: tuple) -> tuple:
        """A tree that asks for cells instead of bins."""
        feature, table, *rest = tree
        asked, goes = list(feature), np.zeros((len(feature), max(self.sizes)), bool)
        for k, f in enumerate(feature):
            if f >= 0:
                asked[k], of_cell = self.place[f]
                goes[k, : len(of_cell)] = table[k][of_cell]
        return asked, goes, *rest


_DEALT = "label binary, part binary, row_hash binary, cells binary"
_DEALT_TYPES = {"label": np.int32, "part": np.int32, "row_hash": np.int64, "cells": np.uint8}


def _blocks(rows: BinnedRows, n: int, bases: list[float]) -> tuple[RDD, int]:
    """The rows in blocks, every fit at its start, and the number of tasks they are dealt to.

    A block is (label, part, row_hash, cells, margins); cells: (bundle, row), margins: (fit, row).
    """
    features, cells = len(rows.bins.widths), _Cells(rows.bins.widths)
    cores = rows.table.sparkSession.sparkContext.defaultParallelism
    tasks = _tasks(n, len(cells.bundles), len(bases), cores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def packed() -> pa.RecordBatch:
            given = {c: np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("label", "part", "row_hash")}
            given["cells"] = cells.of(np.concatenate([_fixed(p.column("bins"), features, np.uint8) for p in parts]))
            flat = [np.ascontiguousarray(given[c], t).tobytes() for c, t in _DEALT_TYPES.items()]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in flat], names=list(_DEALT_TYPES))

        for batch in batches:
            parts.append(batch)
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield packed()
                parts, held = [], 0
        if held:
            yield packed()

    def opened(row) -> tuple:
        label, part, row_hash, cell = (np.frombuffer(row[c], t) for c, t in _DEALT_TYPES.items())
        return label, part, row_hash, cell.reshape(-1, len(label)), np.repeat(np.array(bases)[:, None], len(label), axis=1)

    dealt = rows.table.select("label", "part", "row_hash", "bins").repartition(tasks)
    return dealt.mapInArrow(run, _DEALT).rdd.map(opened), tasks


def _tasks(n: int, bundles: int, fits: int, cores: int) -> int:
    """Tasks that ``n`` rows are dealt to: a task a core if each of them can hold its share, else as many as blocks of ``TASK_BYTES`` need."""
    waves = 1 if n * (bundles + 16 + HELD_ROW * fits) <= cores * HELD_BYTES else math.ceil(n * (bundles + 16 + 8 * fits) / (cores * TASK_BYTES))
    return max(1, min(cores * waves, math.ceil(n / TASK_ROWS)))


def _bundles(widths: Sequence[int]) -> list[list[int]]:
    """Features of few bins, to be counted together by all combinations of their bins, then summed up for each."""
    out: list[tuple[int, list[int]]] = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        k = next((k for k, (size, _) in enumerate(out) if size * widths[f] <= JOINT_CELLS), None)
        if k is None:
            out.append((widths[f], [f]))
        else:
            out[k] = out[k][0] * widths[f], [*out[k][1], f]
    return [features for _, features in out]


def _among(part: np.ndarray, parts: Sequence[int]) -> np.ndarray:
    out = np.zeros(len(part), bool)
    for p in parts:
        out |= part == p
    return out


def _scale(n: int) -> float:
    return 2.0 ** (52 - max(1, n).bit_length())


def _pass(blocks: RDD, tasks: int, asked: list[_Asked], bins: Bins, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """fit -> (sums, [held-out loss, held-out rows]) over all ``n`` rows; sums: (counted node, chosen feature, bin, 3).

    Gradients and curvatures are added as whole multiples of a power of two, so small that the sums of all rows stay exact: they do not
    depend on how rows are dealt to tasks, and features that part the rows alike have the same gain, of which the first one wins.
    """
    scale = _scale(n)
    shared = blocks.context.broadcast(asked)  # a tree of every fit
    widths = bins.widths

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        todo: list[_Asked] = shared.value
        cells = _Cells(widths)
        sizes = cells.sizes
        joint_sums = {a.number: {j: np.zeros((3, len(a.counted) * sizes[j])) for j in cells.used(a)} for a in todo}
        losses = {a.number: np.zeros(2) for a in todo}
        wanted = {a.number: a.on_the_way() for a in todo}
        trees = {a.number: cells.tree(a.tree) for a in todo}
        for label, part, hashes, joint, margins in given:
            chosen = {parts: _among(part, parts) for a in todo for parts in (a.learn, a.held_out)}
            for a in todo:
                margin, learns = margins[a.number], chosen[a.learn]
                if a.wants_loss:
                    h = np.flatnonzero(chosen[a.held_out])
                    losses[a.number] += np.logaddexp(0, np.where(label[h] == 1, -margin[h], margin[h])).sum(), len(h)
                if a.share < 1:
                    learns = learns & _drawn(hashes, a.row_seed, a.share)
                found = dict(ends(trees[a.number], joint, np.flatnonzero(learns), wanted[a.number]))
                groups = [found.get(node, np.empty(0, np.intp)) for node in a.counted]
                order = np.concatenate(groups)
                node = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
                p = 1 / (1 + np.exp(-margin[order]))
                values = [np.rint((p - label[order]) * scale), np.rint(p * (1 - p) * scale), None]
                for j, total in joint_sums[a.number].items():
                    cell = node * sizes[j] + joint[j][order]
                    for k, weights in enumerate(values):
                        total[k] += np.bincount(cell, weights, total.shape[1])
        for a in todo:
            yield a.number, (cells.apart(joint_sums[a.number], a), losses[a.number])

    found = blocks.mapPartitions(run)
    cells = {a.number: a.shape(widths) for a in asked}
    if tasks * sum(8 * math.prod(s) for s in cells.values()) > DRIVER_SUMS:
        found = found.reduceByKey(lambda x, y: (x[0] + y[0], x[1] + y[1]), len(asked))
    added = {n: (np.zeros(s), np.zeros(2)) for n, s in cells.items()}
    for number, (some, some_loss) in found.collect():
        sums, loss = added[number]
        sums += some
        loss += some_loss
    shared.destroy()
    return {a.number: (a.by_bin(added[a.number][0], widths, scale), added[a.number][1]) for a in asked}


# --- rounds in tasks that hold their blocks -----------------------------------------------------------


class _Held:
    """A block in the memory of a task: its margins move with every tree, the rows of open nodes with every level."""

    def __init__(self, block: tuple):
        self.label, self.part, self.row_hash, self.joint, margins = block
        self.margins = margins.copy()
        self.slopes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.open: dict[int, dict[int, np.ndarray]] = {}

    def move(self, number: int, tree: tuple) -> None:
        for node, at in ends(tree, self.joint, np.arange(len(self.label))):
            self.margins[number, at] += tree[4][node]

    def start(self, a: _Asked, scale: float) -> np.ndarray:
        """Gradients and curvatures of a new round; the held-out loss and its rows."""
        margin, learns = self.margins[a.number], _among(self.part, a.learn)
        h = np.flatnonzero(_among(self.part, a.held_out)) if a.wants_loss else np.empty(0, np.intp)
        loss = np.logaddexp(0, np.where(self.label[h] == 1, -margin[h], margin[h])).sum()
        if a.share < 1:
            learns = learns & _drawn(self.row_hash, a.row_seed, a.share)
        p = 1 / (1 + np.exp(-margin))
        self.slopes[a.number] = np.rint((p - self.label) * scale), np.rint(p * (1 - p) * scale)
        self.open[a.number] = {0: np.flatnonzero(learns).astype(np.int32)}
        return np.array([loss, len(h)])

    def descend(self, number: int, tree: tuple) -> None:
        feature, goes, left, right, _ = tree
        below = {}
        for node, rows in self.open[number].items():
            if feature[node] >= 0:
                down = goes[node][self.joint[feature[node]][rows]]
                below[left[node]], below[right[node]] = rows[down], rows[~down]
        self.open[number] = below

    def count(self, a: _Asked, sums: dict[int, np.ndarray], sizes: Sequence[int]) -> None:
        groups = [self.open[a.number].get(node, np.empty(0, np.int32)) for node in a.counted]
        order = np.concatenate(groups).astype(np.intp)
        node = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        values = [*(x.take(order) for x in self.slopes[a.number]), None]
        for j, total in sums.items():
            cell = self.joint[j].take(order)
            cell = node * sizes[j] + cell if len(groups) > 1 else cell.astype(np.intp)
            for k, weights in enumerate(values):
                total[k] += np.bincount(cell, weights, total.shape[1])


def _put(path: str, content: bytes) -> None:
    """A file that others see whole or not at all."""
    with open(f"{path}.part", "wb") as out:
        out.write(content)
    os.rename(f"{path}.part", path)


def _awaited(path: str, spans: Sequence[tuple[int, int]] | None = None):
    """The content of a file, or (first byte, bytes) of it, as soon as another task has put it there."""
    until = time.monotonic() + LONGEST_WAIT
    while True:
        try:
            with open(path, "rb") as source:
                if spans is None:
                    return source.read()
                return [source.read(size) for first, size in spans if source.seek(first) == first]
        except FileNotFoundError:
            if time.monotonic() > until:
                raise
            time.sleep(0.0005)


def _in_held_blocks(given: Iterator[tuple], growing: list[_Growing], bins: Bins, n: int, patience: int, rounds: int, folder: str) -> Iterator[_Growing]:
    """A task of a barrier stage: at most ``rounds`` trees more of every fit, and at the end the fits that are this task's own.

    Every task counts its rows for all fits. Every fit has one task that adds the sums of all tasks, decides its splits and tells
    them. Sums and splits pass through small files of the shared folder, which tasks wait for: Spark's own ``barrier`` and ``allGather`` look for
    an answer once a second.
    """
    context = BarrierTaskContext.get()
    me, tasks = context.partitionId(), len(context.getTaskInfos())
    widths, cells, scale = bins.widths, _Cells(bins.widths), _scale(n)

    def next_tree(g: _Growing) -> _Asked | None:
        g.done = g.done or (not g.fit.held_out and g.full())
        if g.done or len(g.trees) >= rounds:
            return None
        g.start()
        return g.asks(bins.width)

    # a stage that is tried again must not meet the files of the try before
    folder = f"{folder}/{context.allGather(os.urandom(8).hex())[0]}"
    os.makedirs(folder, exist_ok=True)
    blocks = [_Held(block) for block in given]
    mine = {g.number: g for k, g in enumerate(growing) if k % tasks == me}
    news = {number: (None, next_tree(g)) for number, g in mine.items()}
    passes = 0
    while True:
        if mine:
            _put(f"{folder}/told-{passes}-{me}", pickle.dumps(news))
        todo: list[_Asked] = []
        said = [pickle.loads(_awaited(f"{folder}/told-{passes}-{task}")) for task in range(min(tasks, len(growing)))]
        for number, (tree, ask) in sorted(x for some in said for x in some.items()):
            for block in blocks if tree else ():
                block.move(number, cells.tree(tree))
            todo += [ask] if ask else []
        # who tells this has read all sums of the pass before, and who sent those has read what was told before
        for name in [f"sums-{passes - 1}-{me}", *([f"told-{passes - 1}-{me}"] if mine else [])] if passes else ():
            os.unlink(f"{folder}/{name}")
        if not todo:
            break
        parts = []
        for a in todo:
            sums = {j: np.zeros((3, len(a.counted) * cells.sizes[j])) for j in cells.used(a)}
            loss, tree, first = np.zeros(2), cells.tree(a.tree), a.counted == [0]
            for block in blocks:
                if first:
                    loss += block.start(a, scale)
                else:
                    block.descend(a.number, tree)
                block.count(a, sums, cells.sizes)
            parts += [cells.apart(sums, a).ravel(), loss]
        _put(f"{folder}/sums-{passes}-{me}", np.concatenate(parts).tobytes())
        added, place = {a.number: np.zeros(math.prod(a.shape(widths)) + 2) for a in todo}, {}
        for a in todo:
            place[a.number] = 8 * sum(len(added[k]) for k in place)
        own = [a.number for a in todo if a.number in mine]
        for task in range(tasks if own else 0):
            parts = _awaited(f"{folder}/sums-{passes}-{task}", [(place[k], 8 * len(added[k])) for k in own])
            for k, part in zip(own, parts):
                added[k] += np.frombuffer(part)
        news = {}
        for a in todo:
            if a.number in mine:
                g, before = mine[a.number], len(mine[a.number].trees)
                sums, loss = added[a.number][:-2].reshape(a.shape(widths)), added[a.number][-2:]
                if g.take(a.by_bin(sums, widths, scale), loss, patience):
                    news[a.number] = None, g.asks(bins.width)
                else:
                    grown = g.trees[-1].arrays(bins.width) if len(g.trees) > before else None
                    news[a.number] = grown, next_tree(g)
        passes += 1
    yield from mine.values()


def _hold(spark: SparkSession, blocks: RDD, active: list[_Growing], bins: Bins, n: int, patience: int) -> dict[int, _Growing]:
    """The fits after up to ``HELD_ROUNDS`` rounds more in a barrier stage; their earlier trees stay on the driver."""
    lean = []
    for g in active:
        lean.append(copy(g))
        lean[-1].trees, lean[-1].earlier = [], len(g.trees)
    shared = blocks.context.broadcast(lean)
    path = fresh_path(spark, "sums")
    folder, rounds = _local(spark, path), HELD_ROUNDS

    def run(given: Iterator[tuple]) -> Iterator[_Growing]:
        return _in_held_blocks(given, shared.value, bins, n, patience, rounds, folder)

    try:
        found = {g.number: g for g in blocks.barrier().mapPartitions(run).collect()}
    finally:
        remove(spark, path)
    shared.destroy()
    for g in active:
        found[g.number].trees, found[g.number].earlier = g.trees + found[g.number].trees, 0
    return found


def _local(spark: SparkSession, path: str) -> str | None:
    """``path`` as the tasks' file system knows it, None if the shared folder is of another kind."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(name).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _may_hold(spark: SparkSession, tasks: int) -> bool:
    """Whether all tasks can run at once, which a barrier stage needs, and share files."""
    context = spark.sparkContext._jsc.sc()
    slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    fixed = spark.conf.get("spark.dynamicAllocation.enabled", "false") != "true"
    return fixed and tasks <= slots and _local(spark, work_dir(spark)) is not None


def _advanced(blocks: RDD, grown: dict[int, list[tuple]], widths: Sequence[int]) -> RDD:
    """The blocks with their margins after the given trees."""

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        cells = _Cells(widths)
        moved = [(number, cells.tree(tree)) for number, trees in grown.items() for tree in trees]
        for label, part, row_hash, joint, before in given:
            margins, rows = before.copy(), np.arange(len(label))
            for number, tree in moved:
                for node, at in ends(tree, joint, rows):
                    margins[number, at] += tree[4][node]
            yield label, part, row_hash, joint, margins

    return blocks.mapPartitions(run, preservesPartitioning=True)


def _forget(spark: SparkSession, blocks: RDD) -> None:
    """Removes the files of blocks that nothing starts from any more."""
    path = blocks.getCheckpointFile()
    if path:
        remove(spark, path)


def _free(spark: SparkSession, older: list[RDD], written: list[RDD]) -> None:
    """Blocks that nothing starts from any more: those before the last ones, and files before the last written ones."""
    while older:
        older.pop().unpersist()
    while len(written) > 1:
        _forget(spark, written.pop(0))


def boost(rows: BinnedRows, fits: Sequence[Fit], cfg: Settings, store_every: int = 10) -> list[BoostedTrees]:
    """All fits, one tree a round each, until their own end: ``most`` trees, or patience with the held-out loss.

    Only sums per counted node, feature and bin come to the driver (bounded by the parameters). Margins are the only state. They go
    from round to round as persisted blocks and are written every ``store_every`` rounds, so a lost executor costs at most the
    trees since then. After ``JOB_ROUNDS`` rounds, with ``MANY_ROWS`` from the first one on, tasks hold the blocks for ``HELD_ROUNDS`` rounds at a
    time (if all can run at once), and they are written between; the trees are the same.
    """
    bins = rows.bins
    # label totals per part: as many rows as parts
    totals = {r["part"]: (r["pos"] or 0, r["n"]) for r in rows.table.groupBy("part").agg(
        F.sum("label").alias("pos"), F.count("*").alias("n")).collect()}
    growing = []
    for number, fit in enumerate(fits):
        pos = sum(totals.get(p, (0, 0))[0] for p in fit.learn)
        n = sum(totals.get(p, (0, 0))[1] for p in fit.learn)
        rate = min(max(pos / n, 1e-6), 1 - 1e-6) if n else 0.5
        growing.append(_Growing(number, fit, math.log(rate / (1 - rate)), cfg.seed, len(bins.features) + 1))
        growing[-1].done = not n
    n = sum(n for _, n in totals.values())
    spark = rows.table.sparkSession
    work_dir(spark)  # where blocks are written
    state, tasks = _blocks(rows, n, [g.base for g in growing])
    state = state.persist(KEPT)
    older, written, rounds, in_turn = [], [], 0, False
    while True:
        for g in growing:
            g.done = g.done or (not g.fit.held_out and g.full())
        active = [g for g in growing if not g.done]
        if not active:
            break
        if rounds:
            older.append(state)
            state = _advanced(state, {g.number: [t.arrays(bins.width) for t in g.trees[g.stored :]] for g in active}, bins.widths)
            state = state.persist(KEPT)
            if in_turn or rounds % store_every == 0:
                state.checkpoint()
                written.append(state)
            for g in active:
                g.stored = len(g.trees)
        rounds += 1
        in_turn = (rounds > JOB_ROUNDS or n * len(active) > MANY_ROWS) and _may_hold(spark, state.getNumPartitions())
        if in_turn:
            found = _hold(spark, state, active, bins, n, cfg.patience)
            growing = [found.get(g.number, g) for g in growing]
            _free(spark, older, written)
            continue
        for g in active:
            g.start()
        while active:
            asked = [g.asks(bins.width) for g in active]
            sums = _pass(state, tasks, asked, bins, n)
            _free(spark, older, written)
            active = [g for g in active if g.take(*sums[g.number], cfg.patience)]
    state.unpersist()
    for blocks in written:
        _forget(spark, blocks)
    models = []
    for g in growing:
        best = max(1, best_round(g.losses, cfg.patience) - 1) if g.losses else len(g.trees)
        models.append(BoostedTrees(bins, g.fit.params, g.base, g.trees[:best], g.losses))
    return models


# --- scores and tables of fitted models ---------------------------------------------------------------


def scores_by_part(rows: BinnedRows, models: dict[int, BoostedTrees], keep: Sequence[str]) -> DataFrame:
    """Rows of the given parts, each scored by the model of its part: kept columns and ``score``."""
    shared = rows.table.sparkSession.sparkContext.broadcast(models)
    features = len(rows.bins.features) + 1
    schema = StructType([rows.table.schema[c] for c in keep]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, part = _fixed(batch.column("bins"), features, np.uint8), batch.column("part").to_numpy()
            score = np.empty(batch.num_rows)
            for k, model in shared.value.items():
                mine = part == k
                score[mine] = 1 / (1 + np.exp(-model.margins(codes[mine])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)], names=[*keep, "score"])

    chosen = rows.table.filter(F.col("part").isin(list(models)))
    return chosen.select(*dict.fromkeys([*keep, "part", "bins"])).mapInArrow(run, schema)


def scores_of_all(rows: BinnedRows, models: Sequence[BoostedTrees], part: int, keep: Sequence[str]) -> DataFrame:
    """Rows of one part with the score of every model: kept columns, ``trial`` and ``score``."""
    shared = rows.table.sparkSession.sparkContext.broadcast(list(models))
    features = len(rows.bins.features) + 1
    schema = StructType([rows.table.schema[c] for c in keep]).add("trial", "integer").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _fixed(batch.column("bins"), features, np.uint8)
            for k, model in enumerate(shared.value):
                score = pa.array(1 / (1 + np.exp(-model.margins(codes))))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], pa.array(np.full(len(codes), k, np.int32)), score], names=[*keep, "trial", "score"])

    return rows.table.filter(F.col("part") == part).select(*dict.fromkeys([*keep, "bins"])).mapInArrow(run, schema)


def score_frame(model: BoostedTrees, rows: DataFrame, keep: Sequence[str], name: str = "score") -> DataFrame:
    """Any rows with the features' columns: kept columns as they were, and the probability of 1."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = StructType([rows.schema[c] for c in keep]).add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = 1 / (1 + np.exp(-shared.value.margins(shared.value.bins.numbers(batch))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)], names=[*keep, name])

    return rows.select(*keep, *model.bins.columns()).mapInArrow(run, schema)


def loss_history(spark: SparkSession, models: Sequence[BoostedTrees]) -> DataFrame:
    """(model, trees, loss, best): the held-out loss after every round; ``best`` marks the number of trees kept."""
    rows = [(k, t, loss, t == len(m.trees)) for k, m in enumerate(models) for t, loss in enumerate(m.losses)]
    return spark.createDataFrame(rows, "model int, trees int, loss double, best boolean")


def split_table(spark: SparkSession, models: Sequence[BoostedTrees], names: Sequence[str]) -> DataFrame:
    """(model, feature, splits), zeros included: how often each feature is asked for in the trees of each model."""
    rows = []
    for k, model in enumerate(models):
        counts = np.bincount([f for tree in model.trees for f in tree.feature if f >= 0], minlength=len(names)) if model.trees else np.zeros(len(names))
        rows += [(k, name, int(n)) for name, n in zip(names, counts)]
    return spark.createDataFrame(rows, "model int, feature string, splits bigint")
