"""N-gram Jaccard join: documents whose sets of five-word windows are alike, found by banded MinHash.

Texts with the same words are one text with a weight. Bands and rows follow from the wanted recall at the
threshold. Texts that share a band hash are linked to the least of their bucket only; the connected groups of these links
hold every candidate pair. Inside a group all pairs are verified on the full sets, in blocks of bounded bytes and texts, by
products of 0/1 matrices: a block pair returns link counts and stars of what it connects, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shoptrail.llm.common import Hasher, chain, flat, lower_ascii, mix, prepare, release, slabs, whole_texts, word_spans
from shoptrail.llm.components import components
from shoptrail.session import fits, materialize


@dataclass(frozen=True)
class JoinSettings:
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    rows: int = 5
    # A block of texts that are compared with each other at once: bytes of their windows, and texts.
    block_bytes: int = 4 << 20
    block_texts: int = 1024
    # A bucket or copied text with more than this share of all rows is joined by a broadcast.
    hot_share: int = 1000

    @property
    def bands(self) -> int:
        """As many bands as give the recall for a pair exactly at the threshold."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.rows))


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slab: number of its first text, hashes of all word windows, and their text numbers.

    Windows repeat as in the text. A text of fewer words has one window of all its words, an empty one none.
    """
    table = pa.table({"text": column})
    for first, last in slabs(table):
        data, offsets = flat(table.column("text").slice(first, last - first))
        data = lower_ascii(data)
        starts, ends, text = word_spans(data, offsets)
        hashes = Hasher(data).spans(starts, ends)
        windows = chain(hashes, words)
        whole = text[: len(windows)] == text[words - 1 :] if len(windows) else np.empty(0, bool)
        counts = np.bincount(text, minlength=last - first)
        short = np.flatnonzero((counts > 0) & (counts < words))
        extra = []
        begin = np.cumsum(counts) - counts
        for t in short:
            total = np.uint64(counts[t])
            for h in hashes[begin[t] : begin[t] + counts[t]]:
                total = mix(np.array([total ^ h], np.uint64))[0]
            extra.append(total)
        values = np.concatenate([windows[whole], np.array(extra, np.uint64)])
        owner = np.concatenate([text[: len(windows)][whole], short])
        order = np.argsort(owner, kind="stable")
        yield first, values[order], owner[order]


def fingerprints(column: pa.Array) -> list[str]:
    """128 bits of the lower-case words of every text in order; empty for a text without words."""
    out = []
    table = pa.table({"text": column})
    for first, last in slabs(table):
        data, offsets = flat(table.column("text").slice(first, last - first))
        data = lower_ascii(data)
        starts, ends, text = word_spans(data, offsets)
        hashes = Hasher(data).spans(starts, ends)
        counts = np.bincount(text, minlength=last - first)
        begin = np.cumsum(counts) - counts
        place = (np.arange(len(text)) - begin[text]).astype(np.uint64)
        sums = np.zeros((2, last - first), np.uint64)
        for k in range(2):  # sums of well mixed (word, place) pairs
            np.add.at(sums[k], text, mix(hashes + mix(place + np.uint64(1 + (k << 40)))))
        out += [f"{a:016x}{b:016x}" if n else "" for a, b, n in zip(*sums.tolist(), counts.tolist())]
    return out


def band_hashes(values: np.ndarray, owner: np.ndarray, texts: int, cfg: JoinSettings) -> np.ndarray:
    """A row of band hashes per text; texts without windows get zeros."""
    draw = np.random.default_rng(7)
    factors = draw.integers(0, 2**63, cfg.bands * cfg.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 2**63, cfg.bands * cfg.rows, dtype=np.uint64)
    bands = np.zeros((texts, cfg.bands), np.uint64)
    if not len(values):
        return bands
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    mine = owner[starts]
    for b in range(cfg.bands):
        total = np.full(len(mine), b, np.uint64)
        for k in range(b * cfg.rows, (b + 1) * cfg.rows):
            total = mix(total ^ np.minimum.reduceat(values * factors[k] + shifts[k], starts))
        bands[mine, b] = total
    return bands


def signatures(docs: DataFrame, cfg: JoinSettings) -> DataFrame:
    """doc_id, fp and bands (null without words) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            prints = fingerprints(column)
            bands = np.zeros((batch.num_rows, cfg.bands), np.uint64)
            for first, values, owner in shingle_sets(column, cfg.words):
                n = int(owner[-1]) + 1 if len(owner) else 0
                bands[first : first + n] = band_hashes(values, owner, n, cfg)
            rows = [x.tolist() if p else None for x, p in zip(bands.view(np.int64), prints)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints), pa.array(rows, pa.list_(pa.int64()))],
                names=["doc_id", "fp", "bands"])
        release()

    return whole_texts(docs).mapInArrow(run, "doc_id bigint, fp string, bands array<bigint>")


def _split_join(rows: DataFrame, counted: DataFrame, keys: list[str], total: int, share: int) -> DataFrame:
    """``rows`` joined with ``counted`` (keys, n, more columns), keys with more than a ``share``-th of the total by a broadcast.

    There are fewer than ``share`` such keys for each row of the total, whatever the size; the others are shuffled.
    """
    hot = counted.filter(F.col("n") > total / share)
    often = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(counted.filter(F.col("n") <= total / share), keys)
    return often.unionByName(rest)


def candidate_groups(texts: DataFrame, cfg: JoinSettings) -> DataFrame:
    """(node, component) of every text that shares a bucket with another; texts: node, bands (stored)."""
    hashed = texts.select("node", F.posexplode("bands").alias("band", "h"))
    buckets = hashed.groupBy("band", "h").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1")
    buckets = materialize(buckets, "buckets")
    met = _split_join(hashed, buckets, ["band", "h"], texts.count(), cfg.hot_share)
    return components(met.filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")))


def _windows(cfg: JoinSettings, once: bool):
    """Per row its fingerprint and distinct windows, as sorted 64-bit hashes; with ``once``, a text once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            column = batch.column("text")
            prints = fingerprints(column)
            if once:
                new = [k for k, p in enumerate(prints) if p and not (p in seen or seen.add(p))]
                batch, column, prints = batch.take(pa.array(new, pa.int64())), column.take(pa.array(new, pa.int64())), [prints[k] for k in new]
            sets = [b""] * batch.num_rows
            for first, values, owner in shingle_sets(column, cfg.words):
                cuts = np.flatnonzero(np.diff(owner)) + 1
                for part, t in zip(np.split(values, cuts), owner[np.append(0, cuts)] if len(owner) else []):
                    sets[first + int(t)] = np.unique(part).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.string()), pa.array(sets, pa.binary())], names=["doc_id", "fp", "windows"])

    return run


def full_sets(docs: DataFrame, chosen: DataFrame, cfg: JoinSettings) -> DataFrame:
    """The distinct windows of the chosen texts (doc_id, fp, node, weight, component).

    A text is fetched by its least doc_id; rows that repeat this id with other words are told apart by their fingerprint. Texts all
    of whose rows have no id are fetched by their fingerprint, each task sending a text once.
    """
    schema = "doc_id bigint, fp string, windows binary"
    texts = whole_texts(docs)
    known = chosen.filter("doc_id is not null")
    rows = texts.join(known.select("doc_id").distinct(), "doc_id", "left_semi")
    found = rows.mapInArrow(_windows(cfg, False), schema).dropDuplicates(["doc_id", "fp"]).join(known, ["doc_id", "fp"])
    nameless = texts.filter("doc_id is null").mapInArrow(_windows(cfg, True), schema).drop("doc_id")
    nameless = nameless.join(chosen.filter("doc_id is null").drop("doc_id"), "fp").dropDuplicates(["node"])
    columns = ["node", "weight", "component", "windows"]
    return found.select(*columns).union(nameless.select(*columns))


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections, from 0/1 matrices over the shared windows, some columns at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    row_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    row_b = np.repeat(np.arange(len(right)), [len(x) for x in right])
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    ok_a = at_a < len(shared)
    ok_a[ok_a] = shared[at_a[ok_a]] == a[ok_a]
    ok_b = at_b < len(shared)
    ok_b[ok_b] = shared[at_b[ok_b]] == b[ok_b]
    row_a, at_a, row_b, at_b = row_a[ok_a], at_a[ok_a], row_b[ok_b], at_b[ok_b]
    for k in range(0, len(shared), columns):
        x, y = (np.zeros((n, columns), np.float32) for n in (len(left), len(right)))
        m = (at_a >= k) & (at_a < k + columns)
        x[row_a[m], at_a[m] - k] = 1
        m = (at_b >= k) & (at_b < k + columns)
        y[row_b[m], at_b[m] - k] = 1
        out += x @ y.T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, decided in whole numbers (a threshold of at most six decimals)."""
    common = np.rint(overlaps(left, right)).astype(np.int64)
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    return (common > 0) & (common * 1_000_000 >= round(threshold * 1_000_000) * (sizes - common))


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """(node, least node) of what the links connect: a star per connected group of the block pair."""
    names, number = np.unique(np.concatenate([left, right]), return_inverse=True)
    rows, columns = number[: len(left)], number[len(left) :]
    least = np.arange(len(names), dtype=np.int32)
    far = np.int32(len(names))
    while True:  # labels fall to the least of their neighbours, then to their label's label
        new = least.copy()
        np.minimum.at(new, rows, np.where(links, least[columns][None, :], far).min(axis=1))
        np.minimum.at(new, columns, np.where(links, least[rows][:, None], far).min(axis=0))
        new = new[new]
        if (new == least).all():
            break
        least = new
    moved = np.flatnonzero(least != np.arange(len(names)))
    return list(zip(names[moved].tolist(), names[least[moved]].tolist()))


def verify(sets: DataFrame, cfg: JoinSettings) -> DataFrame:
    """Per block pair of a candidate group: rows (a, b null, links) with counts, and rows (a, b, whole) with stars.

    A group is cut into blocks by the bytes of its sets and the number of its texts; a text goes to one row per block pair of its
    block, and every pair of texts meets in exactly one. Stars of a group of one block (whole = 1) are final.
    """
    size = sets.groupBy("component").agg(F.greatest(
        F.ceil(F.sum(F.octet_length("windows")) / F.lit(cfg.block_bytes)),
        F.ceil(F.count("*") / F.lit(cfg.block_texts))).cast("int").alias("blocks"))
    # only groups of several blocks are told about it: at most one for so many bytes or texts
    several = materialize(size.filter("blocks > 1"), "large-groups")
    known = F.broadcast(several) if fits(several, 1_000_000) else several
    rows = sets.join(known, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("bigint")).cast("int")
    rows = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("component", "node", "weight", "windows", "block", "blocks",
                       F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        whole = int(table.column("blocks")[0].as_py() == 1)
        block, names, weights = (table.column(c).to_numpy() for c in ("block", "node", "weight"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("windows").to_pylist()]
        sides = [np.flatnonzero(block == k) for k in (low, high)]
        parts = []
        if all(len(s) for s in sides):
            links = linked([sets[i] for i in sides[0]], [sets[i] for i in sides[1]], cfg.threshold)
            if low == high:
                np.fill_diagonal(links, False)
            parts.append((names[sides[0]], links @ weights[sides[1]]))
            if low != high:
                parts.append((names[sides[1]], weights[sides[0]] @ links))
            stars = _forest(links, names[sides[0]], names[sides[1]])
        else:
            stars = []
        rows = [(n, None, c) for nodes, counts in parts for n, c in zip(nodes.tolist(), counts.tolist()) if c]
        rows += [(a, b, whole) for a, b in stars]
        del sets, parts
        release()
        return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    return rows.groupBy("component", "low", "high").applyInArrow(run, "a bigint, b bigint, links bigint")


def classes(docs: DataFrame, cfg: JoinSettings | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, class_id, class_size, n_links.

    class_id is the least doc_id of the class, n_links the number of other rows with a similarity of at
    least the threshold (copies count). A row without words (null or empty text) links to nothing
    and is its own class. Repeated and null ids are allowed: rows are told apart by their words. Other columns
    are ignored.
    """
    return _classes(docs, cfg or JoinSettings()).drop("component")


def _classes(docs: DataFrame, cfg: JoinSettings) -> DataFrame:
    signed = materialize(signatures(docs, cfg), "signatures")
    texts = signed.filter("fp <> ''").groupBy("fp").agg(
        F.count("*").alias("weight"), F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    texts = materialize(texts.withColumn("node", F.monotonically_increasing_id()), "texts")  # numbers fixed by the table
    groups = materialize(candidate_groups(texts.select("node", "bands"), cfg), "groups")
    chosen = texts.drop("bands").join(groups, "node")
    found = materialize(verify(materialize(full_sets(docs, chosen, cfg), "sets"), cfg), "links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    stars = found.filter("b is not null")
    # groups of one block are joined already; only those of several need another search for what hangs together
    joined = stars.filter("links = 1").select(F.col("a").alias("node"), F.col("b").alias("component"))
    joined = joined.union(components(stars.filter("links = 0").select("a", "b")))
    named = texts.drop("bands").join(joined, "node", "left").join(counts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    named = materialize(named, "named")
    totals = materialize(named.groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.sum("weight").alias("class_size"), F.count("*").alias("n")), "totals")
    table = _split_join(named, totals, ["component"], named.count(), cfg.hot_share).drop("n")
    table = materialize(table.select(
        "fp", "weight", "component", "class_id", "class_size", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    rows = signed.select("doc_id", "fp")
    worded = _split_join(rows.filter("fp <> ''"), table.withColumnRenamed("weight", "n"), ["fp"], signed.count(), cfg.hot_share)
    alone = rows.filter("fp = ''").select(
        "doc_id", "fp", F.lit(None).cast("bigint").alias("component"), F.col("doc_id").alias("class_id"),
        F.lit(1).cast("bigint").alias("class_size"), F.lit(0).cast("bigint").alias("n_links"))
    return worded.select(*alone.columns).union(alone)


def keep_one(docs: DataFrame, cfg: JoinSettings | None = None) -> DataFrame:
    """``docs`` with all its columns, one row of each class: that with the least doc_id.

    Rows without words all stay. Of rows with one id and the same words one stays.
    """
    found = _classes(docs, cfg or JoinSettings())
    firsts = found.filter("fp <> '' and doc_id <=> class_id")
    # two texts of a class may repeat its least id: the lesser fingerprint stays
    firsts = materialize(firsts.groupBy("component").agg(F.min(F.struct("doc_id", "fp")).alias("k")).select("k.*"), "kept")
    prepare(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(names.index("text"))
            prints = fingerprints(pa.array([t or "" for t in text.to_pylist()], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints)], names=[*batch.schema.names, mark])

    mark = "_fp"
    while mark in names:
        mark += "_"
    marked = docs.mapInArrow(run, StructType([*docs.schema.fields]).add(mark, StringType()))
    worded = marked.filter(F.col(mark) != "").dropDuplicates(["doc_id", mark])
    firsts = firsts.select(F.col("doc_id").alias("k_id"), F.col("fp").alias("k_fp"))
    kept = worded.join(firsts, worded["doc_id"].eqNullSafe(firsts["k_id"]) & (worded[mark] == firsts["k_fp"]), "left_semi")
    return kept.union(marked.filter(F.col(mark) == "")).drop(mark)
