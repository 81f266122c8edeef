"""Benchmark decontamination: passages of documents within a word edit distance of a benchmark item.

Windows of an item's length are embedded by CGK random walks: a pointer moves over the words and, at every
step, stays or advances by a random bit of the word under it, so that few edits change few of the visited
words. Each of several walks is sampled at few steps, many times; windows and items that agree in one
sample are candidates, and an exact edit distance with free ends decides. Edits shift a walk more and more, so long
items are looked up by pieces, of which one at least keeps to the allowed share of edits; the whole item is compared.

Before they are embedded, windows pass the q-gram count bound: within the allowed edits a window of the piece's
length keeps a known number of the benchmark's word pairs. The bound loses nothing and spares most windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import Hasher, chain, flat, mix, prepare, release, slabs, whole_texts, word_spans

# Letters and digits (and all bytes of non-ASCII characters) form words, in lower case.
_PLAIN = np.full(256, 32, np.uint8)
for _b in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _PLAIN[_b] = _b
_PLAIN[65:91] = np.arange(97, 123)
BLOCK_BYTES = 32 << 20


@dataclass(frozen=True)
class LeakSettings:
    """``agreement`` is the assumed share of embedded steps on which a piece and a copy at the similarity limit agree
    at least; with it the samples give the target recall, which tests measure. Pieces have about ``piece_words``."""

    similarity: float = 0.8
    least_words: int = 5
    target_recall: float = 0.99
    agreement: float = 0.4
    sampled: int = 3
    walks: int = 6
    piece_words: int = 30

    @property
    def samples(self) -> int:
        """Samples per walk."""
        tries = math.log(1 - self.target_recall) / math.log(1 - self.agreement**self.sampled)
        return math.ceil(tries / self.walks)

    def edits(self, words: int) -> int:
        return int((1 - self.similarity) * words + 1e-9)


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word."""
    data, offsets = flat(column)
    data = _PLAIN[data]
    starts, ends, text = word_spans(data, offsets)
    return Hasher(data).spans(starts, ends), text


def embed(windows: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """The first steps of the CGK embedding of rows of word hashes; a row ends with words of no text."""
    rows, words = windows.shape
    padded = np.concatenate([windows, np.zeros((rows, 1), np.uint64)], axis=1)
    out = np.empty((rows, steps), np.uint64)
    at, row = np.zeros(rows, np.int64), np.arange(rows)
    draws = mix(np.arange(steps, dtype=np.uint64) + np.uint64(1 + (walk << 32)))
    for j in range(steps):
        seen = padded[row, at]
        out[:, j] = seen
        at = np.minimum(at + (mix(seen ^ draws[j]) & np.uint64(1)).astype(np.int64), words)
    return out


def sample_keys(embedded: list[np.ndarray], size: int, cfg: LeakSettings) -> np.ndarray:
    """A column of keys per walk and sample, for items of ``size`` words or a little more.

    A walk passes about half a word a step, so steps are drawn from the first ``1.5 * size``.
    """
    draw = np.random.default_rng(size)
    keys = []
    for walk, steps in enumerate(embedded):
        for s in range(cfg.samples):
            total = np.full(len(steps), (size << 16) + walk * cfg.samples + s, np.uint64)
            for j in draw.integers(0, int(1.5 * size), cfg.sampled):
                total = mix(total ^ steps[:, int(j)])
            keys.append(total)
    return np.stack(keys, axis=1)


def best_match(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any part of the passage, and where that part ends."""
    columns = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for i, word in enumerate(item, 1):
        step = np.minimum(row[:-1] + (passage != word), row[1:] + 1)
        new = np.concatenate([[i], step])
        row = np.minimum.accumulate(new - columns) + columns
    end = int(row.argmin())
    return int(row[end]), end


class ItemIndex:
    """Word sequences of a block of benchmark items, their pairs and their sample keys."""

    def __init__(self, ids: list, texts: list[str], cfg: LeakSettings):
        self.cfg = cfg
        self.items: list[tuple[object, np.ndarray]] = []
        hashes, text = words_of(pa.array(texts, pa.string()))
        counts = np.bincount(text, minlength=len(texts))
        for key, part in zip(ids, np.split(hashes, np.cumsum(counts)[:-1]) if len(texts) else []):
            if len(part) >= cfg.least_words:
                self.items.append((key, part))
        # (item, offset, words): if every piece had more than the allowed share of edits, so had the item
        self.pieces: list[tuple[int, int, np.ndarray]] = []
        for i, (_, part) in enumerate(self.items):
            at = 0
            for piece in np.array_split(part, max(1, round(len(part) / cfg.piece_words))):
                self.pieces.append((i, at, piece))
                at += len(piece)
        pairs = [chain(w, 2) for _, w in self.items]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.uint64)
        self.mask = np.uint64((1 << max(16, (64 * len(self.pairs)).bit_length())) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, bool)  # spares most binary searches
        self.maybe[(self.pairs & self.mask).astype(np.int64)] = True
        # pieces of similar length (up to a fifth more) form a class with common samples
        self.classes: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        self.needed: list[int] = []  # pairs that a window of the class keeps: need() is not monotonic
        sizes, low = sorted({len(w) for *_, w in self.pieces}), 0
        while low < len(sizes):
            size = sizes[low]
            top = max(n for n in sizes if n <= max(size, 1.2 * size))
            mine = [i for i, (*_, w) in enumerate(self.pieces) if size <= len(w) <= top]
            rows = np.zeros((len(mine), top), np.uint64)
            for r, i in enumerate(mine):
                rows[r, : len(self.pieces[i][2])] = self.pieces[i][2]
            self.needed.append(min(self.need(len(self.pieces[i][2])) for i in mine))
            keys = sample_keys([embed(rows, k, int(1.5 * size)) for k in range(cfg.walks)], size, cfg)
            owner = np.repeat(np.array(mine), keys.shape[1])
            order = np.argsort(keys.ravel(), kind="stable")
            self.classes.append((size, top, keys.ravel()[order], owner[order]))
            low = sizes.index(top) + 1

    def need(self, n: int) -> int:
        """Pairs of a piece of ``n`` words that a match keeps: an edit costs two."""
        return max(1, n - 1 - 2 * self.cfg.edits(n))

    def find(self, hashes: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, last word + 1) of the best match of every text and item."""
        if not len(self.pairs) or len(hashes) < 2:
            return []
        pairs = chain(hashes, 2)
        hit = self.maybe[(pairs & self.mask).astype(np.int64)] & (text[1:] == text[:-1])
        rare = np.flatnonzero(hit)
        at = np.minimum(np.searchsorted(self.pairs, pairs[rare]), len(self.pairs) - 1)
        hit[rare] = self.pairs[at] == pairs[rare]
        sums = np.concatenate([[0], np.cumsum(hit)])
        counts = np.bincount(text)
        ends = np.cumsum(counts)
        chosen = []
        for (size, top, *_), needed in zip(self.classes, self.needed):
            stop = np.minimum(np.arange(len(hit)) + top + self.cfg.edits(top) - 1, len(hit))
            starts = np.flatnonzero(sums[stop] - sums[:-1] >= needed)
            chosen.append(starts[ends[text[starts]] - starts >= size - self.cfg.edits(size)])
        every = np.unique(np.concatenate(chosen))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k in range(0, len(every), 4096):
            part = every[k : k + 4096]
            self._match(hashes, text, ends, counts, part, [np.isin(part, c) for c in chosen], best)
        return [(t, i, *v) for (t, i), v in sorted(best.items())]

    def _match(self, hashes, text, ends, counts, starts, member, best) -> None:
        """Embed the windows from ``starts`` once and look them up in every class they are a member of."""
        place = starts[:, None] + np.arange(self.classes[-1][1])
        inside = place < ends[text[starts]][:, None]
        windows = np.where(inside, hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0))
        embedded = [embed(windows, k, int(1.5 * self.classes[-1][0])) for k in range(self.cfg.walks)]
        found = set()
        for (size, _, keys, owner), mine in zip(self.classes, member):
            rows = np.flatnonzero(mine)
            if not len(rows):
                continue
            asked = sample_keys([e[rows] for e in embedded], size, self.cfg)
            low, high = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
            for r, c in zip(*np.nonzero(high > low)):
                start = int(starts[rows[r]])
                for i in owner[low[r, c] : high[r, c]]:
                    item, offset, _ = self.pieces[i]
                    found.add((int(text[start]), item, start - offset))
        done: dict[tuple[int, int], int] = {}
        for t, item, start in sorted(found):  # where the item starts, but for edits before the piece
            words = self.items[item][1]
            n, edits = len(words), self.cfg.edits(len(words))
            if start < done.get((t, item), start):  # this part was compared with the item
                continue
            begin, stop = int(ends[t] - counts[t]), int(ends[t])
            lo, hi = max(begin, start - n), min(stop, start + 2 * n + 3 * edits)
            done[t, item] = start + n
            if np.isin(words, hashes[lo:hi]).sum() < n - edits:  # an edit costs one word at most
                continue
            distance, end = best_match(words, hashes[lo:hi])
            if distance <= edits:
                last = lo + end - begin
                entry = (distance, max(0, last - n), last)
                if (t, item) not in best or entry < best[t, item]:
                    best[t, item] = entry


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of about 32 MB at most; an item longer than that is a block's own size."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = items.filter(block == k).collect()
        yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, cfg: LeakSettings | None = None) -> DataFrame:
    """doc_id, item_id, distance, item_words, similarity, first_word, last_word of every leaked item.

    One row per row of ``docs`` and item whose words occur in it with at most 20 % edits (the best match).
    The stated items are compared with all documents, a bounded block of items per pass; documents are
    not shuffled. Null texts are empty, repeated rows are reported each, items under five words are ignored.
    """
    cfg = cfg or LeakSettings()
    spark = prepare(docs.sparkSession)
    rows, out = whole_texts(docs), None
    for ids, texts in _blocks(benchmark):
        items = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*items.value, cfg)
            for batch in batches:
                for a, b in slabs(batch):
                    part = batch.slice(a, b - a)
                    found = index.find(*words_of(part.column("text")))
                    if not found:
                        continue
                    doc = part.column("doc_id").to_pylist()
                    sizes = [len(index.items[i][1]) for _, i, *_ in found]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc[f[0]] for f in found], pa.int64()),
                        pa.array([index.items[f[1]][0] for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.int32()), pa.array(sizes, pa.int32()),
                        pa.array([1 - f[2] / n for f, n in zip(found, sizes)], pa.float64()),
                        pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64()),
                    ], names=["doc_id", "item_id", "distance", "item_words", "similarity", "first_word", "last_word"])

        found = rows.mapInArrow(run, "doc_id bigint, item_id bigint, distance int, item_words int, similarity double, "
                                     "first_word bigint, last_word bigint")
        out = found if out is None else out.union(found)
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame, cfg: LeakSettings | None = None) -> DataFrame:
    """The rows of ``docs`` with all their columns in which no benchmark item was found."""
    cfg = cfg or LeakSettings()
    spark = prepare(docs.sparkSession)
    names, out = docs.columns, docs
    for ids, texts in _blocks(benchmark):
        items = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*items.value, cfg)
            for batch in batches:
                text = pa.array([t or "" for t in batch.column(names.index("text")).to_pylist()], pa.string())
                clean = np.ones(batch.num_rows, bool)
                for a, b in slabs(pa.table({"text": text})):
                    clean[[a + f[0] for f in index.find(*words_of(text.slice(a, b - a)))]] = False
                yield batch.filter(pa.array(clean))
            del index
            release()

        out = out.mapInArrow(run, docs.schema)
    return out
