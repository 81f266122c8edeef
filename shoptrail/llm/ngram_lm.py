"""Language-model scores from an Elias-Fano n-gram trie that is spread over shards.

The model is a hierarchy of Dirichlet-smoothed n-grams: the count of a trigram, with a prior weight on the bigram
probability, which has one on the base probability ``(c + 0.1) / (N + 0.1 (V + 1))``. With ``all_contexts`` the n-grams
behind every word are counted; otherwise contexts are words with at least ``context_share`` of the corpus, and behind
other words the lower order is used. Counts of frequent words are broadcast, those of the others come from the shards.

Batches of documents send their distinct n-grams, with the counts of their training documents, to shards chosen by context and, so
that a hot context is spread, by four bits of the next word. A shard adds the counts, quantises the log
probability of every n-gram to a byte, builds its trie and answers every key by a context-relative successor search. The
batches turn the answers into scores. Both steps read the same exchange of the documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import (
    Hasher,
    flat,
    id_remainder,
    lower_ascii,
    mix,
    prepare,
    slabs,
    text_bytes,
    whole_texts,
    word_spans,
)
from shoptrail.llm.elias_fano import ContextTrie
from shoptrail.session import materialize

BATCH_BYTES, SHARD_BYTES = 8 << 20, 24 << 20
HALF = 28  # bits of a context and of a word in a key, besides the bits that choose the shard
END = np.uint64(0x5DEECE66D5DEECE6)
LEVELS = (1, 2, 3)
STEP = 0.08  # width of a quantised class of ln(count)
_MESSAGE = pa.schema([("target", pa.int64()), ("batch", pa.int64()), ("payload", pa.binary())])
_DDL = "target bigint, batch bigint, payload binary"


@dataclass(frozen=True)
class LmSettings:
    held_out_of: int = 10
    context_share: float = 1e-6  # so the counts of at most a million words are broadcast
    all_contexts: bool = False  # n-grams behind all words, not only behind the broadcast ones
    bigram_prior: float = 1000.0
    trigram_prior: float = 2.0


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the end of every text, and the text number of each."""
    parts, owners = [], []
    table = pa.table({"text": texts})
    for a, b in slabs(table):
        data, offsets = flat(table.column("text").slice(a, b - a))
        data = lower_ascii(data)
        starts, ends, text = word_spans(data, offsets)
        hashes = np.concatenate([Hasher(data).spans(starts, ends), np.full(b - a, END)])
        owner = np.concatenate([text, np.arange(b - a)])
        order = np.argsort(owner, kind="stable")
        parts.append(hashes[order])
        owners.append(owner[order] + a)
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(parts), np.concatenate(owners)


def word_counts(rows: DataFrame) -> DataFrame:
    """(hash, n) of every distinct token of the training texts; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            words, counts = (np.concatenate(x) for x in zip(*held))
            distinct, inverse = np.unique(words, return_inverse=True)
            return distinct, np.bincount(inverse.ravel(), counts).astype(np.int64)

        def rows_of(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[1])], names=["hash", "n"])

        for batch in batches:
            words = token_hashes(batch.column("text"))[0]
            distinct, counts = np.unique(words, return_counts=True)
            held.append((distinct, counts))
            size += len(distinct)
            if size > 3_000_000:
                held = [added()]
                size = len(held[0][0])
                if size > 1_500_000:
                    yield rows_of(held[0])
                    held, size = [], 0
        if held:
            yield rows_of(added())

    return rows.filter("train").select("text").mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(
        F.sum("n").alias("n"))


class Tokens:
    """Tokens of one batch, and the keys of its n-grams."""

    def __init__(self, table: pa.Table, frequent: tuple[np.ndarray, np.ndarray], all_contexts: bool):
        self.all_contexts = all_contexts
        self.words, self.text = token_hashes(table.column("text").combine_chunks())
        names, counts = frequent
        at = np.minimum(np.searchsorted(names, self.words), max(len(names) - 1, 0))
        self.known = names[at] == self.words if len(names) else np.zeros(len(self.words), bool)
        self.count = np.where(self.known, counts[at] if len(names) else 0, 0)

    def keys(self, level: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the n-grams of a level, their targets and keys. Level 1 has the words that are not frequent."""
        w, n = self.words, len(self.words)
        if level == 1:
            place = np.flatnonzero(~self.known)
            context = mix(w[place])
        else:
            ok = np.zeros(n, bool)
            ok[level - 1 :] = self.text[level - 1 :] == self.text[: n - level + 1]
            for back in range(1, level) if not self.all_contexts else ():
                ok[back:] &= self.known[:-back]
            place = np.flatnonzero(ok)
            context = mix(w[place - 1] + np.uint64(level))
            if level == 3:
                context = mix(context + w[place - 2] * np.uint64(3))
        word = mix(w[place] + np.uint64(99))
        shard = mix((context >> np.uint64(32) << np.uint64(4)) | (word >> np.uint64(60))) % np.uint64(shards)
        low = np.uint64((1 << HALF) - 1)
        return place, shard.astype(np.int64) + level * shards, ((context & low) << np.uint64(HALF)) | (word & low)


def _squeeze(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on, by zstd: high bytes are mostly zero."""
    data = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _expand(data: bytes, kind: type) -> np.ndarray:
    plain = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    planes = np.frombuffer(plain, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_message(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys of 56 bits and their counts: steps of the upper two bytes and counts squeezed, the low five bytes
    as they are."""
    high = np.diff((keys >> np.uint64(40)).astype(np.int64), prepend=0).astype(np.uint16)
    low = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :5])
    parts = [_squeeze(high), _squeeze(counts.astype(np.uint32))]
    return b"".join([*(len(x).to_bytes(8, "little") for x in parts), *parts, low.tobytes()])


def unpack_message(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    a, b = (int.from_bytes(data[k : k + 8], "little") for k in (0, 8))
    high, counts = _expand(data[16 : 16 + a], np.uint16), _expand(data[16 + a : 16 + a + b], np.uint32)
    low = np.zeros((len(high), 8), np.uint8)
    low[:, :5] = np.frombuffer(data, np.uint8, 5 * len(high), 16 + a + b).reshape(len(high), 5)
    return low.view(np.uint64).ravel() | (np.cumsum(high.astype(np.uint64)) << np.uint64(40)), counts.astype(np.int64)


def distinct_keys(target: np.ndarray, key: np.ndarray):
    """Distinct (target, key) pairs in order: their target, key, and the pair of every n-gram."""
    order = np.lexsort((key, target))
    t, k = target[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    return t[new], k[new], pair


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_MESSAGE)], schema=_MESSAGE)


def ask(shards: int, frequent, all_contexts: bool) -> Callable:
    """A row per batch and shard: the distinct keys and their counts in the batch's training texts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tokens, rows = Tokens(table, frequent.value, all_contexts), []
        train = table.column("train").to_numpy()[tokens.text]
        for level in LEVELS:
            place, target, keys = tokens.keys(level, shards)
            if not len(place):
                continue
            targets, distinct, pair = distinct_keys(target, keys)
            counts = np.bincount(pair, train[place], len(targets))
            cuts = np.flatnonzero(np.diff(targets, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(targets))):
                rows.append((int(targets[a]), key[0].as_py(), pack_message(distinct[a:b], counts[a:b])))
        return _rows(rows)

    return run


def quantise(counts: np.ndarray) -> np.ndarray:
    """A byte per count: its log probability (the common total left out) on a grid of ``STEP``; 1 is exact."""
    return (1 + np.minimum(np.rint(np.log(counts) / STEP), 254)).astype(np.uint8)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, np.exp(STEP * (codes.astype(np.float64) - 1)), 0.0)


def answer(shards: int) -> Callable:
    """Codes (level 1: exact counts) in the order of the asked keys."""

    def run(table: pa.Table) -> pa.Table:
        target, batch = table.column("target").to_pylist(), table.column("batch").to_pylist()
        asked = [unpack_message(p) for p in table.column("payload").to_pylist()]
        sizes = [len(keys) for keys, _ in asked]
        distinct, inverse = np.unique(np.concatenate([keys for keys, _ in asked]), return_inverse=True)
        totals = np.bincount(inverse.ravel(), np.concatenate([c for _, c in asked]), len(distinct)).astype(np.int64)
        learned = totals > 0
        exact = target[0] < 2 * shards
        codes = totals[learned].astype(np.uint32) if exact else quantise(totals[learned])
        trie = ContextTrie(distinct[learned], codes, HALF)
        found = trie.query(distinct)[inverse.ravel()]  # what several batches ask is looked up once
        parts = np.split(found, np.cumsum(sizes)[:-1])
        return _rows([(t, b, _squeeze(x)) for t, b, x in zip(target, batch, parts)])

    return run


def score_batch(shards: int, frequent, total: int, distinct: int, cfg: LmSettings) -> Callable:
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not table.num_rows:
            return _SCORES.empty_table()
        tokens = Tokens(table, frequent.value, cfg.all_contexts)
        by_target = dict(zip(answers.column("target").to_pylist(), answers.column("payload").to_pylist()))
        n = len(tokens.words)
        count = tokens.count.astype(np.float64)
        grams, exists = {2: np.zeros(n), 3: np.zeros(n)}, {}
        for level in LEVELS:
            place, target, keys = tokens.keys(level, shards)
            exists[level] = place
            if not len(place):
                continue
            targets, _, pair = distinct_keys(target, keys)
            kind = np.uint32 if level == 1 else np.uint8
            found = np.concatenate([_expand(by_target[int(t)], kind) for t in np.unique(targets)])[pair]
            if level == 1:
                count[place] = found
            else:
                grams[level][place] = dequantise(found)
        base = (count + 0.1) / (total + 0.1 * (distinct + 1))
        p = base.copy()
        two, three = exists[2], exists[3]
        before = count[two - 1]
        p[two] = (np.minimum(grams[2][two], before) + cfg.bigram_prior * base[two]) / (before + cfg.bigram_prior)
        pair = grams[2][three - 1]
        p[three] = (np.minimum(grams[3][three], pair) + cfg.trigram_prior * p[three]) / (pair + cfg.trigram_prior)
        rows = table.num_rows
        add = lambda x: np.bincount(tokens.text, x, rows)
        columns = [
            table.column("doc_id"), pa.array(~table.column("train").to_numpy()),
            pa.array(np.bincount(tokens.text, minlength=rows)), pa.array(add(count > 0).astype(np.int64)),
            pa.array(np.full(rows, total)), pa.array(add(np.log10(base))), pa.array(add(np.log10(p))),
        ]
        return pa.table([c.cast(f.type) for c, f in zip(columns, _SCORES)], names=names)

    return run


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score(docs: DataFrame, cfg: LmSettings | None = None) -> DataFrame:
    """One row per row of ``docs``; learns from the rows whose crc32 of the id, modulo 10, is not 0.

    A null text is empty and has one token, its end. Without training rows all counts are 0 and the score is the
    base score. Ids may repeat or be null.
    """
    cfg = cfg or LmSettings()
    spark = prepare(docs.sparkSession)
    rows = whole_texts(docs).withColumn("train", id_remainder(cfg.held_out_of) != 0)
    size = text_bytes(rows)
    counts = materialize(word_counts(rows), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least = max(2, math.ceil(cfg.context_share * totals["n"]))
    common = counts.filter(F.col("n") >= least).toPandas()  # at most 1 / context_share rows
    names = common["hash"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(names)
    frequent = spark.sparkContext.broadcast((names[order], common["n"].to_numpy().astype(np.int64)[order]))
    shards = max(1, -(-size // SHARD_BYTES))
    batches = max(1, -(-size // BATCH_BYTES))
    by_batch = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))).groupBy("batch")
    answers = by_batch.applyInArrow(ask(shards, frequent, cfg.all_contexts), _DDL).groupBy("target").applyInArrow(answer(shards), _DDL)
    ddl = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
           "score double")
    scorer = score_batch(shards, frequent, totals["n"], totals["v"], cfg)
    return by_batch.cogroup(answers.groupBy("batch")).applyInArrow(scorer, ddl)
