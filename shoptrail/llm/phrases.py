"""Phrase collocation mining by direct-address tiles over frequency-ranked word ids.

Words are ranked by frequency. Every place of a text where two frequent words follow each other becomes a record of up
to four ids, dealt by a hash of its pair to a tile. A tile counts pairs of ids: where both ids are small, with
``numpy.bincount`` over a dense square, elsewhere as sorted (pair, count) lists. Frequent pairs are ranked again and take
the place of a word at the next length, so pairs of (phrase, next word) are counted by the same routine. What follows -
contained phrases, scores, ranking - runs on the frequent phrases alone, as joins of integer keys.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import Hasher, flat, lower_ascii, mix, prepare, release, slabs, text_bytes
from shoptrail.session import materialize

NONE = np.uint64(2**64 - 1)
COUNTED = np.uint64(2**64 - 2)  # third id of a record that only adds to its pair's count
_TAIL = np.uint64(1 << 63)
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


@dataclass(frozen=True)
class PhraseSettings:
    longest: int = 4
    least: int = 30
    keep: int = 2000
    covered_percent: int = 80
    # Text per tile, and the record count from which a word counts as hot: a pair of two hot words may alone
    # outgrow a tile, so its records are dealt by three or four words and its count is taken before the shuffle.
    tile_bytes: int = 16 << 20
    hot: int = 1 << 20
    # Words with an id of their own, broadcast as two arrays of at most this many entries; any further frequent words
    # travel as their 63-bit hashes.
    most_ids: int = 1 << 20
    # Records a map task sorts at a time, and the edge of the dense square.
    buffer: int = 1_500_000
    dense: int = 1024


def _lang_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") >> 1


def tokens(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Per slab: bytes, starts and ends of words, their 63-bit keys, whether the next word is in the same piece, lang keys."""
    table = pa.Table.from_batches([batch])
    langs = batch.column("lang").dictionary_encode()
    lang_keys = np.array([_lang_key(x) for x in langs.dictionary.to_pylist()], np.uint64)
    of_text = lang_keys[langs.indices.to_numpy()] if len(lang_keys) else np.empty(0, np.uint64)
    for first, last in slabs(table):
        data, offsets = flat(table.column("text").slice(first, last - first))
        if not len(data):
            continue
        data = lower_ascii(data)
        gap = _GAP[data]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before, after = np.append(True, gap[:-1]), np.append(gap[1:], True)
        before[inner], after[inner - 1] = True, True
        starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
        if not len(starts):
            continue
        text = np.searchsorted(offsets, starts, side="right") - 1
        breaks = np.append(0, np.cumsum(_BREAK[data]))
        joined = np.zeros(len(starts), bool)
        joined[:-1] = (text[1:] == text[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]])
        lang = of_text[first:last][text]
        keys = mix(Hasher(data).spans(starts, ends) ^ mix(lang)) & ~_TAIL
        yield data, starts, ends, keys, joined, lang


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(ends - starts))
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[places]))).cast(pa.string())


def _texts(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_counts(docs: DataFrame, cfg: PhraseSettings) -> DataFrame:
    """(lang_key, key, word, n) of words that occur often enough, and one row per lang with an empty word: all its words."""

    def combined(parts: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(parts).group_by(["lang_key", "key", "word"], use_threads=False).aggregate([("n", "sum")])
        return whole.rename_columns({"n_sum": "n"}).select(["lang_key", "key", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in batches:
            for data, starts, ends, keys, _, lang in tokens(batch):
                unique, at, n = np.unique(keys, return_index=True, return_counts=True)
                parts.append(pa.table({
                    "lang_key": lang[at].astype(np.int64), "key": unique.astype(np.int64),
                    "word": _strings(data, starts[at], ends[at]), "n": n}))
                langs, n = np.unique(lang, return_counts=True)
                parts.append(pa.table({
                    "lang_key": langs.astype(np.int64), "key": np.full(len(langs), -1), "word": [""] * len(langs), "n": n}))
            if sum(p.num_rows for p in parts) > 600_000:
                parts = [combined(parts)]
                if parts[0].num_rows > 400_000:
                    yield from parts.pop().to_batches(max_chunksize=50_000)
        if parts:
            yield from combined(parts).to_batches(max_chunksize=50_000)
        del parts
        release()

    counted = _texts(docs).mapInArrow(run, "lang_key bigint, key bigint, word string, n bigint")
    whole = counted.groupBy("lang_key", "key", "word").agg(F.sum("n").alias("n"))
    return whole.filter((F.col("n") >= cfg.least) | (F.col("key") == -1))


@dataclass
class WordIds:
    """The most frequent words: sorted keys with their ranks, and by rank the key and the number of hot ranks."""

    keys: np.ndarray
    ranks: np.ndarray
    by_rank: np.ndarray
    hot: int
    more: bool  # whether further frequent words exist, that have no rank

    @staticmethod
    def of(words: DataFrame, cfg: PhraseSettings) -> WordIds:
        """As many whole classes of alike counts (an eighth of a power of two wide) as have at most ``most_ids`` words."""
        real = words.filter("key >= 0").withColumn("class", F.floor(F.log2("n") * 8))
        sizes = sorted(((r["class"], r["count"]) for r in real.groupBy("class").count().collect()), reverse=True)
        held, least = 0, None
        for name, size in sizes:
            if held + size > cfg.most_ids:
                break
            held, least = held + size, name
        found = real.filter(F.col("class") >= (2**40 if least is None else least)).select("key", "n").toArrow()
        keys, n = (found.column(c).to_numpy() for c in ("key", "n"))
        order = np.lexsort((keys, -n))
        by_rank = keys[order].astype(np.uint64)
        place = np.argsort(by_rank)
        return WordIds(by_rank[place], place.astype(np.uint64), by_rank, int((n >= cfg.hot).sum()),
                       held < sum(s for _, s in sizes))

    def of_keys(self, keys: np.ndarray) -> np.ndarray:
        """Ranks; a frequent word without one keeps its key with the top bit set, any other is NONE."""
        out = keys | _TAIL if self.more else np.full(len(keys), NONE)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            out[known] = self.ranks[at[known]]
        return out

    def to_keys(self, ids: np.ndarray) -> np.ndarray:
        """Keys of ids as signed integers, -1 for NONE."""
        out = (ids & ~_TAIL).astype(np.int64)
        ranked = ids < len(self.by_rank)
        out[ranked] = self.by_rank[ids[ranked].astype(np.int64)].astype(np.int64)
        out[ids == NONE] = -1
        return out


def count_pairs(left: np.ndarray, right: np.ndarray, weights: np.ndarray, edge: int) -> tuple[np.ndarray, ...]:
    """Distinct pairs of ids below 2**32 as (left, right, sum of weights), and the pair number of every record.

    Ids are ranks, so the square of small ids holds most of the records: it is counted by direct address. The others are
    sorted.
    """
    inverse = np.empty(len(left), np.int64)
    small = (left < edge) & (right < edge)
    cell = left[small].astype(np.int64) * edge + right[small].astype(np.int64)
    sums = np.bincount(cell, weights[small], edge * edge)
    filled = np.flatnonzero(sums)
    number = np.empty(edge * edge, np.int32)
    number[filled] = np.arange(len(filled))
    inverse[small] = number[cell]
    rest = ~small
    coo, place = np.unique(left[rest] << np.uint64(32) | right[rest], return_inverse=True)
    inverse[rest] = place + len(filled)
    total = np.bincount(inverse[rest] - len(filled), weights[rest], len(coo)) if len(coo) else np.empty(0)
    return (
        np.concatenate([(filled // edge).astype(np.uint64), coo >> np.uint64(32)]),
        np.concatenate([(filled % edge).astype(np.uint64), coo & np.uint64(2**32 - 1)]),
        np.concatenate([sums[filled], total]).astype(np.int64), inverse)


# --- records on their way to tiles ------------------------------------------------------------------


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit ids as byte planes; four bytes are enough where all are ranks."""
    block = np.stack(columns)
    small = block.size == 0 or bool(((block < 2**31) | (block >= COUNTED)).all())
    block = block.astype(np.uint32 if small else np.uint64)
    planes = np.ascontiguousarray(block.view(np.uint8).reshape(len(columns), -1, block.itemsize).transpose(0, 2, 1))
    return struct.pack("<BBI", len(columns), block.itemsize, block.shape[1]) + zstandard.compress(planes.tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    columns, width, n = struct.unpack("<BBI", blob[:6])
    planes = np.frombuffer(zstandard.decompress(blob[6:], max_output_size=columns * width * n), np.uint8)
    block = np.ascontiguousarray(planes.reshape(columns, width, n).transpose(0, 2, 1)).view(np.uint32 if width == 4 else np.uint64)
    block = block.reshape(columns, n).astype(np.uint64)
    if width == 4:
        block[block >= 2**32 - 2] |= np.uint64(0xFFFFFFFF00000000)
    return block


def _tiled(ids: np.ndarray, weights: np.ndarray, langs: np.ndarray, tiles: int, hot: int) -> Iterator[tuple[int, bytes]]:
    """Equal records merged, and the rest packed by tile. ids: four rows."""
    one, two, three, four = ids
    pair = mix(one * np.uint64(0x9E3779B97F4A7C15) + mix(two))
    triple = mix(pair ^ mix(three))
    whole = mix(triple ^ mix(four + np.uint64(1)))
    both = (one < hot) & (two < hot) & (three != COUNTED)
    dealt = np.where(both, np.where(three < hot, whole, triple), pair)
    tile = (dealt >> np.uint64(24)) % np.uint64(tiles)
    key = tile << np.uint64(40) | (pair & np.uint64(0xFFFFFF)) << np.uint64(16) | whole & np.uint64(0xFFFF)
    del pair, triple, whole, both, dealt
    order = np.argsort(key)
    del key
    tile = tile[order]
    cuts = np.append(np.flatnonzero(np.append(True, tile[1:] != tile[:-1])), len(tile))
    for a, b in zip(cuts[:-1], cuts[1:]):  # a buffer of records is large: only those of a tile are held twice
        at = order[a:b]
        rows = np.stack([column[at] for column in (one, two, three, four, langs)])
        first = np.flatnonzero(np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0)))
        sums = np.add.reduceat(weights[at], first).astype(np.uint64)
        part = rows[:, first]
        # the lang is a function of the first word: told once per value
        names, which = np.unique(part[4], return_inverse=True)
        yield int(tile[a]), struct.pack("<I", len(names)) + names.tobytes() + _pack([*part[:4], which.astype(np.uint64), sums])


def records(docs: DataFrame, shared, tiles: int, cfg: PhraseSettings) -> DataFrame:
    """(tile, blob): every place where two frequent words meet, with the next two words of its piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WordIds = shared.value
        held: list[np.ndarray] = []
        pairs: list[tuple] = []

        def flush(rows: np.ndarray, weights: np.ndarray, langs: np.ndarray) -> Iterator[pa.RecordBatch]:
            out = [] if not len(langs) else list(_tiled(rows, weights, langs, tiles, known.hot))
            del rows, weights, langs
            release()
            for k in range(0, len(out), 200):
                yield pa.RecordBatch.from_pydict({
                    "tile": pa.array([t for t, _ in out[k : k + 200]], pa.int32()),
                    "blob": pa.array([b for _, b in out[k : k + 200]], pa.binary())})

        def merged() -> tuple:
            left, right, sums, langs = (np.concatenate(x) for x in zip(*pairs))
            a, b, total, inverse = count_pairs(left, right, sums, cfg.dense)
            lang = np.empty(len(a), np.uint64)
            lang[inverse] = langs
            return a, b, total, lang

        def taken(parts: list[np.ndarray]) -> tuple:
            rows = np.concatenate(parts, axis=1)
            parts.clear()
            return rows[:4], np.ones(rows.shape[1], np.int64), rows[4]

        for batch in batches:
            for _, _, _, keys, joined, lang in tokens(batch):
                ids = known.of_keys(keys)
                if len(ids) < 2:
                    continue
                padded = np.append(ids, [NONE, NONE, NONE])
                together = np.append(joined, [False] * 3)
                good = together[:-1] & (padded[:-1] != NONE) & (padded[1:] != NONE)
                good = np.append(good, False)
                n = len(ids)
                at = np.flatnonzero(good[:n])
                three = np.where(good[at + 1], padded[at + 2], NONE)
                four = np.where(good[at + 1] & good[np.minimum(at + 2, n + 2)], padded[np.minimum(at + 3, n + 2)], NONE)
                rows = np.stack([padded[at], padded[at + 1], three, four, lang[at]])
                hot = (rows[0] < known.hot) & (rows[1] < known.hot)
                if hot.any():
                    a, b, sums, inverse = count_pairs(rows[0][hot], rows[1][hot], np.ones(hot.sum()), cfg.dense)
                    langs = np.empty(len(a), np.uint64)
                    langs[inverse] = rows[4][hot]
                    pairs.append((a, b, sums, langs))
                    if sum(len(p[0]) for p in pairs) > cfg.buffer:
                        pairs = [merged()]
                held.append(rows)
                if sum(r.shape[1] for r in held) >= cfg.buffer:
                    yield from flush(*taken(held))
        if held:
            yield from flush(*taken(held))
        if pairs:
            a, b, sums, langs = merged()
            pairs = []
            yield from flush(np.stack([a, b, np.full(len(a), COUNTED), np.full(len(a), NONE)]), sums, langs)

    return _texts(docs).mapInArrow(run, "tile int, blob binary")


def _tile_rows(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ids, langs = [], []
    for blob in blobs:
        n = struct.unpack("<I", blob[:4])[0]
        names = np.frombuffer(blob[4 : 4 + 8 * n], np.uint64)
        block = _unpack(blob[4 + 8 * n :])
        ids.append(block[[0, 1, 2, 3, 5]])
        langs.append(names[block[4].astype(np.int64)])
    return np.concatenate(ids, axis=1), np.concatenate(langs)


def count_tile(blobs: list[bytes], known: WordIds, cfg: PhraseSettings) -> tuple[np.ndarray, ...]:
    """Phrases of a tile: lang keys, rows of four ids, counts.

    All counts are whole, and under ``least`` left out, but those of three hot words, which other tiles may share.
    """
    rows, langs = _tile_rows(blobs)
    names, local = rows[:4], rows[:4]
    if known.more:  # ids without a rank: numbers within the tile, after the ranks
        values, local = np.unique(names, return_inverse=True)
        local = local.reshape(names.shape).astype(np.uint64)
    weights = rows[4].astype(np.float64)
    hot = (names < known.hot) & (names != NONE)
    symbol = local[0]
    at = np.arange(rows.shape[1])  # the records that still stand for a frequent beginning
    out = []
    for length in range(2, cfg.longest + 1):
        third = names[2][at]
        stands = np.ones(len(at), bool) if length == 2 else (names[length - 1][at] != NONE) & (third != COUNTED)
        at, symbol = at[stands], symbol[stands]
        if not len(at):
            break
        left, right, _, inverse = count_pairs(symbol, local[length - 1][at], weights[at], cfg.dense)
        first = np.empty(len(left), np.int64)
        first[inverse] = at
        all_hot = hot[:length, first].all(axis=0)
        if length == 2:  # pairs of hot words: counted before the shuffle
            counts = ~all_hot[inverse] | (names[2][at] == COUNTED)
            total = np.bincount(inverse[counts], weights[at][counts], len(left))
        else:
            total = np.bincount(inverse, weights[at], len(left))
        partial = all_hot & (length == 3)
        tells = (total >= cfg.least) | (partial & (total > 0))
        ids = np.full((4, int(tells.sum())), NONE)
        ids[:length] = names[:length, first[tells]]
        out.append((langs[first[tells]], ids, total[tells].astype(np.int64)))
        onward = (total >= cfg.least) | (all_hot & (length < 4))
        # frequent beginnings by falling count: their ranks are the left ids of the next length
        rank = np.empty(len(left), np.uint64)
        rank[np.argsort(-np.where(onward, total, -1), kind="stable")] = np.arange(len(left), dtype=np.uint64)
        stays = onward[inverse]
        at, symbol = at[stays], rank[inverse[stays]]
    if not out:
        return np.empty(0, np.uint64), np.empty((4, 0), np.uint64), np.empty(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out], axis=1), np.concatenate([o[2] for o in out])


PLACES = ["w1", "w2", "w3", "w4"]


def frequent_phrases(docs: DataFrame, words: DataFrame, cfg: PhraseSettings) -> DataFrame:
    """(lang_key, w1..w4: word keys or -1, f) of all phrases of 2 to ``longest`` words that occur ``least`` times."""
    if not 2 <= cfg.longest <= 4:
        raise ValueError("phrases have 2 to 4 words")
    known = WordIds.of(words, cfg)
    shared = docs.sparkSession.sparkContext.broadcast(known)  # at most most_ids entries of 24 bytes
    tiles = min(1 << 24, max(1, -(-text_bytes(docs) // cfg.tile_bytes)))

    def run(table: pa.Table) -> pa.Table:
        ids = shared.value
        langs, rows, counts = count_tile(table.column("blob").to_pylist(), ids, cfg)
        columns = {p: ids.to_keys(row) for p, row in zip(PLACES, rows)}
        release()
        return pa.table({"lang_key": langs.astype(np.int64), **columns, "f": counts})

    schema = "lang_key bigint, w1 bigint, w2 bigint, w3 bigint, w4 bigint, f bigint"
    counted = records(docs, shared, tiles, cfg).groupBy("tile").applyInArrow(run, schema)
    return counted.groupBy("lang_key", *PLACES).agg(F.sum("f").alias("f")).filter(F.col("f") >= cfg.least)


# --- from phrases to the report ---------------------------------------------------------------------


def _key(places: list[Column]) -> Column:
    return F.xxhash64(*places, *[F.lit(-1).cast("bigint")] * (4 - len(places)))


def _parts(names: list[str]) -> dict[int, list[Column]]:
    return {k: [F.col(c) for c in names[:k]] for k in range(1, 5)}


def uncovered(phrases: DataFrame, cfg: PhraseSettings) -> DataFrame:
    """Phrases without those that lie inside a longer one with at least ``covered_percent`` of their count."""
    inside = []
    for k in (3, 4):
        runs = [(i, j) for j in range(2, k) for i in range(k - j + 1)]
        keys = F.array(*[_key([F.col(c) for c in PLACES[i : i + j]]) for i, j in runs])
        inside.append(phrases.filter(F.col("k") == k).select(F.explode(keys).alias("key"), "f"))
    cover = reduce(DataFrame.union, inside).groupBy("key").agg(F.max("f").alias("longer"))
    wide = "decimal(30,0)"
    covers = F.col("longer").cast(wide) * 100 >= F.col("f").cast(wide) * cfg.covered_percent
    return phrases.join(cover, "key", "left").filter(~F.coalesce(covers, F.lit(False))).drop("longer")


def scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds cut, l, r and score of the lowest-scoring cut; counts: (key, f) of all words and phrases."""
    cuts = []
    for k in (2, 3, 4):
        both = [F.struct(F.lit(j).alias("cut"), _key([F.col(c) for c in PLACES[:j]]).alias("head"),
                         _key([F.col(c) for c in PLACES[j:k]]).alias("rest")) for j in range(1, k)]
        cuts.append(phrases.filter(F.col("k") == k).select("key", F.col("f").alias("a"), F.explode(F.array(*both)).alias("c")))
    asked = reduce(DataFrame.union, cuts).select("key", "a", "c.*")
    heads = counts.select(F.col("key").alias("head"), F.col("f").alias("l"))
    rests = counts.select(F.col("key").alias("rest"), F.col("f").alias("r"))
    told = asked.join(heads, "head").join(rests, "rest")
    score = F.expr("cast(cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r) as bigint)")
    lowest = told.withColumn("score", score).groupBy("key").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return phrases.join(lowest.select("key", "best.score", "best.l", "best.r"), "key")


def _first(rows: DataFrame, by: list[str], order: list[Column], keep: int, ties: bool) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    place = F.rank().over(window) if ties else F.row_number().over(window)
    return rows.withColumn("rank", place).filter(F.col("rank") <= keep)


def mine(docs: DataFrame, cfg: PhraseSettings | None = None) -> DataFrame:
    """The report: lang, rank, phrase, a, l, r, n, score, the first ``keep`` phrases of every lang.

    Null texts are empty, a null lang is ``und``; only lang and text are read, repeated rows count again, ids and other columns are
    ignored; an empty table gives no rows. Words are told apart by 63-bit hashes.
    """
    cfg = cfg or PhraseSettings()
    words = materialize(word_counts(docs, cfg), "phrase-words")
    length = sum((F.col(p) >= 0).cast("int") for p in PLACES)
    places = [F.col(p) for p in PLACES]
    phrases = materialize(
        frequent_phrases(docs, words, cfg).withColumn("k", length).withColumn("key", _key(places)), "phrases")
    single = words.filter("key >= 0").select(_key([F.col("key")]).alias("key"), F.col("n").alias("f"))
    counts = phrases.select("key", "f").union(single)
    rows = scored(uncovered(phrases, cfg), counts).withColumn("salt", F.pmod("key", F.lit(16)))
    best = [F.desc("score"), F.desc("f")]
    # the first of every sixteenth, then of the lang, ties included; only these are spelt
    near = _first(_first(rows, ["lang_key", "salt"], best, cfg.keep, True), ["lang_key"], best, cfg.keep, True)
    near = materialize(near.drop("rank"), "near-report")
    spelt = near.select("key", F.posexplode(F.array(*places)).alias("place", "word_key")).filter("word_key >= 0")
    named = words.filter("key >= 0").select(F.col("key").alias("word_key"), "word")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ")
    spelt = spelt.join(named, "word_key").groupBy("key").agg(phrase.alias("phrase"))
    langs = _texts(docs).select("lang").distinct()
    totals = words.filter("key = -1").select("lang_key", "n")
    named_langs = langs.mapInArrow(_with_lang_key, "lang string, lang_key bigint").join(totals, "lang_key")
    order = [*best, F.asc("phrase")]
    rows = near.join(spelt, "key").join(named_langs, "lang_key")
    rows = _first(rows, ["lang", "salt"], order, cfg.keep, False).drop("rank")
    rows = _first(rows, ["lang"], order, cfg.keep, False)
    return rows.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def _with_lang_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_lang_key(x) for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], names=["lang", "lang_key"])
