"""Substring removal by sorted suffixes: bytes covered by a string of 50 that also starts in an earlier document.

Every 50-byte suffix head is listed under an anchor, the place of its 32-byte string with the least hash; equal heads
have equal anchors. Neighbouring heads under one anchor travel as one context of at most 68 bytes, which
is what makes shipping suffixes affordable.

1. Anchors that occur once in the corpus are sorted out: batches of documents send 32 bits (besides the
   shard number) of their anchors' hashes to shards, which answer with one bit each. False hits cost time only.
2. Contexts of the other anchors are range partitioned by their leading bytes, with splitters from a sample. A bucket
   sorts its suffix heads by multikey quicksort, eight bytes a level, splitting only what is still tied. Cuts
   are compared on the anchor's first eight bytes and equal keys never part, so no equal suffixes lie on
   two sides of a boundary.
3. The answers, a bit per head, go back to the batches, which mark the covered bytes.

Within a batch equal contexts are sent once with their least doc_id, so a passage that a third of all documents
share costs one row per batch. All steps read the same exchange of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shoptrail.llm.common import SLAB_BYTES, Hasher, flat, prepare, release, slabs, text_bytes, unpacked, whole_texts, with_rest

WIDTH, GRAM = 50, 32
BATCH_BYTES, SHARD_BYTES, BUCKET_BYTES, SAMPLE_BYTES = 8 << 20, 24 << 20, 8 << 20, 4 << 20
LAST_ID = np.iinfo(np.int64).max  # a null doc_id comes after all others


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last head of every context, its anchor's place and the anchor's hash, in text order."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    least = np.empty(n, np.int64)
    for at in range(0, n, SLAB_BYTES):
        part = data[at : at + SLAB_BYTES + WIDTH - 1]
        low = np.uint64((1 << 24) - 1)
        k = (Hasher(part).windows(GRAM) & ~low) | np.arange(len(part) - GRAM + 1, dtype=np.uint64)
        span, want = 1, WIDTH - GRAM + 1
        while 2 * span <= want:
            k, span = np.minimum(k[:-span], k[span:]), 2 * span
        if want > span:
            k = np.minimum(k[: len(k) - (want - span)], k[want - span :])
        least[at : at + len(k)] = at + (k & low).astype(np.int64)
    for end in offsets[1:-1]:  # heads that would cross into the next document
        least[max(0, end - WIDTH + 1) : end] = -1
    turn = np.flatnonzero(np.diff(least, prepend=-2))
    first, last = turn, np.append(turn[1:], n) - 1
    place = least[first]
    real = place >= 0
    first, last, place = first[real], last[real], place[real]
    hashes = np.empty(len(place), np.uint64)
    for at in range(0, len(data), SLAB_BYTES):
        mine = slice(*np.searchsorted(place, (at, at + SLAB_BYTES)))
        if mine.start < mine.stop:
            hashes[mine] = Hasher(data[at : at + SLAB_BYTES + GRAM]).spans(place[mine] - at, place[mine] - at + GRAM)
    return first, last, place, hashes


class Batch:
    """Documents of one batch in a fixed order, and their contexts; ``wanted`` are contexts that are known already."""

    def __init__(self, table: pa.Table, wanted: bytes | None = None):
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.table = table.take(pa.array(order, pa.int64()))
        self.data, self.offsets = flat(self.table.column("text"))
        self.ids = np.array([LAST_ID if ids[i] is None else ids[i] for i in order], np.int64)
        if wanted is None:
            self._find()
        else:
            self.first, self.last, self.place = _unpacked_contexts(wanted)
        doc = np.searchsorted(self.offsets, self.first, side="right") - 1
        self.doc = self.ids[doc] if len(doc) else np.empty(0, np.int64)

    def _find(self) -> None:
        found = []
        for a, b in slabs(self.table):
            lo, hi = self.offsets[a], self.offsets[b]
            first, last, place, hashes = anchors(self.data[lo:hi], self.offsets[a : b + 1] - lo)
            found.append((first + lo, last + lo, place + lo, hashes))
        self.first, self.last, self.place, self.hashes = (np.concatenate(x) for x in zip(*found))

    def keys(self, shards: int) -> np.ndarray:
        """Shard and 32 bits of every anchor's hash."""
        shard = (self.hashes >> np.uint64(32)) % np.uint64(shards)
        return (shard << np.uint64(32)) | (self.hashes & np.uint64(0xFFFFFFFF))

    def leads(self) -> np.ndarray:
        """The first eight bytes at every anchor (anchors have 32) as a number that sorts like them."""
        out = np.zeros(len(self.place), np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | self.data[self.place + k]
        return out


def _packed_contexts(batch: Batch, wanted: np.ndarray) -> bytes:
    """First head, number of heads and anchor of the wanted contexts, a few bytes each."""
    first, last, place = (x[wanted] for x in (batch.first, batch.last, batch.place))
    steps = np.diff(first, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    planes = [np.ascontiguousarray(steps), (last - first).astype(np.uint8), (place - first).astype(np.uint8)]
    return len(first).to_bytes(8, "little") + zstandard.compress(b"".join(x.tobytes() for x in planes), 1)


def _unpacked_contexts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(zstandard.decompress(data[8:], max_output_size=max(6 * n, 1)), np.uint8).reshape(6, n)
    steps = np.ascontiguousarray(planes[:4].T).view("<u4").ravel()
    first = np.cumsum(steps, dtype=np.int64)
    return first, first + planes[4], first + planes[5]


def eight_bytes(data: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the number of each, as numpy's unique but always 1-d."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, inverse.ravel()


def multikey_quicksort(word: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number per suffix head, equal where all 50 bytes are; ``word`` has eight bytes from each place.

    Level by level the heads are sorted by their next eight bytes within what is tied so far; heads that
    differ from all others leave the sort.
    """
    group = np.zeros(len(starts), np.int64)
    active = np.arange(len(starts))
    names = 0
    for shift in (*range(0, WIDTH - 8, 8), WIDTH - 8):
        token = word[starts[active] + shift]
        order = np.lexsort((token, group[active]))
        active, token = active[order], token[order]
        above = group[active]
        new = np.ones(len(active), bool)
        new[1:] = (above[1:] != above[:-1]) | (token[1:] != token[:-1])
        group[active] = names + np.cumsum(new)
        names += int(new.sum())
        single = new & np.append(new[1:], True)
        active = active[~single]
        if not len(active):
            break
    return group


def _contexts(batch: Batch, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The wanted contexts' numbers, the number of each one's distinct text, and the least doc_id per text."""
    mine = np.flatnonzero(wanted)
    code = np.empty(len(mine), np.uint64)
    for at in range(0, len(batch.data), SLAB_BYTES):
        a, b = np.searchsorted(batch.first[mine], (at, at + SLAB_BYTES))
        if a < b:
            part = mine[a:b]
            code[a:b] = Hasher(batch.data[at : at + SLAB_BYTES + 2 * WIDTH]).spans(
                batch.first[part] - at, batch.last[part] + WIDTH - at)
    distinct, inverse = grouped(code)
    least = np.full(len(distinct), LAST_ID, np.int64)
    np.minimum.at(least, inverse, batch.doc[mine])
    return mine, inverse, least


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


_REQUEST = pa.schema([("target", pa.int64()), ("batch", pa.int64()), ("payload", pa.binary())])
_REQUEST_DDL = "target bigint, batch bigint, payload binary"


def ask_shards(shards: int) -> Callable:
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        batch = Batch(table)
        keys, inverse = grouped(batch.keys(shards))
        low, high = np.full(len(keys), LAST_ID), np.full(len(keys), -1 - LAST_ID)
        np.minimum.at(low, inverse, batch.doc)
        np.maximum.at(high, inverse, batch.doc)
        shard = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        rows = []
        for s in np.unique(shard):
            part = slice(cuts[s], cuts[s + 1])
            data = keys[part].astype(np.uint32).tobytes() + np.packbits(high[part] > low[part]).tobytes()
            rows.append((int(s), key[0].as_py(), len(keys[part]).to_bytes(8, "little") + data))
        return _rows(_REQUEST, rows)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = ask(key, table)
        release()
        return out

    return run


def answer_shards(table: pa.Table) -> pa.Table:
    """A bit per asked anchor: whether another document has it."""
    target, asked = table.column("target").to_pylist(), table.column("payload").to_pylist()
    sizes = [int.from_bytes(p[:8], "little") for p in asked]
    keys = np.concatenate([np.frombuffer(p, np.uint32, n, 8) for p, n in zip(asked, sizes)])
    own = np.concatenate([
        np.unpackbits(np.frombuffer(p, np.uint8, offset=8 + 4 * n), count=n) for p, n in zip(asked, sizes)])
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    equal = keys[order[1:]] == keys[order[:-1]]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    bits = np.split(same | (own > 0), np.cumsum(sizes)[:-1])
    rows = [(t, b, np.packbits(x).tobytes()) for t, b, x in zip(target, table.column("batch").to_pylist(), bits)]
    return _rows(_REQUEST, rows)


def _suspects(batch: Batch, answers: pa.Table, shards: int) -> np.ndarray:
    """Per context whether its anchor occurs in another document too."""
    keys, inverse = grouped(batch.keys(shards))
    shard = (keys >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    hit = np.zeros(len(keys), bool)
    for s, bits in zip(answers.column("target").to_pylist(), answers.column("payload").to_pylist()):
        n = cuts[s + 1] - cuts[s]
        hit[cuts[s] : cuts[s + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n) > 0
    return hit[inverse]


def ask_buckets(shards: int, splitters: np.ndarray) -> Callable:
    """Contexts by bucket; where they lie goes along under the negative batch number and comes back unchanged."""

    def ask(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _rows(_REQUEST, [])
        batch, number = Batch(docs), key[0].as_py()
        wanted = _suspects(batch, answers, shards)
        mine, inverse, least = _contexts(batch, wanted)
        rows = [(-1 - number, number, _packed_contexts(batch, wanted))]
        one = np.zeros(len(least), np.int64)
        one[inverse] = mine  # any context of the text
        bucket = np.searchsorted(splitters, batch.leads()[one], side="right")
        for s in np.unique(bucket):
            part = np.flatnonzero(bucket == s)
            starts, sizes = batch.first[one[part]], batch.last[one[part]] + WIDTH - batch.first[one[part]]
            at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            data = [np.array([len(part)], np.int64), least[part], sizes.astype(np.uint8), batch.data[at]]
            rows.append((int(s), number, b"".join(x.tobytes() for x in data)))
        return _rows(_REQUEST, rows)

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = ask(key, docs, answers)
        release()
        return out

    return run


def answer_buckets(table: pa.Table) -> pa.Table:
    """For every context a bit per head: whether the head also starts in a document before the context's least."""
    target, batches = table.column("target").to_pylist(), table.column("batch").to_pylist()
    asked = table.column("payload").to_pylist()
    if target[0] < 0:
        return table.select(_REQUEST.names)
    counts, least, sizes, data = [], [], [], []
    for p in asked:
        n = int.from_bytes(p[:8], "little")
        counts.append(n)
        least.append(np.frombuffer(p, np.int64, n, 8))
        sizes.append(np.frombuffer(p, np.uint8, n, 8 + 8 * n))
        data.append(np.frombuffer(p, np.uint8, offset=8 + 9 * n))
    least, sizes, data = np.concatenate(least), np.concatenate(sizes).astype(np.int64), np.concatenate(data)
    heads = sizes - WIDTH + 1
    owner = np.repeat(np.arange(len(sizes)), heads)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(heads) - heads, heads)
    starts = (np.cumsum(sizes) - sizes)[owner] + inside
    group = multikey_quicksort(eight_bytes(data), starts)
    first = np.full(int(group.max()) + 1, LAST_ID, np.int64)
    np.minimum.at(first, group, least[owner])
    hit = first[group] < least[owner]
    masks = np.zeros(len(sizes), np.uint32)
    np.bitwise_or.at(masks, owner[hit], np.uint32(1) << inside[hit].astype(np.uint32))
    parts = np.split(masks, np.cumsum(counts)[:-1])
    del data, owner, inside, starts, group, hit
    release()
    return _rows(_REQUEST, [(t, b, x.tobytes()) for t, b, x in zip(target, batches, parts)])


def _known(docs: pa.Table, answers: pa.Table) -> Batch:
    """The batch with the contexts that its request told."""
    wanted = [p for t, p in zip(answers.column("target").to_pylist(), answers.column("payload").to_pylist()) if t < 0]
    return Batch(docs, wanted[0])


def _covered(batch: Batch, answers: pa.Table, splitters: np.ndarray) -> np.ndarray:
    """Per byte of the batch whether it goes."""
    flags = np.zeros(len(batch.data) + 1, np.int32)
    told = zip(answers.column("target").to_pylist(), answers.column("payload").to_pylist())
    masks = {t: np.frombuffer(bits, np.uint32) for t, bits in told if t >= 0}
    wanted = np.ones(len(batch.first), bool)
    mine, inverse, least = _contexts(batch, wanted)
    one = np.zeros(len(least), np.int64)
    one[inverse] = mine
    bucket = np.searchsorted(splitters, batch.leads()[one], side="right")
    mask = np.zeros(len(least), np.uint32)
    for s in np.unique(bucket):
        mask[bucket == s] = masks[int(s)]
    bits = mask[inverse].copy()
    bits[batch.doc[mine] > least[inverse]] = np.uint32(0xFFFFFFFF)
    for k in range(WIDTH - GRAM + 1):
        heads = batch.first[mine] + k
        heads = heads[((bits >> np.uint32(k)) & 1 > 0) & (heads <= batch.last[mine])]
        np.add.at(flags, heads, 1)
        np.add.at(flags, heads + WIDTH, -1)
    return np.cumsum(flags[:-1], dtype=np.int32) > 0


def mark(splitters: np.ndarray, keep: list[str], schema: pa.Schema) -> Callable:
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        batch = _known(docs, answers)
        gone = _covered(batch, answers, splitters)
        turn = gone.copy()
        turn[1:] &= ~gone[:-1]
        inner = batch.offsets[(batch.offsets > 0) & (batch.offsets < len(gone))]
        turn[inner] = gone[inner]
        removed, spans, kept = [], [], []
        for a, b in zip(batch.offsets[:-1], batch.offsets[1:]):
            removed.append(int(gone[a:b].sum()))
            spans.append(int(turn[a:b].sum()))
            kept.append(batch.data[a:b][~gone[a:b]].tobytes())
        columns = {c: batch.table.column(c) for c in keep} | {
            "n_bytes": np.diff(batch.offsets), "n_removed": removed, "n_spans": spans, "kept": kept}
        return pa.table([columns[f.name] if f.name in keep else pa.array(columns[f.name], f.type) for f in schema],
                        schema=schema)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = cut(docs, answers)
        release()
        return out

    return run


def sample_splitters(rows: DataFrame, total: int) -> np.ndarray:
    """Bucket bounds from the anchors of a hash sample of about 4 MB of documents; 8 bytes per 8 MB of text.

    The sample only balances the buckets.
    """
    buckets = -(-total // BUCKET_BYTES)
    every = max(1, total // SAMPLE_BYTES)

    def run(batches):
        for part in batches:
            for a, b in slabs(part):
                data, offsets = flat(part.column("text").slice(a, b - a))
                place = anchors(data, offsets)[2]
                leads = eight_bytes(data)[place] if len(place) else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(leads.view(np.int64)[::8])], names=["lead"])

    chosen = rows.filter(F.pmod(F.xxhash64("text", "doc_id", F.lit(11)), F.lit(every)) == 0).select("text")
    found = chosen.mapInArrow(run, "lead bigint").toPandas()["lead"].to_numpy().astype(np.int64).view(np.uint64)
    if buckets < 2 or not len(found):
        return np.empty(0, np.uint64)
    found = np.sort(found)
    return np.unique(found[(np.arange(1, buckets) * len(found)) // buckets])


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    A null text is empty. Rows with one doc_id are no earlier documents to each other; a null doc_id comes after all
    others. Texts under 50 bytes keep everything; an empty table gives an empty result.
    """
    return _marked(whole_texts(docs), ["doc_id"])


def _marked(rows: DataFrame, kept: list[str]) -> DataFrame:
    prepare(rows.sparkSession)
    total = text_bytes(rows)
    shards = max(1, -(-total // SHARD_BYTES))
    splitters = sample_splitters(rows, total)
    batches = max(1, -(-total // BATCH_BYTES))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))
    by_batch = dealt.groupBy("batch")
    asked = by_batch.applyInArrow(ask_shards(shards), _REQUEST_DDL)
    answers = asked.groupBy("target").applyInArrow(answer_shards, _REQUEST_DDL)
    contexts = by_batch.cogroup(answers.groupBy("batch")).applyInArrow(ask_buckets(shards, splitters), _REQUEST_DDL)
    heads = contexts.groupBy("target").applyInArrow(answer_buckets, _REQUEST_DDL)
    fields = [rows.schema[c] for c in kept] + [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    schema = StructType([*fields, StructField("kept", BinaryType())])
    return by_batch.cogroup(heads.groupBy("batch")).applyInArrow(mark(splitters, kept, to_arrow_schema(schema)), schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the sha256 of what is left."""
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns it has, texts without the removed bytes.

    A character of which only some bytes go loses the rest too. n_chars, where there is one, is counted anew.
    """
    marked = _marked(with_rest(docs), ["rest"])
    return unpacked(marked.withColumn("kept", decoded("kept")), docs, F.col("kept"))


@F.pandas_udf(StringType())
def decoded(column: pd.Series) -> pd.Series:
    return column.map(lambda b: bytes(b).decode("utf-8", "ignore"))
