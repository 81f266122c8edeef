"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where five bits of it are zero, so cuts depend on the 16 bytes
before them and find their places again after an insertion. Chunks are compared by 128-bit digest: one that occurs in a
document with a smaller doc_id is a repeat, and repeats that together cover ``least_run`` bytes or more in a row are cut.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from shoptrail.llm.common import flat, prepare, slabs, unpacked, whole_texts, with_rest
from shoptrail.llm.suffix_dedup import decoded
from shoptrail.session import materialize

_GEAR = np.random.default_rng(65537).integers(0, 2**32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class ChunkSettings:
    """Sizes in bytes; ``mask`` has the bits that are zero at a cut (five: about 32 bytes past ``least``)."""

    least: int = 24
    most: int = 512
    mask: int = 0x7C00
    least_run: int = 72


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte, by doubling: enough bytes for the bits that the mask reads."""
    h, span = _GEAR[data], 1
    while span < 16:
        later = h.copy()
        later[span:] += h[:-span] << np.uint32(span) if len(h) > span else h[:0]
        h, span = later, 2 * span
    return h


def cut(data: np.ndarray, offsets: np.ndarray, cfg: ChunkSettings) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks, and their text numbers. The hash of a text's first bytes, which would reach into
    the text before, is never asked for: chunks are longer than its window."""
    places = (np.flatnonzero((gear(data) & np.uint32(cfg.mask)) == 0) + 1).tolist()
    ends, owner = [], []
    for t, (start, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        before, k = len(ends), bisect_left(places, start + cfg.least)
        while start < stop:
            k = bisect_left(places, start + cfg.least, k)
            end = places[k] if k < len(places) else stop
            start = min(end, start + cfg.most, stop)
            ends.append(start)
        owner += [t] * (len(ends) - before)
    return np.array(ends, np.int64), np.array(owner, np.int64)


def chunks(rows: DataFrame, cfg: ChunkSettings) -> DataFrame:
    """doc_id, mark, place, size, digest of every chunk; rows: doc_id, text, mark (a hash of the text)."""
    ddl = "doc_id bigint, mark bigint, place bigint, size int, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slabs(batch):
                part = batch.slice(a, b - a)
                data, offsets = flat(part.column("text"))
                ends, owner = cut(data, offsets, cfg)
                if not len(ends):
                    continue
                starts = np.where(np.diff(owner, prepend=-1) > 0, offsets[owner], np.append(0, ends[:-1]))
                view = memoryview(np.ascontiguousarray(data))
                digests = [hashlib.blake2b(view[x:y], digest_size=16).digest()
                           for x, y in zip(starts.tolist(), ends.tolist())]
                rows_ = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(rows_), part.column("mark").take(rows_),
                    pa.array(starts - offsets[owner]), pa.array((ends - starts).astype(np.int32)),
                    pa.array(digests, pa.binary()),
                ], names=["doc_id", "mark", "place", "size", "digest"])

    return rows.select("doc_id", "text", "mark").mapInArrow(run, ddl)


def dedup(docs: DataFrame, cfg: ChunkSettings | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_chunks_cut, n_removed, n_spans, kept (binary).

    A null text is empty. Rows with one doc_id are no earlier documents to each other; a null doc_id comes after all
    others. Chunks are written once; a digest's least id comes from a partial aggregation, so a chunk that a
    third of all documents share is counted in every task first, and the join back may be split by adaptive execution.
    """
    return _marked(whole_texts(docs), ["doc_id"], cfg or ChunkSettings())


def _marked(rows: DataFrame, kept: list[str], cfg: ChunkSettings) -> DataFrame:
    prepare(rows.sparkSession)
    rows = rows.withColumn("mark", F.xxhash64("text"))
    found = materialize(chunks(rows, cfg), "chunks")
    order = F.coalesce("doc_id", F.lit(2**63 - 1))
    first = found.groupBy("digest").agg(F.min(order).alias("first"), F.max(order).alias("last")).filter("first < last")
    again = found.join(first, "digest").filter(F.col("first") < order)
    # at most one entry per chunk of a document
    listed = again.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("place", "size")).alias("repeats"))
    match = [F.col("r.doc_id").eqNullSafe(F.col("l.doc_id")), F.col("r.mark") == F.col("l.mark")]
    joined = rows.alias("r").join(listed.alias("l"), match, "left").select("r.*", "l.repeats").drop("mark")
    counts = ("n_bytes", "n_chunks_cut", "n_removed", "n_spans")
    schema = StructType([*[rows.schema[c] for c in kept], *[StructField(c, LongType()) for c in counts],
                         StructField("kept", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, repeats in zip(batch.column("text").to_pylist(), batch.column("repeats").to_pylist()):
                data, runs = text.encode(), []
                for x in sorted((r["place"], r["place"] + r["size"]) for r in repeats or []):
                    if runs and runs[-1][1] == x[0]:
                        runs[-1] = (runs[-1][0], x[1], runs[-1][2] + 1)
                    else:
                        runs.append((*x, 1))
                runs = [r for r in runs if r[1] - r[0] >= cfg.least_run]
                left, at = [], 0
                for a, b, _ in runs:
                    left.append(data[at:a])
                    at = b
                left.append(data[at:])
                out.append((len(data), sum(r[2] for r in runs), sum(b - a for a, b, _ in runs), len(runs), b"".join(left)))
            made = [pa.array([r[k] for r in out], arrow.field(n).type) for k, n in enumerate((*counts, "kept"))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], schema=arrow)

    return joined.mapInArrow(run, schema)


def digests(docs: DataFrame, cfg: ChunkSettings | None = None) -> DataFrame:
    out = dedup(docs, cfg)
    return out.select("doc_id", "n_bytes", "n_chunks_cut", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, cfg: ChunkSettings | None = None) -> DataFrame:
    """``docs`` with its columns, texts without the repeats; parts of cut characters go too, n_chars is counted anew."""
    marked = _marked(with_rest(docs), ["rest"], cfg or ChunkSettings())
    return unpacked(marked.withColumn("kept", decoded("kept")), docs, F.col("kept"))
