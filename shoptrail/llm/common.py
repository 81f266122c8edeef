"""What the operators of this subpackage share: whole texts, flat byte arrays, word and window hashes.

Texts arrive in tasks as Arrow string columns, whose UTF-8 bytes lie in one buffer; everything
below works on that buffer with numpy, a slab of bounded size at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLAB_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a batch of very long texts stays small in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/documents.parquet")


def whole_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) under exactly these names, and columns named in ``more``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text, *more)


def with_rest(docs: DataFrame) -> DataFrame:
    """As ``whole_texts``, with all columns of ``docs`` as they are in one struct ``rest``, where no name clashes."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text, rest)


def unpacked(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` again, from ``rest`` and the new text; n_chars, where there is one, is counted anew."""
    out = []
    for name in docs.columns:
        column = F.col("rest").getField(name)
        if name == "text":
            column = text
        elif name == "n_chars":
            column = F.char_length(text).cast(docs.schema[name].dataType)
        out.append(column.alias(name))
    return rows.select(*out)


def id_remainder(by: int) -> Column:
    """crc32 of the doc_id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % by


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts; sizes the number of shards so that each stays small at any input size."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]


# --- flat byte arrays ---------------------------------------------------------------------------


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the bounds of its texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    wide = column.cast(pa.large_string())
    if len(wide) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = wide.buffers()
    offsets = np.frombuffer(bounds, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slabs(batch, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch or table whose texts have about ``limit`` bytes; a longer text stands alone."""
    offsets = flat(batch.column("text"))[1]
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes other than space and \\t \\n \\v \\f \\r."""
    if len(data) == 0:
        none = np.empty(0, np.int64)
        return none, none, none
    space = _SPACE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * SLAB_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Hasher:
    """64-bit hashes of byte spans: differences of one prefix sum, brought to a common position."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` bytes, by its first byte."""
        n = len(self.sums) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def chain(hashes: np.ndarray, order: int) -> np.ndarray:
    """The hash of every run of ``order`` neighbouring word hashes, by its first word."""
    n = len(hashes) - order + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, order):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return total


def release() -> None:
    """Gives freed memory back to the system: Python workers are reused, and the next stage needs it elsewhere."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only one C library has it
        pass


def table_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
