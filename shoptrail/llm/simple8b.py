"""Token ids on disk: Simple-8b words in blocks, in files ordered by document.

A 64-bit word holds a selector in its top four bits and 60 bits of payload: 60 ids of one bit, 30 of two,
... 1 of 60. The encoder takes the largest count whose ids all fit. An id of more than 60 bits is written
as an escape: a word with selector 0, then the id as a raw word. Blocks of 256 ids start at a word of
their own, listed in an offset table, so that packing and unpacking run over all blocks in step.

A file is a row of sections; a section holds whole documents:
``magic, documents, ids, words of the lengths, words of the ids`` as six little-endian 64-bit numbers (the last
is 0), a byte per document that tells a null doc_id, the doc_ids, the block offsets and words of the lengths
(coded like ids), and the block offsets and words of the ids.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import prepare, text_bytes, whole_texts
from shoptrail.session import fresh_path, materialize

# Ids per word and bits per id of selectors 1 to 14.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 256
MAGIC = 0x31423853
SECTION_IDS = 1 << 20
FILE_BYTES = 32 << 20
CACHE_WORDS = 600_000


_SHORT = np.array([k.bit_length() for k in range(1 << 16)], np.uint8)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    if len(values) and values.max() < 1 << 16:
        return _SHORT[values.astype(np.int64)]
    bits = np.zeros(len(values), np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >= np.uint64(1 << step)
        bits[high] += step
        rest[high] >>= np.uint64(step)
    return bits + (rest > 0)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``values`` (uint64), and the number of the first word of each block."""
    blocks = -(-len(values) // BLOCK)
    if blocks == 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    span = BLOCK + 60
    grid = np.zeros((blocks, span), np.uint64)
    bits = np.zeros((blocks, span), np.uint8)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[: len(values)] = values
    grid[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    bits[:, :BLOCK] = bit_lengths(padded).reshape(blocks, BLOCK)
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(values) - BLOCK * (blocks - 1)
    bits, grid = bits.ravel(), grid.ravel()
    place, active, taken = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(active):
        at = active * span + place[active]
        chosen = np.zeros(len(active), np.int64)
        alive, most, seen = np.arange(len(active)), np.zeros(len(active), np.uint8), 0
        for selector in range(14, 0, -1):
            for j in range(seen, COUNTS[selector]):
                most = np.maximum(most, bits[at[alive] + j])
            seen = COUNTS[selector]
            fit = most <= WIDTHS[selector]
            alive, most = alive[fit], most[fit]
            if not len(alive):
                break
            chosen[alive] = selector
        taken.append((active, at, chosen))
        place[active] += np.maximum(COUNTS[chosen], 1)
        active = active[place[active] < sizes[active]]
    block, at, chosen = (np.concatenate(x) for x in zip(*taken))
    order = np.argsort(block, kind="stable")
    block, at, chosen = block[order], at[order], chosen[order]
    lengths = np.where(chosen == 0, 2, 1)
    target = np.cumsum(lengths) - lengths
    words = np.zeros(int(lengths.sum()), np.uint64)
    for selector in range(1, 15):
        mine = np.flatnonzero(chosen == selector)
        if len(mine):
            steps = np.arange(COUNTS[selector])
            parts = grid[at[mine, None] + steps] << (steps * WIDTHS[selector]).astype(np.uint64)
            words[target[mine]] = np.bitwise_or.reduce(parts, axis=1) | np.uint64(selector << 60)
    raw = chosen == 0
    words[target[raw] + 1] = grid[at[raw]]
    return words, target[np.searchsorted(block, np.arange(blocks))].astype(np.uint32)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values behind ``words``; the inverse of ``pack``."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    ends = np.append(offsets[1:], len(words)).astype(np.int64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    use = np.ones(len(words), bool)
    for b in np.unique(np.searchsorted(offsets, np.flatnonzero(selectors == 0), side="right") - 1):
        k = int(offsets[b])  # only a block with escapes is walked word by word
        while k < ends[b]:
            if selectors[k] == 0:
                use[k + 1] = False
                k += 1
            k += 1
    kept = np.flatnonzero(use)
    block = np.searchsorted(offsets, kept, side="right") - 1
    counts = np.maximum(COUNTS[selectors[kept]], 1)
    before = np.cumsum(counts) - counts
    inside = before - before[np.searchsorted(kept, offsets[block])]
    limit = np.minimum(BLOCK, n - BLOCK * block)
    for selector in np.unique(selectors[kept]):
        mine = np.flatnonzero(selectors[kept] == selector)
        if selector == 0:
            out[block[mine] * BLOCK + inside[mine]] = words[kept[mine] + 1]
            continue
        steps = np.arange(COUNTS[selector])
        mask = np.uint64((1 << int(WIDTHS[selector])) - 1)
        values = (words[kept[mine], None] >> (steps * WIDTHS[selector]).astype(np.uint64)) & mask
        place = inside[mine, None] + steps
        real = place < limit[mine, None]
        out[(block[mine, None] * BLOCK + place)[real]] = values[real]
    return out


def write_section(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    length_words, length_at = pack(lengths.astype(np.uint64))
    words, at = pack(ids.astype(np.uint64))
    head = np.array([MAGIC, len(doc_ids), len(ids), len(length_words), len(words), 0], np.uint64)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], np.int64)
    return b"".join(x.tobytes() for x in (head, nulls, keys, length_at, length_words, at, words))


def read_section(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Doc_ids, lengths and ids of a section."""
    place = 0

    def take(kind, n: int) -> np.ndarray:
        nonlocal place
        part = np.frombuffer(data, kind, n, place)
        place += part.nbytes
        return part

    magic, docs, n, length_words, words, _ = (int(x) for x in take(np.uint64, 6))
    if magic != MAGIC:
        raise ValueError("not a section of token ids")
    nulls, keys = take(np.uint8, docs), take(np.int64, docs)
    at = take(np.uint32, -(-docs // BLOCK))
    lengths = unpack(take(np.uint64, length_words), at, docs)
    at = take(np.uint32, -(-n // BLOCK))
    ids = unpack(take(np.uint64, words), at, n)
    return [None if z else int(k) for z, k in zip(nulls, keys)], lengths, ids


# --- encoding -----------------------------------------------------------------------------------

_ENCODERS: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Encodes texts with the tokenizers library, each distinct piece once.

    A byte-level pre-tokenizer always starts a new unit at a space before a character that is no white
    space, so texts are cut there and the pieces' ids joined. Known pieces are kept up to a bound.
    """

    CUT = re.compile(r" (?=\S)")
    UNEVEN = re.compile(r" (?:\s|$)")
    # Letters, signs, and perhaps a line break with letters and signs: always cut apart by the pre-tokenizer.
    SIMPLE = re.compile(r"([^\W\d_]+)([^\w\s]*)(?:(\n)([^\W\d_]+)([^\w\s]*))?")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark, self.mark_id = special[0] if special else (None, None)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}  # pieces without a space before them

    def _head(self, pieces: set[str]) -> dict[str, bytes]:
        if len(self.heads) > CACHE_WORDS:
            self.heads = {}
        self.heads.update(self._learn(list(pieces - self.heads.keys()), ""))
        return self.heads

    def _again(self, missing: set[str]) -> dict[str, bytes]:
        """The ids of pieces that are not known; most are made of known words, signs and words after a break."""
        known, older, out = self.known, self.older, {}
        simple, stems, heads, rest = [], set(), set(), []
        for p in missing:
            if p in older:
                out[p] = older[p]
                continue
            m = self.SIMPLE.fullmatch(p)
            if m is None or not (m[2] or m[3]):
                rest.append(p)
                continue
            parts = [x for x in m.groups()[1:] if x]
            simple.append((p, m[1], parts))
            heads.update(parts)
            if m[1] not in known and m[1] not in out:
                if m[1] in older:
                    out[m[1]] = older[m[1]]
                else:
                    stems.add(m[1])
        out.update(self._learn([*stems.union(rest)], " "))
        table = self._head(heads)
        for p, stem, parts in simple:
            out[p] = (known.get(stem) or out[stem]) + b"".join([table[x] for x in parts])
        return out

    def _learn(self, pieces: list[str], prefix: str) -> dict[str, bytes]:
        """The library never joins text across a special token, so pieces are encoded in rows between marks."""
        plain = [p for p in pieces if self.mark and self.mark not in p]
        out = {}
        for k in range(0, len(plain), 5_000):
            part = plain[k : k + 5_000]
            row = self.mark.join([prefix + p for p in part]) + self.mark
            ids = np.array(self.tokenizer.encode_batch_fast([row], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(ids == self.mark_id)
            data, starts = ids.tobytes(), np.append(0, ends[:-1] + 1)
            out.update(zip(part, [data[a:b] for a, b in zip((starts * 4).tolist(), (ends * 4).tolist())]))
        rest = [p for p in pieces if p not in out]
        found = self.tokenizer.encode_batch_fast([prefix + p for p in rest], add_special_tokens=False)
        out.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(rest, found))
        return out

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        """The ids of every text as little-endian 32-bit numbers, followed by ``end``."""
        cut = [self.CUT.split(t) if self.UNEVEN.search(t) else t.split(" ") for t in texts]
        heads = self._learn(list({c[0] for c in cut}), "")  # the first pieces, without a space
        if len(self.known) > CACHE_WORDS:  # pieces that were not met since are forgotten
            self.known, self.older = {}, self.known
        get = self.known.get
        found = [list(map(get, c)) for c in cut]
        missing = set()
        for c, f in zip(cut, found):
            f[0] = heads[c[0]]
            if None in f:
                missing.update([p for p, x in zip(c, f) if x is None])
        again = self._again(missing)
        self.known.update(again)
        for c, f in zip(cut, found):
            if None in f:
                f[:] = [again[p] if x is None else x for p, x in zip(c, f)]
        return [b"".join(f) + end for f in found]


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the token ids of ``docs`` into files under ``folder``, which all executors share.

    Documents are range partitioned and sorted by doc_id (null first; rows with one id, however many, by a hash); a task writes
    one file of sections. The returned manifest has a row per section; files of lost or repeated attempts
    have names that it does not list. A null text is encoded as the empty text.
    """
    prepare(docs.sparkSession)
    rows = whole_texts(docs)
    parts = max(1, -(-text_bytes(rows) // FILE_BYTES))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(parts, "doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row").drop("hash", "row")
    end = np.array([end_id], np.uint32).tobytes()
    schema = pa.schema([("part", pa.int32()), ("section", pa.int32()), ("file", pa.string()), ("place", pa.int64()),
                        ("size", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        system, base = _filesystem(folder)
        name = f"ids-{part:07d}-{uuid.uuid4().hex}.s8b"
        rows, sink, place = [], None, 0
        doc_ids, pending, held = [], [], 0

        def flush():
            nonlocal place, doc_ids, pending, held, sink
            if not doc_ids:
                return
            if sink is None:
                system.create_dir(base, recursive=True)
                sink = system.open_output_stream(f"{base}/{name}")
            lengths = np.array([len(x) // 4 for x in pending], np.uint64)
            data = write_section(doc_ids, lengths, np.frombuffer(b"".join(pending), np.uint32))
            sink.write(data)
            rows.append((part, len(rows), name, place, len(data), len(doc_ids), int(lengths.sum())))
            place += len(data)
            doc_ids, pending, held = [], [], 0

        for batch in batches:
            for k in range(0, batch.num_rows, 250):
                piece = batch.slice(k, 250)
                coded = tool.encode(piece.column("text").to_pylist(), end)
                for d, x in zip(piece.column("doc_id").to_pylist(), coded):
                    doc_ids.append(d)
                    pending.append(x)
                    held += len(x) // 4
                    if held >= SECTION_IDS:
                        flush()
        flush()
        if sink is not None:
            sink.close()
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    ddl = "part int, section int, file string, place bigint, size bigint, documents bigint, ids bigint"
    return materialize(ordered.mapInArrow(write, ddl), "ids-manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens and the unsigned crc32 of its ids as little-endian 32-bit numbers.

    Only totals are summed in order: those of the files, and within each file those of its sections. There are as many
    reading tasks as files.
    """
    totals = manifest.groupBy("part").agg(F.sum("ids").alias("whole"))
    earlier = F.sum("whole").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("section").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.join(totals.select("part", F.coalesce(earlier, F.lit(0)).alias("files_before")), "part")
    placed = placed.withColumn("before", F.col("files_before") + F.coalesce(inside, F.lit(0))).drop("files_before")
    files = (manifest.agg(F.max("part")).first()[0] or 0) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{base}/{row['file']}") as source:
                    doc_ids, lengths, ids = read_section(source.read_at(row["size"], row["place"]))
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths.astype(np.int64)
                data = memoryview(ids.astype("<u4")).cast("B")
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, pa.int64()), pa.array(starts + row["before"], pa.int64()),
                    pa.array(lengths.astype(np.int64), pa.int64()),
                    pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.repartitionByRange(files, "part", "section")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_to_files(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write all ids to files in the shared folder and read them back, one row per row of ``docs``."""
    folder = fresh_path(docs.sparkSession, "token-ids")
    folder = folder if "://" in folder else folder.replace("file:", "")
    return read_ids(write_ids(docs, folder, tokenizer_path, end_id), folder)
