"""Byte-pair encoding in batched numpy merge rounds, and decoding.

Symbols of many words lie in one flat array. In a round the rank of every neighbouring pair is found by
binary search over sorted pair keys, the lowest rank of each word is taken, and its pairs are merged; words
without a known pair leave. All places of a pair are merged in one round where no pair with the new
symbol ranks lower, else only the leftmost, which is the order of a priority queue.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from shoptrail.llm.common import prepare, release, whole_texts

# Pieces that a worker remembers: where only digests leave it, and where rows with texts, ids and tokens do.
CACHE_WORDS, ROW_CACHE_WORDS = 200_000, 50_000
_NONE = np.int64(1 << 62)
_MODELS: dict[str, WordBpe] = {}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A word-level BPE with word ends, as its tokenizer file describes it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {**{i: t for t, i in self.ids.items()}, **{i: t for t, i in self.special.items()}}
        self.end = model["end_of_word_suffix"] or ""
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.units = regex.compile(pattern)
        self.controls = re.compile("[\x1c-\x1f]")
        self.splits = re.compile("(" + "|".join(re.escape(t) for t in self.special) + ")") if self.special else None
        symbols = byte_symbols()
        self.inner = np.array([self.ids[s] for s in symbols], np.int64)
        self.last = np.array([self.ids[s + self.end] for s in symbols], np.int64)
        self.width = max(self.tokens) + 1
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left, right = (np.array([self.ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        keys = left * self.width + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        lowest = np.full(self.width, _NONE)
        ranks = np.arange(len(pairs))
        np.minimum.at(lowest, left, ranks)
        np.minimum.at(lowest, right, ranks)
        self.whole = lowest[self.made] > ranks  # all places of the pair may be merged at once
        self.shown = [self.tokens.get(i, "") for i in range(self.width)]
        self.digits = [str(i) for i in range(self.width)]
        self.most = CACHE_WORDS
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def ranks(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        found = np.full(len(symbols), _NONE)
        keys = symbols[:-1] * self.width + symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[at] == keys) & (word[:-1] == word[1:])
        found[:-1][hit] = self.order[at[hit]]
        return found

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (UTF-8 bytes, none empty) in a row, and where each word's ids begin."""
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_word, done_symbols = [], []
        while len(symbols):
            ranks = self.ranks(symbols, word)
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(ranks, starts)
            spans = np.diff(np.append(starts, len(word)))
            best = np.repeat(best, spans)
            open_ = best < _NONE
            done_word.append(word[~open_])
            done_symbols.append(symbols[~open_])
            symbols, word, ranks, best = symbols[open_], word[open_], ranks[open_], best[open_]
            if not len(symbols):
                break
            hit = np.flatnonzero(ranks == best)
            first = np.ones(len(hit), bool)
            first[1:] = np.diff(hit) > 1
            run = np.maximum.accumulate(np.where(first, hit, 0))
            leftmost = np.ones(len(hit), bool)
            leftmost[1:] = word[hit[1:]] != word[hit[:-1]]
            # in a run of overlapping places every second one is merged, from the left
            hit = hit[np.where(self.whole[best[hit]], (hit - run) % 2 == 0, leftmost)]
            symbols[hit] = self.made[best[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        word, symbols = np.concatenate(done_word), np.concatenate(done_symbols)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def pieces(self, text: str) -> list[str]:
        """The normalised text cut at white space (lower case letter by letter, so no final sigma)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if self.controls.search(text):  # white space to Python, not to the tokenizer
            return [p for p in regex.split(r"\p{White_Space}+", text) if p]
        return text.split()

    def learn(self, pieces: list[str]) -> dict[str, tuple[str, str]]:
        """Ids and tokens of every piece, each joined by spaces."""
        units = [self.units.findall(p) for p in pieces]
        distinct = list({u for x in units for u in x})
        if not distinct:
            return {p: ("", "") for p in pieces}
        ids, bounds = self.merge([u.encode() for u in distinct])
        ids, bounds = ids.tolist(), bounds.tolist()
        digits, shown = [self.digits[i] for i in ids], [self.shown[i] for i in ids]
        texts = {u: (" ".join(digits[a:b]), " ".join(shown[a:b])) for u, a, b in zip(distinct, bounds, bounds[1:])}
        return {p: texts[x[0]] if len(x) == 1 else (
            " ".join([texts[u][0] for u in x]), " ".join([texts[u][1] for u in x])) for p, x in zip(pieces, units)}

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """Per text its decimal ids and its decoded text (without a decoder: the tokens), joined by spaces."""
        parts = []
        for t in texts:
            cut = self.splits.split(t) if self.splits and "<" in t else [t]
            parts.append([(p, None) if p in self.special else (None, self.pieces(p)) for p in cut])
        if len(self.known) > self.most:  # pieces that were not met since are forgotten
            self.known, self.older = {}, self.known
        get = self.known.get
        found = [[None if words is None else list(map(get, words)) for _, words in x] for x in parts]
        missing = set()
        for x, f in zip(parts, found):
            for (_, words), g in zip(x, f):
                if g and None in g:
                    missing.update([w for w, k in zip(words, g) if k is None])
        again = {w: self.older[w] for w in missing if w in self.older}
        again.update(self.learn([w for w in missing if w not in again]))
        self.known.update(again)
        out = []
        for x, f in zip(parts, found):
            row = []
            for (special, words), g in zip(x, f):
                if special is not None:
                    row.append((str(self.special[special]), special))
                elif None in g:
                    row.extend([again[w] if k is None else k for w, k in zip(words, g)])
                else:
                    row.extend(g)
            out.append((" ".join([k[0] for k in row]), " ".join([k[1] for k in row])))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library decodes where the file names no decoder: the tokens joined by spaces."""
        return " ".join([self.tokens[i] for i in ids])


def word_bpe(path: str) -> WordBpe:
    if path not in _MODELS:
        _MODELS[path] = WordBpe(path)
    return _MODELS[path]


def _coded(batches: Iterator[pa.RecordBatch], path: str, most: int):
    """Known pieces are forgotten after a task: its worker goes on to tasks of other operators."""
    release()
    model = word_bpe(path)
    model.most = most
    try:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                yield part, model.encode(part.column("text").to_pylist())
    finally:
        model.known, model.older = {}, {}
        release()


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the joined ids and of the decoded text, one row per row of ``docs``.

    A null text is the empty text: no tokens, and the digests of the empty string. No shuffle.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, coded in _coded(batches, path, CACHE_WORDS):
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([a.count(" ") + 1 if a else 0 for a, _ in coded], pa.int64()),
                pa.array([sha(a) for a, _ in coded]), pa.array([sha(b) for _, b in coded]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return whole_texts(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """doc_id, text, columns named in ``keep``, ids (array of int) and decoded text of every row.

    A column of ``docs`` that is called ids or decoded gives way to the result.
    """
    prepare(docs.sparkSession)
    rows = whole_texts(docs, *[f"`{c}`" for c in keep if c not in ("doc_id", "text", "ids", "decoded")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, coded in _coded(batches, path, ROW_CACHE_WORDS):
            ids = pa.array([[int(i) for i in a.split()] for a, _ in coded], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, ids, pa.array([b for _, b in coded])], names=[*part.schema.names, "ids", "decoded"])

    schema = StructType([*rows.schema.fields]).add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    return rows.mapInArrow(run, schema)
