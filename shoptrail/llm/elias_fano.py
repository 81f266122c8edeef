"""Elias-Fano sequences and a two-level trie of contexts and successors, in memory-mapped levels."""

from __future__ import annotations

import os
import tempfile

import numpy as np

_BITS = np.arange(64, dtype=np.uint64)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of every value, little end first, in 64-bit words (and one spare word)."""
    total = -(-(len(values) * width) // 64) + 1
    if width == 0 or len(values) == 0:
        return np.zeros(total, np.uint64)
    out = np.zeros(total * 8, np.uint8)
    step = 8 * (1 << 15)  # whole bytes per step
    for k in range(0, len(values), step):
        part = values[k : k + step]
        bits = ((part[:, None] >> _BITS[:width]) & np.uint64(1)).astype(np.uint8)
        data = np.packbits(bits.ravel(), bitorder="little")
        out[k * width // 8 : k * width // 8 + len(data)] = data
    return out.view(np.uint64)


def read_bits(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if width == 0:
        return np.zeros(len(index), np.uint64)
    at = index.astype(np.int64) * width
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    value = words[word] >> shift
    spill = (shift + np.uint64(width)) > 64
    value[spill] |= words[word[spill] + 1] << (np.uint64(64) - shift[spill])
    return value & np.uint64((1 << width) - 1)


class EliasFano:
    """A non-decreasing sequence: low bits as they are, high bits in unary with a rank directory.

    ``parts`` are the low words, the bit vector, and the ones before each of its words.
    """

    def __init__(self, parts: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, width: int):
        self.low, self.high, self.ones = parts
        self.n, self.width = n, width
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def build(values: np.ndarray, bits: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], int, int]:
        n = len(values)
        width = max(0, bits - max(1, n).bit_length())
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64)
        size = n + (1 << (bits - width)) + 1
        marks = np.zeros(-(-size // 64) * 64, bool)
        marks[high + np.arange(n)] = True
        vector = np.packbits(marks, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(marks.reshape(-1, 64).sum(axis=1))]).astype(np.uint32)
        return (pack_bits(values & np.uint64((1 << width) - 1), width), vector, ones), n, width

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """The place of the k-th one (or zero), counted from 0."""
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, k, side="right") - 1
        rest = k - before[word]
        bits = self.high[word] if one else ~self.high[word]
        place = np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):  # halve the word by its number of ones
            part = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            go = rest >= count
            rest = np.where(go, rest - count, rest)
            place += np.where(go, half, 0)
            bits = np.where(go, bits >> np.uint64(half), part)
        return word * 64 + place

    def access(self, index: np.ndarray) -> np.ndarray:
        high = (self._select(index, True) - index).astype(np.uint64)
        return (high << np.uint64(self.width)) | read_bits(self.low, index, self.width)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The index of every value in a strictly increasing sequence, -1 where it is absent."""
        out = np.full(len(values), -1, np.int64)
        if self.n == 0:
            return out
        bucket = (values >> np.uint64(self.width)).astype(np.int64)
        first = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), False) - bucket + 1, 0)
        last = self._select(bucket, False) - bucket
        low = values & np.uint64((1 << self.width) - 1)
        active = np.flatnonzero(first < last)
        while len(active):  # buckets hold about one value
            found = read_bits(self.low, first[active], self.width)
            equal = found == low[active]
            out[active[equal]] = first[active[equal]]
            first[active] += 1
            active = active[(found < low[active]) & (first[active] < last[active])]
        return out


class ContextTrie:
    """Contexts, pointers to their successors, successors and codes of one shard.

    Successors are numbered by the rank of their context, which makes one increasing sequence of them; a
    query finds the context's rank, then the successor behind that rank, inside the pointers' range. The levels
    lie in one temporary file that is mapped and at once unlinked, so pages may leave memory and nothing stays.
    """

    def __init__(self, keys: np.ndarray, codes: np.ndarray, half: int):
        self.half = half
        context, word = keys >> np.uint64(half), keys & np.uint64((1 << half) - 1)
        distinct, rank = np.unique(context, return_inverse=True)
        rank = rank.ravel().astype(np.uint64)
        starts = np.searchsorted(context, np.append(distinct, np.uint64(1 << half)))
        rank_bits = max(1, len(distinct)).bit_length()
        built = [
            EliasFano.build(distinct, half),
            EliasFano.build(starts, max(1, len(keys)).bit_length()),
            EliasFano.build((rank << np.uint64(half)) | word, rank_bits + half),
        ]
        arrays = [a for parts, *_ in built for a in parts] + [codes]
        handle, path = tempfile.mkstemp(suffix=".trie")
        with os.fdopen(handle, "wb") as sink:
            for a in arrays:
                sink.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
        mapped, place = np.memmap(path, np.uint8, "r"), 0
        os.unlink(path)
        views = []
        for a in arrays:
            views.append(mapped[place : place + a.nbytes].view(a.dtype))
            place += a.nbytes + -a.nbytes % 8
        self.contexts, self.pointers, self.successors = (
            EliasFano(tuple(views[3 * k : 3 * k + 3]), n, width) for k, (_, n, width) in enumerate(built))
        self.codes = views[-1]

    def query(self, keys: np.ndarray, step: int = 1 << 14) -> np.ndarray:
        """The code of every key (context above, word below), 0 where it is absent.

        Keys are taken in steps that stay in the processor's cache; sorted ones also read near each other.
        """
        parts = [self._query(keys[k : k + step]) for k in range(0, len(keys), step)]
        return np.concatenate(parts) if parts else np.zeros(0, self.codes.dtype)

    def _query(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), self.codes.dtype)
        rank = self.contexts.find(keys >> np.uint64(self.half))
        known = np.flatnonzero(rank >= 0)
        if len(known):
            rank = rank[known]
            word = keys[known] & np.uint64((1 << self.half) - 1)
            place = self.successors.find((rank.astype(np.uint64) << np.uint64(self.half)) | word)
            inside = (place >= 0) & (place >= self.pointers.access(rank)) & (place < self.pointers.access(rank + 1))
            out[known[inside]] = self.codes[place[inside]]
        return out
