"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A batch's texts lie end to end in one buffer. Which bytes belong to words is looked up in a table of
256 entries, so word borders are found by comparing neighbours. All bytes from 0x80 on are parts of
other UTF-8 characters and belong to words in both classes below. A word's hash is a polynomial in
its bytes, taken from running sums, then mixed; it is 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone and whole.
SLICE = 2_000_000

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Words are runs of anything but white space: `[^\x20\x09-\x0D]+`
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of letters and digits: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finish of splitmix64)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, SLICE + 64), base, np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        if len(held) <= 2 * SLICE:
            _powers[base] = held
    return held[:n]


@dataclass
class Words:
    """Words of several texts: bytes `data[starts[i]:ends[i]]`; text d has words first[d]:first[d+1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * powers(INVERSE, len(self.data))[self.starts]
        return mix(raw)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def find(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Words of the texts `data[offsets[d]:offsets[d+1]]`; none crosses a text's border."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), np.int64))
    inside = kind[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[heads] = inside[heads]
    stops[tails] = inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together, or of one longer text."""
    n, begin = len(offsets) - 1, 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, end
        begin = end


def lowered(column: pa.Array, kind: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """For each slice of a text column: its range of rows and its words, A-Z in lower case."""
    data, offsets = buffers(column)
    for begin, end in slices(offsets):
        low, high = offsets[begin], offsets[end]
        yield begin, end, find(LOWER[data[low:high]], offsets[begin : end + 1] - low, kind)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, borders of texts ignored; shorter by k - 1 than its input."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= np.uint64(BASE)
        total += hashes[j : j + n]
    return mix(total)


def inner(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n - k + 1 runs of k words stay inside one text."""
    kept = np.ones(max(n - k + 1, 0), bool)
    for j in range(1, k):
        crossing = first[1:-1] - j
        kept[crossing[(crossing >= 0) & (crossing < len(kept))]] = False
    return kept


class Lookup:
    """Distinct keys of at least 0 and their values, in an open table of arrays; many keys are asked at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, absent: int):
        self.bits, self.absent = max(len(keys).bit_length() + 3, 4), absent
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, absent, np.int32)
        slot = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            free = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(self.absent))
        more = np.flatnonzero((found != keys) & (found >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[more]]
            hit = found == keys[more]
            out[more[hit]] = self.values[slot[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out
