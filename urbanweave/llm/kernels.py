"""Vectorised work on the UTF-8 bytes of many texts at once, used inside Arrow tasks.

A column of texts is one byte buffer with offsets. Words, lines and their hashes are found with whole-array numpy
operations, so no Python code runs per word. A batch is taken in pieces of about :data:`PIECE` bytes (a longer text is
a piece of its own), which bounds memory by a small multiple of a piece or of the longest text. A null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once.
PIECE = 500_000

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, joins word hashes to window hashes

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: all but white space; and only digits, letters and bytes of non-ASCII characters.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BROAD = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


@cache
def _seeded(seed: int) -> tuple[np.ndarray, int]:
    """A random 64-bit value for each byte, and an odd base."""
    drawn = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64, 257, dtype=np.uint64)
    return drawn[:256], int(drawn[256]) | 1


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """``base ** i`` modulo 2 ** 64 for ``i < count``; kept for the next piece."""
    if base not in _POWERS or len(_POWERS[base]) < count:
        steps = np.full(1 << max(count, 1 << 16).bit_length(), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Flat:
    """Texts of one piece: ``first[i]:first[i + 1]`` are the bytes of text ``i``. Hashes fold A-Z to a-z unless ``fold`` is off."""

    def __init__(self, raw: np.ndarray, first: np.ndarray, fold: bool = True):
        self.raw, self.first = raw, first
        self.low = LOWER[raw] if fold else raw
        self._prefix: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.first) - 1

    def span_hash(self, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
        """64-bit hash of the bytes ``start:end`` (folded or not), equal for equal bytes wherever they stand."""
        table, base = _seeded(seed)
        if seed not in self._prefix:
            sums = np.zeros(len(self.low) + 1, np.uint64)
            np.cumsum(table[self.low] * _powers(base, len(self.low)), out=sums[1:])
            self._prefix[seed] = sums
        sums = self._prefix[seed]
        back = _powers(pow(base, -1, 1 << 64), len(self.low) + 1)
        return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))

    def short_span_hash(self, start: np.ndarray, end: np.ndarray, seed: int, most: int) -> np.ndarray:
        """:meth:`span_hash` of spans of at most ``most`` bytes, byte by byte instead of by sums over the whole piece."""
        table, base = _seeded(seed)
        total = (end - start).astype(np.uint64)
        for j in range(most):
            inside = np.flatnonzero(start + j < end)
            total[inside] += table[self.low[start[inside] + j]] * np.uint64(pow(base, j, 1 << 64))
        return mix(total)

    def words(self, kind: np.ndarray) -> Words:
        inside = kind[self.raw]
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        before[self.first] = False  # a word ends with its text
        starts = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        after[self.first] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return Words(self, starts, ends, np.searchsorted(starts, self.first))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every line (split at LF; an empty text is one empty line), and the lines before each text."""
        breaks = np.flatnonzero(self.raw == 10)
        at = np.searchsorted(breaks, self.first)
        counts = np.diff(at) + 1
        first = np.concatenate([[0], np.cumsum(counts)])
        start = np.empty(first[-1], np.int64)
        end = np.empty(first[-1], np.int64)
        heads = np.zeros(first[-1], bool)
        heads[first[:-1]] = True
        tails = np.zeros(first[-1], bool)
        tails[first[1:] - 1] = True
        start[heads], end[tails] = self.first[:-1], self.first[1:]
        start[~heads], end[~tails] = breaks + 1, breaks
        return start, end, first

    def stripped(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same spans without white space at both ends."""
        solid = np.flatnonzero(BROAD[self.raw])
        if not len(solid):
            return start, start
        head = np.searchsorted(solid, start)
        tail = np.searchsorted(solid, end)
        full = tail > head
        last = len(solid) - 1
        return (np.where(full, solid[np.minimum(head, last)], start),
                np.where(full, solid[np.clip(tail - 1, 0, last)] + 1, start))

    def characters(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points in each span."""
        heads = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum((self.raw & 0xC0) != 0x80, out=heads[1:])
        return heads[end] - heads[start]


class Words:
    """Words of a piece: byte spans, and ``first`` as the number of words before each text."""

    def __init__(self, flat: Flat, start: np.ndarray, end: np.ndarray, first: np.ndarray):
        self.flat, self.start, self.end, self.first = flat, start, end, first
        self.counts = np.diff(first)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 1) -> np.ndarray:
        return self.flat.span_hash(self.start, self.end, seed)

    def owner(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def runs(self, hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of the sequence of words ``lo:hi``, whatever stands between the words."""
        base = int(_STEP)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _powers(base, len(hashes)), out=sums[1:])
        back = _powers(pow(base, -1, 1 << 64), len(hashes) + 1)
        return mix((sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(np.uint64))

    def windows(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of ``length`` words inside one text, and the hashes of the windows."""
        count = len(hashes) - length + 1
        if count <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        joined = hashes[:count].copy()
        for k in range(1, length):
            joined *= _STEP
            joined += hashes[k:k + count]
        at = np.flatnonzero(np.arange(count) + length <= np.repeat(self.first[1:], self.counts)[:count])
        return at, mix(joined[at])


def pieces(column: pa.Array, limit: int = PIECE, fold: bool = True) -> Iterator[tuple[int, Flat]]:
    """A column in pieces of whole texts: position of the first text, and the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    count = len(column)
    if not count:
        return
    ends = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + count + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < count:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield at, Flat(raw[ends[at]:ends[to]], ends[at:to + 1] - ends[at], fold)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as the long values that Spark holds."""
    return x.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Consecutive values as one list for each count."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def distinct_in_owner(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Positions of the first row of each distinct ``(owner, key)``; ``owner`` is ascending."""
    order = np.lexsort((key, owner))
    own, keys = owner[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (own[1:] != own[:-1]) | (keys[1:] != keys[:-1])
    return np.sort(order[new])
