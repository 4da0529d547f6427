"""Periodic runs of words: frequency splitting down to what can hold a run, then a scan of lags.

A run is a longest stretch of consecutive words in which words one period apart are equal, of the smallest such period ``q``, with at
least ``max(shortest, times * q)`` words. So a word of a run occurs ``times`` times in it at least. A word that occurs fewer times within
the segment at hand can't be in a run there: it splits the segment, the pieces are counted anew, and so on until no
segment changes. This is done for all texts of a batch at once: a round is one sort of the words still in play.

What survives is scanned lag by lag. A run of period ``q`` holds three consecutive multiples of ``q`` whose words recur ``q`` later, so
only every ``q``-th word is compared: ``n log n`` comparisons for a segment of ``n`` words. Where three in a row agree, the run is followed
to both ends. Places in a known run of a smaller period that goes on for two lags are passed over: the smaller period would hold in both.

Words are runs of anything but ASCII white space, told apart by 64 bits of hash with their case. A word is dropped if a run
contains it after the run's first ``q`` words.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text; null and repeated ids are rows like others;
runs may overlap and are listed by start, then period; an empty table gives an empty table. Nothing is shuffled: a row is
worked on where it is read, and memory is bounded by a batch, or by the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.kernels import BROAD, lists, pieces

#: Splitting ends when this many times the words were counted; what isn't stable by then is scanned as it is, with the same result.
ROUNDS = 64


def stable_segments(words: np.ndarray, first: np.ndarray, times: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the segments in which every word occurs ``times`` times; ``first`` are the bounds of the texts."""
    start, end = first[:-1], first[1:]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    budget = ROUNDS * max(len(words), 1)
    while True:
        long = end - start >= shortest
        start, end = start[long], end[long]
        size = end - start
        budget -= int(size.sum())
        if not len(start) or budget < 0:
            break
        before = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(start)), size)
        at = np.arange(len(owner)) - before[owner] + start[owner]
        order = np.lexsort((words[at], owner))
        own, word = owner[order], words[at][order]
        head = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (word[1:] != word[:-1])]))
        count = np.diff(np.append(head, len(order)))
        rare = np.zeros(len(order), bool)
        rare[order] = np.repeat(count < times, count)
        split = np.bincount(owner, rare, len(start)) > 0
        done.append((start[~split], end[~split]))
        inside = split[owner] & ~rare
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1])
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | (owner[1:] != owner[:-1])
        start, end = at[opens], at[closes] + 1
    start, end = np.concatenate([*[x for x, _ in done], start]), np.concatenate([*[y for _, y in done], end])
    order = np.argsort(start)
    return start[order], end[order]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, forward or backward, hold words that recur ``lag`` later."""
    last = len(words) - lag if step > 0 else at + 1
    total, width = 0, 64
    while True:
        if step > 0:
            lo, hi = at + total, min(at + total + width, last)
            same = words[lo:hi] == words[lo + lag:hi + lag]
        else:
            hi = at - total + 1
            lo = max(hi - width, 0)
            same = (words[lo:hi] == words[lo + lag:hi + lag])[::-1]
        if not len(same):
            return total
        if not same.all():
            return total + int(np.argmin(same))
        total += len(same)
        width *= 2


def runs_in(words: np.ndarray, times: int, shortest: int) -> list[tuple[int, int, int]]:
    """All runs of a segment, as ``(start, length, period)``."""
    count, found = len(words), []
    covered = np.zeros(count, np.int64)  # how far a known run goes that holds the word
    for lag in range(1, count // times + 1):
        every = words[::lag]
        same = every[:-1] == every[1:]
        row = same[:-2] & same[1:-1] & same[2:]
        if not row.any():
            continue
        places = np.flatnonzero(row) * lag
        # Two periods in one stretch as long as both together leave only their common divisor.
        for at in places[covered[places] < places + 2 * lag].tolist():
            if covered[at] >= at + 2 * lag:  # by the run just found
                continue
            onward = _reach(words, at, lag, 1)
            if onward <= 2 * lag:  # the three agree by chance
                continue
            lo = at + 1 - _reach(words, at, lag, -1)
            length = at + onward - lo + lag
            if length >= max(shortest, times * lag):
                found.append((lo, length, lag))
                own = covered[lo:lo + length]
                np.maximum(own, lo + length, out=own)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _joined(flat, start: np.ndarray, size: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One text for each count: that many of the byte spans, joined by blanks."""
    ends = np.cumsum(counts)
    gaps = np.ones(len(size), np.int64)
    gaps[ends[counts > 0] - 1] = 0  # none after the last word of a text
    lengths = size + gaps
    to = np.cumsum(lengths)
    total = int(to[-1]) if len(to) else 0
    source = np.repeat(start - (to - lengths), lengths) + np.arange(total)
    blank = to[gaps > 0] - 1
    source[blank] = 0
    out = flat.raw[source]
    out[blank] = 32
    offsets = np.concatenate([[0], to])[np.concatenate([[0], ends])]
    return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def periodic_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", times: int = 4, shortest: int = 6,
                  arrange: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """For each row ``(doc, n_words, runs, collapsed)``: runs as structs of start, length and period, and the kept words.

    ``arrange`` may put other words in place of a text's own: given its id and its number of words, it says which word of
    the text stands at each place, or None. It isn't asked for rows without id.
    """
    if not 4 <= times or shortest < times:
        raise ValueError("a run is told by three equal lags at least: times >= 4 and shortest >= times")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, flat in pieces(batch.column(1), fold=False):
                found = flat.words(BROAD)
                start, size, first = found.start, found.end - found.start, found.first
                words = found.hashes()
                if arrange is not None:
                    parts = [np.arange(first[k], first[k + 1]) for k in range(len(flat))]
                    for k, own in enumerate(ids.slice(at, len(flat)).to_pylist()):
                        placed = arrange(own, len(parts[k])) if own is not None else None
                        if placed is not None:
                            parts[k] = first[k] + placed
                    places = np.concatenate(parts)
                    words, start, size = words[places], start[places], size[places]
                    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                stays, runs = np.ones(len(words), bool), []
                for lo, hi in zip(*(x.tolist() for x in stable_segments(words, first, times, shortest)), strict=True):
                    for begin, length, period in runs_in(words[lo:hi], times, shortest):
                        runs.append((lo + begin, length, period))
                        stays[lo + begin + period:lo + begin + length] = False
                table = np.array(runs, np.int64).reshape(-1, 3)
                owner = np.searchsorted(first, table[:, 0], side="right") - 1
                table[:, 0] -= first[owner]
                spans = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)], ["start", "length", "period"])
                kept = np.diff(np.concatenate([[0], np.cumsum(stays)])[first])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(flat)), pa.array(np.diff(first)), lists(spans, np.bincount(owner, minlength=len(flat))), _joined(flat, start[stays], size[stays], kept)],
                    names=["doc", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(scan, "doc long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
