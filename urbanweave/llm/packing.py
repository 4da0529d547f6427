"""Packing into fixed token sequences as a cutting-stock problem, solved by column generation over a histogram of lengths.

Texts become token ids with one end id. A document of more than ``size`` ids is cut into full sequences and a rest. Lengths of the
pieces are counted in units of ``grid`` ids (rounded up), so the problem has ``size / grid`` demands whatever the input.

1. The histogram of units is aggregated; at most ``size / grid * SALTS`` rows reach the driver.
2. The linear program over patterns (how many pieces of each size share a sequence) starts with patterns of one size. Dual
   prices go into a knapsack dynamic program that finds the best new pattern; it ends when no pattern gains more than
   :data:`GAP`. Patterns are used ``floor(x)`` times; what is left, a few sequences per size at most, is filled first-fit.
3. Pieces are ranked within their size (ranks of salted groups plus offsets, so no size is one task) and rank ranges are
   dealt to patterns with a broadcast table of bounded size. Offsets follow from a window over each sequence.

Padding is what rounding to the grid leaves. Ranks, and so the packing, depend on ids and contents only, not on partitions.

Defined cases: a null text is empty and has the end id only; rows with equal ids are packed each by itself (equal pieces may be
told apart by nothing, their places are interchangeable); an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.llm.kernels import lists, pieces
from urbanweave.llm.shared import saved
from urbanweave.llm.tokens import tokenizer

#: Groups that each size is ranked in.
SALTS = 64

#: Column generation ends when the best pattern is worth no more than this above one sequence.
GAP = 1e-3


def token_pieces(docs: DataFrame, tokenizer_path: str, doc: str = "doc_id", text: str = "text", size: int = 4096, end_id: int = 2,
                 ids: bool = False) -> DataFrame:
    """Pieces of every document: ``(doc_id, start, length, ids_crc32, doc_tokens)``, with their ids if asked for."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path)
        for batch in batches:
            keys = batch.column(0)
            for at, flat in pieces(batch.column(1)):
                found, first = encoder.encode(flat)
                own, start, length, crc, whole, parts = [], [], [], [], [], []
                for k in range(len(flat)):
                    tokens = np.append(found[first[k]:first[k + 1]], end_id).astype("<u4")
                    for lo in range(0, len(tokens), size):
                        part = tokens[lo:lo + size]
                        own.append(at + k)
                        start.append(lo)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        whole.append(len(tokens))
                        if ids:
                            parts.append(part.astype(np.int32))
                arrays = [keys.take(pa.array(own, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, whole)]]
                if ids:
                    arrays.append(lists(np.concatenate(parts), np.array(length)))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * ids
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * ids)


def _best_pattern(units: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the worth of the best pattern and its counts. ``units`` is ascending."""
    gain = np.flatnonzero(prices > 1e-12)  # a size at no price may be left out of a pattern
    counts = np.zeros(len(units), np.int64)
    if not len(gain):
        return 0.0, counts
    sizes, worths = units[gain], prices[gain]
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    reach = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(int(sizes[0]), capacity + 1):
        worth = best[room - sizes[:reach[room]]] + worths[:reach[room]]
        pick = int(np.argmax(worth))
        best[room], choice[room] = (worth[pick], pick) if worth[pick] > best[room - 1] else (best[room - 1], -1)
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[gain[choice[room]]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), counts


def fractional_patterns(units: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Column generation: patterns (rows of counts) and how often, as reals, each is used."""
    m = len(units)
    patterns = np.diag(capacity // units).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(patterns))
    used = inverse @ demand
    for _ in range(50 * m):
        prices = inverse.sum(axis=0)
        worth, counts = _best_pattern(units, prices, capacity)
        if worth <= 1 + gap:
            break
        along = inverse @ counts
        ratio = np.full(m, np.inf)
        up = along > 1e-9
        ratio[up] = used[up] / along[up]
        out = int(np.argmin(ratio))
        step = max(ratio[out], 0.0)
        used -= step * along
        used[out] = step
        row = inverse[out] / along[out]
        inverse -= np.outer(along, row)
        inverse[out] = row
        patterns[out] = counts
    return patterns, np.maximum(used, 0)


def whole_patterns(units: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering the demand exactly."""
    patterns, used = fractional_patterns(units, demand.astype(float), capacity)
    left, out = demand.copy(), []
    for counts, times in zip(patterns, np.floor(used + 1e-7).astype(np.int64).tolist(), strict=True):
        has = counts > 0
        times = min(times, int((left[has] // counts[has]).min()))
        if times > 0:
            left -= counts * times
            out.append((counts, times))
    while left.any():  # first fit, largest first; at most a few sequences for each size
        counts, room = np.zeros_like(left), capacity
        for k in range(len(units) - 1, -1, -1):
            counts[k] = min(left[k], room // units[k])
            room -= int(counts[k] * units[k])
        has = counts > 0
        times = int((left[has] // counts[has]).min())
        left -= counts * times
        out.append((counts, times))
    return out


def pack(docs: DataFrame, tokenizer_path: str, doc: str = "doc_id", text: str = "text", size: int = 4096, grid: int = 16,
         end_id: int = 2, ids: bool = False) -> DataFrame:
    """All pieces with their places: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, and ids if asked for."""
    spark = docs.sparkSession
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)).cast("int")
    cut = saved(token_pieces(docs, tokenizer_path, doc, text, size, end_id, ids).withColumn("__salt", salt)
                .withColumn("__unit", F.ceil(F.col("length") / grid).cast("int")), "pieces")
    sizes = {(r[0], r[1]): r[2] for r in cut.groupBy("__unit", "__salt").count().collect()}  # size / grid * SALTS rows at most
    units = np.array(sorted({u for u, _ in sizes}), np.int64)
    before, demand = [], np.zeros(len(units), np.int64)
    for k, unit in enumerate(units.tolist()):
        for part in range(SALTS):
            if count := sizes.get((unit, part)):
                before.append((unit, part, int(demand[k])))
                demand[k] += count
    deals, taken, sequences = [], np.zeros(len(units), np.int64), 0
    for counts, times in whole_patterns(units, demand, size // grid) if len(units) else []:
        for k in np.flatnonzero(counts).tolist():
            share = int(counts[k]) * times
            deals.append((int(units[k]), int(taken[k]), int(taken[k]) + share, int(counts[k]), sequences))
            taken[k] += share
        sequences += times
    offsets = spark.createDataFrame(before, "u int, part int, before long")
    dealt = spark.createDataFrame(deals, "u int, lo long, hi long, each long, base long")
    names = [c for c in cut.columns if not c.startswith("__")]
    local = Window.partitionBy("__unit", "__salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (cut.withColumn("__local", F.row_number().over(local) - 1)
              .join(F.broadcast(offsets), (F.col("__unit") == F.col("u")) & (F.col("__salt") == F.col("part")))
              .select(*names, "__unit", (F.col("before") + F.col("__local")).alias("__rank")))
    placed = (ranked.join(F.broadcast(dealt), (F.col("__unit") == F.col("u")) & (F.col("__rank") >= F.col("lo")) & (F.col("__rank") < F.col("hi")))
              .withColumn("sequence_id", F.expr("base + (__rank - lo) div each")))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("__unit"), "__rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*[c for c in names if c != "ids"], "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"),
                         *["ids"] * ids)
