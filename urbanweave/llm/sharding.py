"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has :data:`POINTS` points, or as many more as shards need to lie apart. Every shard owns ``virtual`` of them; an arc is the run of points that ends at an owned point, and a
key belongs to the arc its hash falls in. It goes to the arc's shard, or, if that is full, clockwise to the next shard with
room. No shard takes more than its share of the rows times ``1 + slack``; with no slack the counts are at most one apart.

Rows are taken in a fixed order: by one of :data:`TURNS` turns, drawn from the hash of the row, then by arc, hash and id. All rows of
a turn and an arc (a *cell*) have the same preferences, so the filling needs only the number of rows in each cell: the driver
walks over at most :data:`CELLS` counts (one for each arc, if those are more), however many rows there are, and hands back rank ranges. Everything else is
DataFrame functions: one aggregate of narrow rows, one window per cell, one broadcast of the bounded plan.

The key of a row is its id (its text where the id is null). Rows equal in id, size and checksum are counted as one with a
multiplicity and only expanded at the end, so repeated rows form no hot cell.

Defined cases: a null text has size 1 and checksum 0; null ids are sharded by their texts; an empty table gives an empty table; other
columns aren't read. The result doesn't depend on how the input is partitioned.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.llm.shared import saved
from urbanweave.session import settle

#: Points of the ring at least, turns that the rows are taken in at most, and counts that the driver walks over.
POINTS = 1 << 14
TURNS = 64
CELLS = 1 << 19
#: Points up to which the way from a point to its arc is a constant of the query, not a join.
CONSTANT = 1 << 17


def ring_bits(owned: int) -> int:
    """Points of the ring as a power of two: at least four for each owned one."""
    return max(POINTS - 1, 4 * owned - 1).bit_length()


def ring(shards: int, virtual: int = 64) -> list[tuple[int, int]]:
    """Owned points in clockwise order, as ``(point, shard)``. A new shard adds points and moves none; a larger ring keeps their order."""
    bits = ring_bits(shards * virtual)
    owned: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual):
            trial = 0
            while (point := int.from_bytes(hashlib.sha256(f"{shard}/{node}/{trial}".encode()).digest()[:4], "big") >> (32 - bits)) in owned:
                trial += 1
            owned[point] = shard
    return sorted(owned.items())


def fill(cells: dict[tuple[int, int], int], owned: list[tuple[int, int]], shards: int,
         slack: float = 0.0) -> list[tuple[int, int, int, int, int, int]]:
    """Where the rows of each cell go: ``(turn, arc, first rank, rank after the last, shard, first slot)``.

    From its own arc a cell goes clockwise to the next one whose shard has room. Full shards stay full, so the way past their
    arcs is kept and shortened whenever it is gone.
    """
    total = sum(cells.values())
    room = [int((total // shards) * (1 + slack)) + (k < total % shards) for k in range(shards)]
    used, onward, plan = [0] * shards, list(range(len(owned))), []

    def next_open(arc: int) -> int:
        passed = []
        while used[owned[arc][1]] >= room[owned[arc][1]]:
            passed.append(arc)
            arc = onward[arc] if onward[arc] != arc else (arc + 1) % len(owned)
        for p in passed:
            onward[p] = arc
        return arc

    for (turn, arc), count in sorted(cells.items()):
        rank, at = 0, arc
        while rank < count:
            at = next_open(at)
            shard = owned[at][1]
            take = min(count - rank, room[shard] - used[shard])
            plan.append((turn, arc, rank, rank + take, shard, used[shard]))
            used[shard] += take
            rank += take
    return plan


def _with_arcs(rows: DataFrame, key: Column, owned: list[tuple[int, int]], out: str) -> DataFrame:
    """The arc of a key: a constant lookup from ring point to the next owned point clockwise, or a join for a large ring."""
    bits = ring_bits(len(owned))
    point = F.shiftrightunsigned(key, 64 - bits).cast("int")
    if 1 << bits <= CONSTANT:
        arcs, at = [], 0
        for place in range(1 << bits):
            while at < len(owned) and owned[at][0] < place:
                at += 1
            arcs.append(at % len(owned))
        table = F.split(F.lit(",".join(map(str, arcs))), ",").cast("array<int>")  # folded once, when the query is planned
        return rows.withColumn(out, F.element_at(table, point + 1))
    ends = [o[0] for o in owned]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    runs = [(k, a, b) for k, (a, b) in enumerate(zip(starts, ends, strict=True))]
    runs += [(0, ends[-1] + 1, (1 << bits) - 1)] if ends[-1] + 1 < 1 << bits else []
    places = rows.sparkSession.createDataFrame(runs, "arc int, lo int, hi int").select("arc", F.explode(F.sequence("lo", "hi")).alias("place"))
    return rows.withColumn("__place", point).join(settle(places), F.col("__place") == F.col("place")).withColumnRenamed("arc", out).drop("__place", "place")


def shard_rows(docs: DataFrame, shards: int = 8, virtual: int = 64, slack: float = 0.0, doc: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Every row's place: ``(doc_id, size, text_crc32, shard, slot)``; slots are gapless from 0 in each shard."""
    spark = docs.sparkSession
    owned = ring(shards, virtual)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), size.alias("size"), F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0).cast("long")).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("__n"))
    key = F.xxhash64(F.coalesce("doc_id", F.col("text_crc32") * 4096 + F.col("size")))
    order = F.xxhash64("doc_id", "size", "text_crc32")
    turns = max(1, min(TURNS, CELLS // len(owned)))
    celled = saved(_with_arcs(counted, key, owned, "__arc").withColumn("__order", order)
                   .withColumn("__turn", F.pmod(F.col("__order"), F.lit(turns)).cast("int")), "shard-rows")
    cells = {(r[0], r[1]): r[2] for r in celled.groupBy("__turn", "__arc").agg(F.sum("__n")).collect()}  # a bounded table
    plan = spark.createDataFrame(fill(cells, owned, shards, slack), "turn int, arc int, lo long, hi long, shard int, slot long")
    window = Window.partitionBy("__turn", "__arc").orderBy("__order", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
    ranked = celled.withColumn("__to", F.sum("__n").over(window)).withColumn("__from", F.col("__to") - F.col("__n"))
    met = ranked.join(F.broadcast(plan), (F.col("__turn") == F.col("turn")) & (F.col("__arc") == F.col("arc"))
                      & (F.col("__from") < F.col("hi")) & (F.col("__to") > F.col("lo")))
    rank = F.sequence(F.greatest("__from", "lo"), F.least("__to", "hi") - 1)
    placed = met.select("doc_id", "size", "text_crc32", "shard", "lo", "slot", F.explode(rank).alias("__rank"))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("__rank") - F.col("lo")).alias("slot"))
