"""A Merkle manifest of a dataset: a tree of digests for each group of rows and one over the groups, with proofs for every row.

Leaves of a group ascend by key. While there are several nodes, every :data:`ARITY` consecutive ones (the last run: fewer, even one)
become the digest of their digests, as hex text one after the other. The groups' roots, in the order of the groups, are the leaves of a
tree of the same kind.

Nodes are laid out as van Emde Boas did: a tree is split at half its height, the upper half comes first, then the subtrees below it
from left to right, each laid out the same way. :func:`address` is the place of a node in that order. Two things follow it. A tree
is cut at half height again and again into *bands* of at most :data:`BLOCK` levels; an aligned subtree of a band is a *block*, a
row of the manifest with its digests in that order. And a band is built from the block roots of the band below, so building goes up
band by band over ever fewer rows, and the siblings on the way from a row to the root are read at computed addresses of one block a band.

A block has at most ``ARITY ** BLOCK`` leaves, so no row or task grows with a group. Ranks come from rows sorted in ranges, with the sizes
of the runs before added, so a group with a third of all rows is numbered by as many tasks as its rows fill.

Defined cases: a null field is written ``-``; null groups are one group, before all others; null keys come before all others; rows
of one group with equal keys are ordered by their digests; rows repeated as a whole are leaves of their own; an empty table has no
blocks and no proofs; columns that aren't named aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.llm.shared import saved
from urbanweave.session import settle

ARITY = 3

#: Most levels of a block above its leaves: 729 leaves, 1093 digests of 32 bytes.
BLOCK = 6

_BYTES = 32


def nodes_in(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: int) -> int:
    """Place of the ``index``-th node at a depth below the root, in the layout of a full tree of so many levels."""
    if levels == 1:
        return 0
    upper = levels - levels // 2
    if depth < upper:
        return address(upper, depth, index)
    lower = levels - upper
    which, inside = divmod(index, ARITY ** (depth - upper))
    return nodes_in(upper) + which * nodes_in(lower) + address(lower, depth - upper, inside)


@cache
def addresses(height: int) -> list[list[int]]:
    """Places of all nodes of a block, by their height above its leaves."""
    return [[address(height + 1, height - up, k) for k in range(ARITY ** (height - up))] for up in range(height + 1)]


def bands(height: int, limit: int = BLOCK) -> list[int]:
    """Heights of the bands of a tree, from the leaves up: halves of halves, until they are within the limit."""
    if height <= limit:
        return [height] if height else []
    return bands(height // 2, limit) + bands(height - height // 2, limit)


def height_of(leaves: int) -> int:
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fill_block(leaves: Sequence[str], height: int) -> tuple[bytes, str]:
    """Digests of a block in its layout (zeros where there is no node), and its root."""
    places, level = addresses(height), list(leaves)
    out = bytearray(nodes_in(height + 1) * _BYTES)
    for up in range(height + 1):
        for at, own in zip(places[up], level):
            out[at * _BYTES:(at + 1) * _BYTES] = bytes.fromhex(own)
        if up < height:
            level = [_digest(*level[k:k + ARITY]) for k in range(0, len(level), ARITY)]
    return bytes(out), level[0]


def siblings(block: bytes, height: int, count: int, leaf: int) -> list[tuple[str, str]]:
    """Digests before and after a leaf and each node above it in their runs, read at their addresses; ``count`` leaves are there."""
    places, out = addresses(height), []
    for up in range(height):
        run = leaf // ARITY * ARITY
        near = ["".join(block[at * _BYTES:(at + 1) * _BYTES].hex() for at in places[up][lo:hi]) for lo, hi in
                ((run, leaf), (leaf + 1, min(run + ARITY, count)))]
        out.append((near[0], near[1]))
        leaf, count = leaf // ARITY, -(-count // ARITY)
    return out


def fold(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        leaf = _digest(before, leaf, after)
    return leaf


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its text, or ``-``."""
    written = []
    for field in fields:
        text = field.cast("string")
        written.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*written).cast("binary"), 256)


def _numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with ``run``, the stretch of equal groups within a sorted range, and ``at``, the place in it from 0; written."""
    names = rows.columns
    ranged = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in (*group, *order)])
    ordered = ranged.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in (*group, *order)])
    keys = [names.index(c) for c in group]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, at, last = (TaskContext.get().partitionId() << 32) - 1, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for k in keys:
                own = batch.column(k)
                differs = pc.not_equal(own[1:], own[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
                empty = own.is_null().to_numpy(zero_copy_only=False)
                new[1:] |= differs | (empty[1:] != empty[:-1])
            head = [batch.column(k)[0].as_py() for k in keys]
            new[0] = head != last
            last = [batch.column(k)[-1].as_py() for k in keys]
            starts = np.flatnonzero(new)
            since = np.arange(batch.num_rows)
            begin = np.zeros(batch.num_rows, np.int64)
            begin[starts] = starts
            begin = np.maximum.accumulate(begin)
            place = np.where(np.cumsum(new) > 0, since - begin, since + at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(run + np.cumsum(new)), pa.array(place)], names=[*names, "run", "at"])
            run, at = run + len(starts), int(place[-1]) + 1

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return saved(ordered.mapInArrow(number, f"{kinds}, run long, at long"), "numbered")


@dataclass
class Manifest:
    """``leaves`` are the lowest blocks with the keys of their rows; ``bands`` and ``top`` are all blocks, from the lowest up.

    Blocks are rows ``(tree, block, size, height, nodes, root)``: the number of the group in its order, the place of the block in
    its band, leaves, height, and the digests in the layout. ``groups`` is ``(tree, group, subroot)``.
    """

    leaves: DataFrame
    bands: list[DataFrame]
    top: list[DataFrame]


def _blocks(nodes: DataFrame, below: int, height: int, extra: Sequence[str], label: str) -> DataFrame:
    """Blocks over nodes ``(tree, size, rank, digest, *extra)`` that stand ``below`` levels above the leaves of their trees."""
    own = F.struct(F.col("rank"), F.col("digest"), *[F.col(c) for c in extra])
    width = ARITY**height
    gathered = nodes.groupBy("tree", F.floor(F.col("rank") / width).cast("long").alias("block")).agg(
        F.first("leaves").alias("leaves"), F.array_sort(F.collect_list(own)).alias("own"))
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                total = batch.column(2)[k].as_py()
                own = batch.column(3)[k].values
                digests = own.field("digest").to_pylist()
                up = max(min(height, height_of(total) - below), 0)
                made, root = fill_block(digests, up)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), batch.column(2).slice(k, 1), pa.array([len(digests)], pa.int32()), pa.array([up], pa.int32()),
                     pa.array([made]), pa.array([root]), *[pa.ListArray.from_arrays(pa.array([0, len(digests)], pa.int32()), own.field(c)) for c in extra]],
                    names=["tree", "block", "leaves", "size", "height", "nodes", "root", *extra])

    lists = "".join(f", `{c}` array<{kinds[c]}>" for c in extra)
    return saved(gathered.mapInArrow(build, f"tree long, block long, leaves long, size int, height int, nodes binary, root string{lists}"), label)


def _stack(nodes: DataFrame, heights: Sequence[int], extra: Sequence[str], label: str) -> list[DataFrame]:
    """All bands over nodes, each built from the roots of the one below."""
    out, below = [], 0
    for k, height in enumerate(heights):
        out.append(_blocks(nodes, below, height, extra if k == 0 else (), f"{label}-{k}"))
        below += height
        nodes = out[-1].select("tree", "leaves", F.col("block").alias("rank"), F.col("root").alias("digest"))
    return out


def build_manifest(rows: DataFrame, group: str, key: str, fields: Sequence[str], witness: dict[str, Column] | None = None) -> Manifest:
    """The manifest of all rows. ``witness`` replaces fields by what was received instead; its digest is kept beside the leaf."""
    leaf = leaf_digest([F.col(c) for c in fields])
    other = leaf_digest([(witness or {}).get(c, F.col(c)) for c in fields]) if witness else F.lit(None).cast("string")
    hashed = saved(rows.select(F.col(group).alias("group"), F.col(key).cast("long").alias("key"), leaf.alias("digest"), other.alias("witness"),
                               F.monotonically_increasing_id().alias("tie")), "leaf-digests")
    numbered = _numbered(hashed, ["group"], ["key", "digest", "tie"])
    before = Window.partitionBy("group").orderBy("run")
    runs = numbered.groupBy("group", "run").agg(F.count(F.lit(1)).alias("size"))
    runs = saved(runs.withColumn("offset", F.sum("size").over(before) - F.col("size")).withColumn("leaves", F.sum("size").over(Window.partitionBy("group"))), "runs")
    groups = runs.where("offset = 0").select("group", "leaves")  # one row each
    named = _numbered(groups, ["group"], [])
    order = Window.orderBy("part")
    parts = named.withColumn("part", F.shiftright("run", 32)).groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each range
    parts = parts.select("part", (F.sum("n").over(order) - F.col("n")).alias("tree"))
    named = saved(named.withColumn("part", F.shiftright("run", 32)).join(F.broadcast(parts), "part")
                  .select(F.col("group").alias("name"), "leaves", (F.col("tree") + F.col("run") % (1 << 32)).alias("tree")), "groups")
    most = named.agg(F.max("leaves"), F.count(F.lit(1))).first()
    if not most[1]:
        return Manifest(hashed.select("key", "digest"), [], [])
    placed = runs.join(named.drop("leaves"), F.col("group").eqNullSafe(F.col("name"))).select("run", "offset", "tree", "leaves")
    leaves = numbered.select("key", "digest", "witness", "run", "at").join(settle(placed), "run").select(
        "tree", "leaves", (F.col("offset") + F.col("at")).alias("rank"), "digest", "key", "witness")
    lower = _stack(leaves, bands(height_of(most[0])) or [0], ("key", "witness"), "band")
    roots = lower[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(most[1]).cast("long").alias("leaves"), F.col("tree").alias("rank"), F.col("root").alias("digest"))
    return Manifest(lower[0], lower, _stack(roots, bands(height_of(most[1])) or [0], (), "top"))


_PATH = "array<struct<before:string,after:string>>"


def _paths(blocks: DataFrame, above: DataFrame, label: str) -> DataFrame:
    """Paths ``(tree, block, path, subroot, top)`` of all leaves of a band, given those of its block roots."""
    met = blocks.select("tree", "block", "size", "height", "nodes").join(settle(above), ["tree", "block"]).select(
        "tree", "block", "size", "height", "nodes", "path", "subroot", "top")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, size, height, nodes, path, subroot, top in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first = block * ARITY**height
                own = [[{"before": b, "after": a} for b, a in siblings(nodes, height, size, k)] + path for k in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * size, pa.int64()), pa.array(range(first, first + size), pa.int64()),
                     pa.array(own, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))), pa.array([subroot] * size, pa.string()), pa.array([top] * size, pa.string())],
                    names=["tree", "block", "path", "subroot", "top"])

    return saved(met.mapInArrow(read, f"tree long, block long, path {_PATH}, subroot string, top string"), label)


def prove(manifest: Manifest) -> DataFrame:
    """For each row ``(key, leaf, subroot, root, proof, folded)``.

    ``proof`` is the digest of all siblings on the way to the root, level by level, left to right. ``folded`` is the root that the
    witness (or else the leaf) leads to with these siblings.
    """
    spark = manifest.leaves.sparkSession
    if not manifest.bands:
        return spark.createDataFrame([], "key long, leaf string, subroot string, root string, proof string, folded string")
    last = manifest.top[-1]
    paths = last.select("tree", "block", F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("root").alias("top"))
    for k in reversed(range(len(manifest.top))):
        paths = _paths(manifest.top[k], paths, f"top-paths-{k}")
    subroots = manifest.bands[-1].select("tree", F.col("root").alias("subroot"))
    paths = paths.select(F.col("block").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "top").join(subroots, "tree").select(
        "tree", "block", "path", "subroot", "top")
    for k in reversed(range(1, len(manifest.bands))):
        paths = _paths(manifest.bands[k], paths, f"paths-{k}")
    met = manifest.leaves.select("tree", "block", "size", "height", "nodes", "key", "witness").join(settle(paths), ["tree", "block"]).select(
        "size", "height", "nodes", "key", "witness", "path", "subroot", "top")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, height, nodes, keys, others, path, subroot, top in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                above = [(x["before"], x["after"]) for x in path]
                upper = "".join(b + a for b, a in above)
                own = [nodes[at * _BYTES:(at + 1) * _BYTES].hex() for at in addresses(height)[0][:size]]
                near = [siblings(nodes, height, size, k) for k in range(size)]
                proofs = [_digest(*[b + a for b, a in n], upper) for n in near]
                folded = [fold(o or leaf, [*n, *above]) for o, leaf, n in zip(others, own, near, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(own), pa.array([subroot] * size), pa.array([top] * size), pa.array(proofs), pa.array(folded)],
                    names=["key", "leaf", "subroot", "root", "proof", "folded"])

    return met.mapInArrow(read, "key long, leaf string, subroot string, root string, proof string, folded string")
