"""Exact top-k inner products by dual-tree search: cover trees over the vectors and over groups of queries, searched together.

A node of a cover tree has a vector of its set as centre and a covering radius; its children's centres lie within the radius and
apart from each other by the next smaller one. For a query node and a data node, ``<q, d> + R(q)|d| + R(d)|q| + R(q)R(d)`` bounds every
score between them; a pair whose bound is below the worst k-th score of the query node's queries is pruned.

The top level of the tree is spread over the cluster:

1. At most :data:`PIVOTS` pivots are chosen, far from each other, among a sample of :data:`SAMPLE` vectors (the smallest hashes of id),
   shared out over the widths there are; a width without a sample has the zero vector. *Every* vector goes to its nearest
   pivot's cell; the exact covering radius of a cell is an aggregate. A cell of more than
   :data:`PART` vectors is cut by a hash of the id, so one common vector or cluster is no single task. The width is part of a
   cell's number: vectors of all widths are searched in one plan.
2. Queries search their own cell first, which gives each a k-th score. Then they visit only cells whose bound reaches it.
3. In a task, one part's vectors become a cover tree and the queries pass by in batches, each batch a tree of its own.

Only pivots and cell radii (bounded by the widths) reach the driver. Scores are integer and exact; they are defined for components of less
than 2^53 after scaling and as long as width times the largest product of two components is below 2^63: beyond, the query fails.

Defined cases: components are ``floor(scale * x)``; a vector that is null or has null or non-finite components takes no part, nor does a
row without id; vectors meet only those of equal length; a row isn't its own candidate, nor are other rows with its id; of
repeated query ids the smallest vector asks; ties go to the smaller id; fewer candidates give fewer rows; an empty table gives
an empty table; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.llm.kernels import lists
from urbanweave.llm.shared import saved

PIVOTS = 128
SAMPLE = 4096
PART = 8192
LEAF = 48
#: Queries in one query tree.
GROUP = 1024
#: Ratio of a node's radius to that between its children.
BASE = 1.4
#: Bounds on a product sum: doubles are exact below the first, longs below the second.
EXACT, LONGS = float(1 << 53), float(1 << 63)
#: What a double may be off, where scores of longs are compared as doubles.
HAIR = 1e-15
#: Cells of a width have numbers from this times the width.
WIDE = 1 << 20


class Node:
    __slots__ = ("rows", "center", "norm", "radius", "children")

    def __init__(self, rows: np.ndarray, center: np.ndarray, radius: float):
        self.rows, self.center, self.radius, self.children = rows, center, radius, ()
        self.norm = float(np.sqrt((center * center).sum()))


def cover_tree(points: np.ndarray) -> Node:
    """The root; a node whose points would nearly all become children of their own stays a leaf."""
    def node(rows: np.ndarray, center: int) -> Node:
        distance = np.sqrt(((points[rows] - points[center]) ** 2).sum(axis=1))
        made = Node(rows, points[center], float(distance.max()) * (1 + 1e-9))
        if len(rows) > LEAF and made.radius > 0:
            todo.append((made, distance))
        return made

    todo: list[tuple[Node, np.ndarray]] = []
    root = node(np.arange(len(points)), 0)
    while todo:
        made, nearest = todo.pop()
        reach, rows = made.radius / BASE, made.rows
        owner, centers = np.zeros(len(rows), np.int64), [int(rows[int(np.argmin(nearest))])]
        while nearest.max() > reach and len(centers) <= len(rows) // 4:
            far = int(np.argmax(nearest))  # apart from all centres so far by more than the reach
            distance = np.sqrt(((points[rows] - points[rows[far]]) ** 2).sum(axis=1))
            closer = distance < nearest
            owner[closer] = len(centers)
            nearest = np.minimum(nearest, distance)
            centers.append(int(rows[far]))
        if nearest.max() <= reach:
            made.children = tuple(node(rows[owner == k], center) for k, center in enumerate(centers))
    return root


class Best:
    """The k best candidates of each query of a group: score descending, id ascending."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.found: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.least = least.copy()  # no score below this is among the best

    def offer(self, row: int, scores: np.ndarray, ids: np.ndarray) -> None:
        own = self.found[row]
        own += [(-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != self.ids[row]]
        own.sort()
        del own[self.k:]
        if len(own) == self.k:
            worst = float(-own[-1][0])
            self.least[row] = max(self.least[row], worst if abs(worst) < EXACT else worst - HAIR * abs(worst))


def dual_search(queries: Node, points: np.ndarray, root: Node, asked: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Visit pairs of nodes that may hold a score among the best, most promising first at each step."""
    def bound(q: Node, d: Node) -> float:
        value = float(q.center @ d.center) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        return value + 1e-9 * (abs(value) + q.norm * d.norm) + 1e-6

    stack = [(bound(queries, root), queries, root)]
    while stack:
        most, q, d = stack.pop()
        if most < best.least[q.rows].min():
            continue
        if not q.children and not d.children:
            scores = asked[q.rows] @ points[d.rows].T
            hit = scores * (1 + HAIR * np.sign(scores)) >= best.least[q.rows][:, None] if scores.dtype == np.int64 else scores >= best.least[q.rows][:, None]
            for k in np.flatnonzero(hit.any(axis=1)).tolist():
                best.offer(int(q.rows[k]), scores[k, hit[k]], ids[d.rows[hit[k]]])
        elif d.children and (not q.children or d.radius >= q.radius):
            stack += sorted(((bound(q, child), q, child) for child in d.children), key=lambda x: x[0])
        else:
            stack += sorted(((bound(child, d), child, d) for child in q.children), key=lambda x: x[0])


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy().astype(float)
    return values.reshape(len(column), -1)


def _search_parts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of parts in order, vectors before queries; the best of each query in each part."""
    key, ids, points, asked, root = None, [], [], [], None

    def answer() -> pa.RecordBatch:
        nonlocal root, asked, ids, points
        rows: list[tuple[int, int, int]] = []
        if asked and points:
            if root is None:
                points, ids = [np.concatenate(points)], [np.concatenate(ids)]
                exact = float(np.abs(points[0]).max(initial=0))
                root = cover_tree(points[0]), exact
            queries, least, own = (np.concatenate(x) for x in zip(*asked, strict=True))
            largest = root[1] * float(np.abs(own).max(initial=0)) * own.shape[1]
            for lo in range(0, len(queries), GROUP):
                best = Best(queries[lo:lo + GROUP], least[lo:lo + GROUP], k)
                group = own[lo:lo + GROUP]
                if largest >= LONGS:
                    raise ValueError(f"products of these vectors may reach {largest:.3g}, beyond the whole numbers of a long")
                if largest < EXACT:
                    dual_search(cover_tree(group), points[0], root[0], group, ids[0], best)
                else:
                    dual_search(cover_tree(group), points[0].astype(np.int64), root[0], group.astype(np.int64), ids[0], best)
                rows += [(int(q), i, -int(s)) for q, own_best in zip(best.ids, best.found, strict=True) for s, i in own_best]
        asked = []
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cells, parts, asks = (batch.column(c).to_numpy() for c in (0, 1, 2))
        vec, least = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        edge = np.flatnonzero((np.diff(cells) != 0) | (np.diff(parts) != 0) | (np.diff(asks) != 0)) + 1
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(cells)], strict=True):
            if (cells[lo], parts[lo]) != key:
                yield answer()
                key, ids, points, root = (cells[lo], parts[lo]), [], [], None
            values = _matrix(batch.column(5).slice(lo, hi - lo))
            if asks[lo]:
                asked.append((vec[lo:hi], least[lo:hi], values))
                if sum(len(a[0]) for a in asked) >= GROUP:
                    yield answer()
            else:
                ids.append(vec[lo:hi])
                points.append(values)
    yield answer()


def far_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots that are far from each other: each is the point farthest from those before it."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the ``k`` highest inner products over all other rows."""
    spark = vectors.sparkSession

    def numbers(df: DataFrame) -> DataFrame:
        x = F.col(embedding)
        sound = F.col(vec).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
            x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))

        def whole(c):
            scaled = F.floor(c.cast("double") * scale)
            return F.when(F.abs(c.cast("double") * scale) < EXACT, scaled.cast("double")).otherwise(F.raise_error(F.lit("a component of 2^53 or more")).cast("double"))

        return df.where(sound).select(F.col(vec).cast("long").alias("vec_id"), F.transform(x, whole).alias("v"))

    rows = saved(numbers(vectors), "vectors")
    asking = numbers(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    width = F.size("v")
    widths = rows.select(width.alias("w")).distinct().count()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    hashed = Window.partitionBy("w").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = rows.withColumn("w", width).withColumn("r", F.row_number().over(hashed)).where(F.col("r") <= max(1, SAMPLE // widths)).orderBy("w", "r").limit(SAMPLE)
    picked: dict[int, list] = {}
    for r in sample.select("w", "v").collect():
        picked.setdefault(r[0], []).append(r[1])
    pivots = {w: far_pivots(np.array(own, float), PIVOTS) for w, own in picked.items()}

    def by_width(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Width, rows of this width, their vectors, and the pivots."""
        sizes = column.value_lengths().to_numpy()
        for w in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == w)
            yield w, at, _matrix(column.take(pa.array(at))), pivots.get(w, np.zeros((1, w)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, distances = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for w, at, x, own in by_width(batch.column(1)):
                squared = (x * x).sum(axis=1)[:, None] - 2 * (x @ own.T) + (own ** 2).sum(axis=1)
                cell = np.argmin(squared, axis=1)
                cells[at], distances[at] = w * WIDE + cell, np.sqrt(((x - own[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells), pa.array(distances)], names=["vec_id", "v", "cell", "distance"])

    celled = saved(rows.mapInArrow(assign, "vec_id long, v array<double>, cell long, distance double"), "cells")
    sizes = {r[0]: (r[1], r[2]) for r in celled.groupBy("cell").agg(F.count(F.lit(1)), F.max("distance")).collect()}  # PIVOTS rows a width at most
    parts = {cell: -(-count // PART) for cell, (count, _) in sizes.items()}
    radii: dict[int, np.ndarray] = {}
    for cell, (_, reach) in sizes.items():
        w, at = divmod(cell, WIDE)
        radii.setdefault(w, np.full(len(pivots.get(w, [0])), -1.0))[at] = reach * (1 + 1e-9)
    part_of = spark.createDataFrame(sorted(parts.items()), "of long, parts int")
    data = celled.join(F.broadcast(part_of), F.col("cell") == F.col("of")).select(
        "cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("asks"), "vec_id", F.lit(0.0).alias("least"), "v")

    def searched(asked: DataFrame) -> DataFrame:
        sent = asked.join(F.broadcast(part_of), F.col("cell") == F.col("of")).select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("asks"), "vec_id", "least", "v")
        dealt = data.union(sent).repartition("cell", "part").sortWithinPartitions("cell", "part", "asks", "vec_id")
        return dealt.mapInArrow(lambda batches: _search_parts(batches, k), "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    own = asking.mapInArrow(assign, "vec_id long, v array<double>, cell long, distance double").select("vec_id", "v", "cell", F.lit(float("-inf")).alias("least"))
    first = saved(searched(own).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "own-cells")
    kth = F.col("score").cast("double")
    least = first.where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.when(F.abs(kth) < EXACT, kth).otherwise(kth - F.abs(kth) * HAIR).alias("kth"))
    bounded = own.join(least, F.col("vec_id") == F.col("of"), "left").select("vec_id", "v", "cell", F.coalesce("kth", "least").alias("least"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, at, x, pivot in by_width(batch.column(1)):
                radius = radii.get(w, np.full(len(pivot), -1.0))
                home, kth = batch.column(2).to_numpy()[at] - w * WIDE, batch.column(3).to_numpy()[at]
                most = x @ pivot.T + np.sqrt((x * x).sum(axis=1))[:, None] * radius
                most += 1e-9 * np.abs(most) + 1e-6
                row, cell = np.nonzero((most >= kth[:, None]) & (radius >= 0) & (np.arange(len(pivot)) != home[:, None]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[row])), lists(x[row].ravel(), np.full(len(row), w)), pa.array(w * WIDE + cell),
                                                  pa.array(kth[row])], names=["vec_id", "v", "cell", "least"])

    rest = searched(bounded.mapInArrow(visit, "vec_id long, v array<double>, cell long, least double"))
    both = first.select("query_id", "vec_id", "score").union(rest)
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
