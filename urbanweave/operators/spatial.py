"""Spatial joins on a uniform grid, and the nearest of many stations by a tree over them.

Zones are cut into grid cells that carry the edges that pass through them and one bit for all others, so a point is
joined by cell and tested inside the join condition; nothing is regrouped afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.functions import geometry as G
from urbanweave.operators.reshape import name, quoted
from urbanweave.session import cut_lineage, settle

#: Mean Earth radius in kilometres.
EARTH_KM = 6371.0088
#: Edges up to which a shape is cut into cells where it is read.
SMALL = 64
#: Stations of a leaf, and most leaves: beyond, leaves have several parts of as many stations, so the list of their bounds (about 150 bytes each) is bounded.
LEAF, LEAVES = 32, 1 << 16
#: Children of a node of the tree over the leaves, most nodes at its top, nodes followed for a first bound, and most pairs of points and nodes looked at in one go.
FAN, TOP, BEAM, PAIRS = 8, 64, 4, 1 << 20
#: Cuts of each coordinate by the stations' quantiles, and stations of a leaf that bound the distance to it from above.
CUTS, MARKS = 256, 4


def _cell(value: str, size: float) -> str:
    return f"cast(floor({value} / {G.number(size)}) as bigint)"


def _low(items: str, axis: str) -> str:
    return f"array_min(transform({items}, e -> least(e.{axis}1, e.{axis}2)))"


def _high(items: str, axis: str) -> str:
    return f"array_max(transform({items}, e -> greatest(e.{axis}1, e.{axis}2)))"


def _span(items: str, axis: str, size: float) -> str:
    """One row for each cell of an axis that the edges reach into."""
    return f"explode(sequence({_cell(_low(items, axis), size)}, {_cell(_high(items, axis), size)}))"


def _edge_lists(shapes: DataFrame, columns: Sequence[str], parts: str) -> DataFrame:
    """``(__of, __all)``: the kept columns of each shape and all its edges."""
    kept = "".join(f", {name(c)}" for c in columns)
    return shapes.selectExpr(f"struct(0 as __{kept}) as __of", f"{G.edges(name(parts))} as __all").where("size(__all) > 0")


def _cells_in_place(lines: DataFrame, size: float) -> DataFrame:
    """One row per shape and cell in the bounds of its edges in that row of cells: ``(__of, cx, cy, __row, __lines)``.

    ``__row`` are the edges that reach into the row, ``__lines`` those whose bounds overlap the cell. For shapes of few edges.
    """
    width = G.number(size)
    rows = lines.where(f"size(__all) <= {SMALL}").selectExpr("__of", "__all", f"{_span('__all', 'y', size)} as cy").selectExpr(
        "__of", "cy", f"filter(__all, e -> greatest(e.y1, e.y2) >= cy * {width} and least(e.y1, e.y2) <= (cy + 1) * {width}) as __row")
    return rows.where("size(__row) > 0").selectExpr("__of", "cy", "__row", f"{_span('__row', 'x', size)} as cx").selectExpr(
        "__of", "cx", "cy", "__row", f"filter(__row, e -> greatest(e.x1, e.x2) >= cx * {width} and least(e.x1, e.x2) <= (cx + 1) * {width}) as __lines")


def _edge_cells(lines: DataFrame, size: float) -> DataFrame:
    """One row per edge of the shapes of many edges and cell it passes through: ``(__zone, __of, cx, cy, e, __meets)``.

    ``__meets`` is 1 in the cell where the edge meets the middle line of the row: the cell with the crossing right of its left side
    and not right of its right side. Cells are a hair wider than they are, so that rounding loses none.
    """
    width, line = G.number(size), f"((cy + 0.5D) * {G.number(size)})"
    numbered = lines.where(f"size(__all) > {SMALL}").withColumn("__zone", F.monotonically_increasing_id())  # before the edges become rows
    rows = numbered.selectExpr("__zone", "__of", "explode(__all) as e").selectExpr(
        "__zone", "__of", "e", f"explode(sequence({_cell('least(e.y1, e.y2)', size)}, {_cell('greatest(e.y1, e.y2)', size)})) as cy")
    low, high = "least(e.x1, e.x2)", "greatest(e.x1, e.x2)"
    ends = [f"greatest({low}, least({high}, {G.crossing_x('e', y)}))" for y in
            (f"greatest(least(e.y1, e.y2), cy * {width})", f"least(greatest(e.y1, e.y2), (cy + 1) * {width})")]
    met = rows.selectExpr(
        "*", f"cast(floor(if(e.y1 = e.y2, {low}, least({ends[0]}, {ends[1]})) / {width} - 1e-9D) as bigint) as __first",
        f"cast(floor(if(e.y1 = e.y2, {high}, greatest({ends[0]}, {ends[1]})) / {width} + 1e-9D) as bigint) as __last",
        f"case when (e.y1 > {line}) != (e.y2 > {line}) then {G.crossing_x('e', line)} end as __at")
    near = _cell("__at", size)
    placed = met.selectExpr("*", f"case when __at > ({near} + 1) * {width} then {near} + 1 when __at <= {near} * {width} then {near} - 1 else {near} end as __column")
    spread = "sequence(least(__first, coalesce(__column, __first)), greatest(__last, coalesce(__column, __last)))"
    return placed.selectExpr("__zone", "__of", "cy", "e", "__column", f"explode({spread}) as cx").selectExpr(
        "__zone", "__of", "cx", "cy", "e", "if(__column = cx, 1, 0) as __meets")


def ray_cells(zones: DataFrame, columns: Sequence[str], parts: str, size: float) -> DataFrame:
    """One row per zone and cell that may hold inner points, with what tells whether a point of the cell lies in the zone.

    ``__lines`` are the edges that pass through the cell. ``__beyond`` says whether an odd number of edges crosses the middle line of
    the row right of the cell: whether the right end of the cell's middle line is inside. From there a point is reached along
    two lines within the cell, so no other edges matter, and cells without edges are wholly inside.

    Zones of few edges are cut where they are read. Edges of larger ones become rows, by the cells they pass through, and meet again by zone and
    row of cells: there one running sum from the right gives all the cells of the row, and the inner cells between two with edges.
    So a zone of many edges is cut by as many tasks as it has rows of cells.
    """
    lines = _edge_lists(zones, columns, parts)
    kept = [f"__of.{name(c)} as {name(c)}" for c in columns]
    line, right = f"((cy + 0.5D) * {G.number(size)})", f"((cx + 1) * {G.number(size)})"
    beyond = f"size(filter(__row, e -> ((e.y1 > {line}) != (e.y2 > {line})) and {G.crossing_x('e', line)} > {right})) % 2 = 1"
    few = _cells_in_place(lines, size).selectExpr(*kept, "cx", "cy", "__lines", f"{beyond} as __beyond").where("__beyond or size(__lines) > 0")

    border = _edge_cells(lines, size).repartition("__zone", "cy").groupBy("__zone", "cy", "cx").agg(
        F.expr("first(__of) as __of"), F.expr("collect_list(e) as __lines"), F.expr("sum(__meets) as __meets"))
    leftward = "partition by __zone, cy order by cx desc"
    border = border.selectExpr("__of", "cy", "cx", "__lines", f"lag(cx) over ({leftward}) as __next",
                               f"coalesce(sum(__meets) over ({leftward} rows between unbounded preceding and 1 preceding), 0) % 2 = 1 as __beyond")
    gap = "transform(sequence(cx + 1, __next - 1), c -> struct(c as cx, slice(__lines, 1, 0) as __lines, true as __beyond))"
    every = f"if(__beyond and __next > cx + 1, concat(array(struct(cx, __lines, __beyond)), {gap}), array(struct(cx, __lines, __beyond)))"
    many = border.selectExpr("__of", "cy", f"inline({every})").selectExpr(*kept, "cx", "cy", "__lines", "__beyond")
    return few.unionByName(many)


def in_cell(x: str, y: str, size: float) -> str:
    """Does a point of the cell ``(__zx, __zy)`` lie in the zone?"""
    line, right = f"((__zy + 0.5D) * {G.number(size)})", f"((__zx + 1) * {G.number(size)})"
    return f"({G.odd_crossings('__lines', x, y, right, line)} != __beyond)"


def border_cells(shapes: DataFrame, columns: Sequence[str], parts: str, size: float) -> DataFrame:
    """One row per shape and cell with the edges that may pass through the cell; cells without any are left out."""
    lines = _edge_lists(shapes, columns, parts)
    kept = [f"__of.{name(c)} as {name(c)}" for c in columns]
    few = _cells_in_place(lines, size).where("size(__lines) > 0").selectExpr(*kept, "cx", "cy", "__lines")
    many = _edge_cells(lines, size).groupBy("__zone", "cy", "cx").agg(F.expr("first(__of) as __of"), F.expr("collect_list(e) as __lines")).selectExpr(
        *kept, "cx", "cy", "__lines")
    return few.unionByName(many)


def spatial_join_within(points: DataFrame, zones: DataFrame, x: str, y: str, parts: str, attributes: Sequence[str],
                        size: float, how: str = "left") -> DataFrame:
    """Attributes of every zone a point lies in; points outside all zones keep nulls (``how='left'``).

    ``size`` is the cell width: about the width of a small zone is a good choice. A point exactly on a
    border may fall on either side. The zone cells are written and measured before the join (``settle``).
    """
    keep = list(attributes) if how not in ("left_semi", "left_anti") else []
    cells = settle(ray_cells(zones, keep, parts, size).withColumnsRenamed({"cx": "__zx", "cy": "__zy"}))
    x, y = name(x), name(y)
    placed = points.selectExpr("*", f"{_cell(x, size)} as __px", f"{_cell(y, size)} as __py")
    condition = F.expr(f"__px = __zx and __py = __zy and {in_cell(x, y, size)}")
    return placed.join(cells, condition, how).drop("__px", "__py", "__zx", "__zy", "__lines", "__beyond")


def spatial_filter(features: DataFrame, zones: DataFrame, feature_id: str, parts: str, zone_parts: str,
                   size: float) -> DataFrame:
    """Features that intersect any zone.

    Two areas intersect if their borders meet, or else one lies inside the other: then a corner of the inner
    one lies in the outer one. The three tests are semi-joins on cells. The features are computed once and written with a
    row key, so rows with equal or null ids are judged each.
    """
    features, named = cut_lineage(features.withColumn("__row", F.monotonically_increasing_id())), features.columns
    zone = zones.selectExpr(f"{name(zone_parts)} as __zone_parts")
    mine = border_cells(features, ["__row"], parts, size).withColumnRenamed("__lines", "__mine")
    theirs = settle(border_cells(zone, [], "__zone_parts", size).withColumnsRenamed({"cx": "__zx", "cy": "__zy"}))
    meets = f"exists(__mine, p -> exists(__lines, q -> {G.segments_meet('p', 'q')}))"
    touching = mine.join(theirs, F.expr(f"cx = __zx and cy = __zy and {meets}"), "left_semi").select("__row")

    def corners(frame: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
        return frame.selectExpr(*keep, f"explode(flatten({name(column)})) as __ring").selectExpr(
            *keep, "get(element_at(__ring, 1), 0) as __x", "get(element_at(__ring, 1), 1) as __y")

    contained = spatial_join_within(
        corners(features, parts, ["__row"]), zone, "__x", "__y", "__zone_parts", [], size, "left_semi"
    ).select("__row")
    # Zones are the smaller side, so their corners are what is written and measured, not the features' cells.
    zone_corners = settle(corners(zone, "__zone_parts", []).selectExpr("__x", "__y", f"{_cell('__x', size)} as __px", f"{_cell('__y', size)} as __py"))
    few = _edge_lists(features, ["__row"], parts).where(f"size(__all) <= {SMALL}").selectExpr("__of.__row as __row", "__all", f"{_span('__all', 'y', size)} as __zy")
    few = few.selectExpr("*", f"{_span('__all', 'x', size)} as __zx")
    containing = few.join(zone_corners, F.expr(f"__zx = __px and __zy = __py and {G.inside('__all', '__x', '__y')}"), "left_semi").select("__row")
    large = features.where(f"size({G.edges(name(parts))}) > {SMALL}")
    many = ray_cells(large, ["__row"], parts, size).withColumnsRenamed({"cx": "__zx", "cy": "__zy"})
    around = many.join(zone_corners, F.expr(f"__zx = __px and __zy = __py and {in_cell('__x', '__y', size)}"), "left_semi").select("__row")
    ids = touching.union(contained).union(containing).union(around).distinct().withColumnRenamed("__row", "__id")
    return features.join(ids, F.expr("__row = __id"), "left_semi").select(*[quoted(c) for c in named])


def polygon_measures(df: DataFrame, parts: str) -> DataFrame:
    """``area`` and ``perimeter`` in the units of the coordinates."""
    return df.withColumns({"area": F.expr(G.area(name(parts))), "perimeter": F.expr(G.perimeter(name(parts)))})


def polygon_centroid(df: DataFrame, parts: str, x: str = "x", y: str = "y") -> DataFrame:
    """One row per part with its centroid and its number ``part``."""
    exploded = df.select("*", F.posexplode(parts).alias("part", "__rings"))
    moments = exploded.withColumn("__m", F.expr(G.part_moments("__rings")))
    return moments.withColumns({x: F.expr("try_divide(__m.mx, __m.area)"), y: F.expr("try_divide(__m.my, __m.area)")}).drop("__rings", "__m")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda a, b: F.sin(F.radians(b - a) / 2)
    chord = half(lat1, lat2) * half(lat1, lat2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2) * half(lon1, lon2)
    )
    return F.asin(F.least(F.sqrt(chord), F.lit(1.0))) * (2 * EARTH_KM)


def _position(a: Column, b: Column, metric: str) -> list[Column]:
    """Point in space whose straight distance ranks neighbours: the plane, or the unit sphere for lat/lon."""
    if metric == "plane":
        return [a.cast("double"), b.cast("double"), F.lit(0.0)]
    lat, lon = F.radians(a), F.radians(b)
    return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]


def nearest_station(points: DataFrame, stations: DataFrame, point_id: str, point_at: Sequence[str], station: str,
                    station_at: Sequence[str], metric: str = "sphere", leaf: int = LEAF) -> DataFrame:
    """``(point_id, station, distance)`` of the closest station of every point row; ties go to the lower name.

    ``metric='sphere'``: positions are latitude and longitude, distance in kilometres; ``'plane'``: any two
    coordinates. Rows with equal or null ids are each answered; a position that is null or no finite number has no answer.

    Stations are dealt into leaves of ``leaf`` neighbours each, cut where stations are, not by width, so one far away changes nothing. Every
    point looks at the bounds of groups of leaves and then of leaves, and keeps those that may be as near as a station it
    already knows of: a few, whatever the number of stations. Only these meet their stations, in a join by leaf.
    """
    def placed(df: DataFrame, at: Sequence[str]) -> Column:
        finite = [F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) for c in at]
        return finite[0] & finite[1]

    where = stations.where(placed(stations, station_at)).groupBy(
        *[F.col(c).cast("double").alias(f"__{i}") for i, c in enumerate(station_at)]
    ).agg(F.min(station).alias("__name"))
    spots = where.select("__name", *[c.alias(f"__s{i}") for i, c in enumerate(
        _position(F.col("__0"), F.col("__1"), metric))])
    at = points.where(placed(points, point_at)).select(
        F.col(point_id).alias("__point"), *[c.alias(f"__p{i}") for i, c in enumerate(
            _position(F.col(point_at[0]), F.col(point_at[1]), metric))])
    leaves = station_leaves(cut_lineage(spots), leaf)
    near = cut_lineage(_near_leaves(at, _Bounds.of(leaves)))
    gaps = [F.greatest(F.col(f"lo{k}") - F.col(f"__p{k}"), F.col(f"__p{k}") - F.col(f"hi{k}"), F.lit(0.0)) for k in range(3)]
    within = sum((g * g for g in gaps), F.lit(0.0)) <= F.col("__most")
    met = near.join(leaves.withColumnRenamed("leaf", "__leaf"), (F.col("leaf") == F.col("__leaf")) & within).select(
        "__row", "__point", "__p0", "__p1", "__p2", "stations")
    kinds = [f"{c} {near.schema[c].dataType.simpleString()}" for c in ("__row", "__point")]
    found = met.mapInArrow(_nearest_in_row, f"{', '.join(kinds)}, d2 double, name {spots.schema['__name'].dataType.simpleString()}").groupBy("__row").agg(
        F.first("__point").alias(point_id), F.min(F.struct("d2", "name")).alias("best"))
    chord = F.sqrt("best.d2")
    distance = chord if metric == "plane" else F.asin(F.least(chord / 2, F.lit(1.0))) * (2 * EARTH_KM)
    return found.select(point_id, F.col("best.name").alias(station), distance.alias("distance"))


def _nearest_in_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of the stations next to each point: ``(__row, __point, d2, name)``. Stations are sorted by name, so the first of equal ones is the lowest."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(5)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        begins = np.concatenate([[0], ends[:-1]])
        stations, of = lists.flatten(), np.repeat(np.arange(batch.num_rows), ends - begins)
        d2 = np.zeros(len(stations))
        for k in range(3):
            step = batch.column(2 + k).to_numpy(zero_copy_only=False)[of] - stations.field(1 + k).to_numpy(zero_copy_only=False)
            d2 += step * step
        least = np.minimum.reduceat(d2, begins)
        hits = np.flatnonzero(d2 == least[of])
        best = hits[np.unique(of[hits], return_index=True)[1]]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least), stations.field(0).take(pa.array(best))], names=["__row", "__point", "d2", "name"])


def station_leaves(spots: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Parts of leaves ``(leaf, part, lo0.., hi0.., stations)`` over written positions ``(__name, __s0, __s1, __s2)``, written and measured for a join.

    Positions are ordered along a curve through cells between the quantiles of each coordinate and cut every ``leaf`` of them. Beyond
    :data:`LEAVES` of these parts, several consecutive ones are a leaf.
    """
    steps = [k / CUTS for k in range(1, CUTS)]
    made = spots.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f"__s{k}", steps, 100 * CUTS).alias(f"q{k}") for k in range(3)]).first()
    if not made["n"]:
        raise ValueError("no stations with a position")
    cuts = [np.array(made[f"q{k}"]) for k in range(3)]
    parts = max(1, -(-made["n"] // (leaf * LEAVES)))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.zeros(batch.num_rows, np.int64)
            for k in range(3):
                place = np.searchsorted(cuts[k], batch.column(1 + k).to_numpy(zero_copy_only=False))
                for bit in range(CUTS.bit_length() - 1):
                    code |= ((place >> bit) & 1) << (3 * bit + k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            part = (done + np.arange(batch.num_rows)) // leaf
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(first + part // parts), pa.array(part % parts)], names=[*batch.schema.names[:4], "leaf", "part"])
            done += batch.num_rows

    order, plain = ["code", "__s0", "__s1", "__s2"], f"__name {spots.schema['__name'].dataType.simpleString()}, __s0 double, __s1 double, __s2 double"
    ranged = spots.select("__name", "__s0", "__s1", "__s2").mapInArrow(coded, f"{plain}, code long").repartitionByRange(*order).sortWithinPartitions(*order)
    station = F.struct(F.col("__name").alias("name"), *[F.col(f"__s{k}").alias(f"s{k}") for k in range(3)])
    return settle(ranged.mapInArrow(numbered, f"{plain}, leaf long, part long").groupBy("leaf", "part").agg(
        *[f(f"__s{k}").alias(f"{name}{k}") for name, f in (("lo", F.min), ("hi", F.max)) for k in range(3)], F.sort_array(F.collect_list(station)).alias("stations")))


class _Bounds:
    """Bounds of all leaves, some positions of each, and a tree over them: nodes of :data:`FAN` consecutive ones. A list of bounded length."""

    def __init__(self, leaf: np.ndarray, lo: np.ndarray, hi: np.ndarray, marks: np.ndarray):
        order = self._halved((lo + hi) / 2)
        self.leaf, self.marks, lo, hi, self.levels = leaf[order], marks[order], lo[order], hi[order], []
        while True:  # from the leaves up, each level filled to whole nodes by empty boxes
            fill = -len(lo) % FAN
            lo, hi = (np.concatenate([a, np.full((fill, 3), side)]) for a, side in ((lo, np.inf), (hi, -np.inf)))
            self.levels.append((lo, hi))
            if len(lo) <= TOP:
                break
            lo, hi = lo.reshape(-1, FAN, 3).min(axis=1), hi.reshape(-1, FAN, 3).max(axis=1)

    @staticmethod
    def _halved(centre: np.ndarray) -> np.ndarray:
        """An order in which each aligned stretch of FAN, FAN^2, .. leaves is a part of space: stretches are halved along their widest axis."""
        todo, done = [np.arange(len(centre))], []
        while todo:
            own = todo.pop()
            if len(own) <= 1:
                done.append(own)
                continue
            axis = np.argmax(np.ptp(centre[own], axis=0))
            size = 1 << (len(own) - 1).bit_length() - 1  # the largest power of two below
            near = np.argpartition(centre[own, axis], size - 1)
            todo += [own[near[size:]], own[near[:size]]]
        return np.concatenate(done)

    @classmethod
    def of(cls, leaves: DataFrame) -> _Bounds:
        size, half = F.size("stations"), MARKS // 2
        marks = F.array(*[F.element_at("stations", (F.floor((size - 1) * k / (MARKS - 1)) + 1).cast("int")) for k in range(MARKS)])
        rows = leaves.groupBy("leaf").agg(*[f(f"{name}{k}").alias(f"{name}{k}") for name, f in (("lo", F.min), ("hi", F.max)) for k in range(3)],
                                          F.min_by(marks, "part").alias("__first"), F.max_by(marks, "part").alias("__last"))
        picked = [F.get("__first" if i < half else "__last", F.lit(i)) for i in range(MARKS)]
        rows = rows.select("leaf", *[f"{name}{k}" for name in ("lo", "hi") for k in range(3)], *[m[f"s{k}"].alias(f"m{i}{k}") for i, m in enumerate(picked) for k in range(3)])
        table = rows.toArrow().sort_by("leaf")
        values = np.column_stack([c.to_numpy() for c in table.columns[1:]])
        return cls(table.column("leaf").to_numpy(), values[:, :3], values[:, 3:6], values[:, 6:].reshape(len(values), MARKS, 3))

    @staticmethod
    def _least(at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Squared distance from positions to boxes."""
        total = 0.0
        for k in range(3):
            gap = np.maximum(np.maximum(lo[..., k] - at[..., k], at[..., k] - hi[..., k]), 0)
            total = total + gap * gap
        return total

    def _known(self, at: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Squared distance to the nearest mark of a leaf."""
        marks = self.marks[leaf]
        return sum((at[:, None, k] - marks[:, :, k]) ** 2 for k in range(3)).min(axis=1)

    def _descent(self, at: np.ndarray) -> np.ndarray:
        """Squared distance to a station that is near, though not always the nearest: each step keeps the few nodes whose boxes and centres are nearest."""
        node = None
        for lo, hi in reversed(self.levels):
            offered = np.broadcast_to(np.arange(len(lo)), (len(at), len(lo))) if node is None else (node[:, :, None] * FAN + np.arange(FAN)).reshape(len(at), -1)
            low, high = lo[offered], hi[offered]
            with np.errstate(invalid="ignore"):
                centre = sum((at[:, None, k] - (low[..., k] + high[..., k]) / 2) ** 2 for k in range(3))
            score = np.where(low[..., 0] <= high[..., 0], self._least(at[:, None], low, high) * 64 + centre, np.inf)
            node = np.take_along_axis(offered, np.argpartition(score, BEAM - 1, axis=1)[:, :BEAM], axis=1)
        node = np.minimum(node, len(self.leaf) - 1)
        return np.min([self._known(at, node[:, k]) for k in range(BEAM)], axis=0)

    def near(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of positions and leaves that may hold the nearest station: row, leaf's number here, and the squared distance that bounds it."""
        most = self._descent(at) * (1 + 1e-9)
        row, node = (a.ravel() for a in np.indices((len(at), len(self.levels[-1][0]))))
        for depth, (lo, hi) in enumerate(reversed(self.levels)):
            if depth:
                row, node = np.repeat(row, FAN), (node[:, None] * FAN + np.arange(FAN)).ravel()
            if len(row) > PAIRS and len(at) > 1:  # far from everything, many are equally near
                half = len(at) // 2
                (r1, l1, m1), (r2, l2, m2) = self.near(at[:half]), self.near(at[half:])
                return np.concatenate([r1, r2 + half]), np.concatenate([l1, l2]), np.concatenate([m1, m2])
            keep = self._least(at[row], lo[node], hi[node]) <= most[row]
            row, node = row[keep], node[keep]
        real = node < len(self.leaf)  # where distances overflow, the empty boxes are as near
        row, node = row[real], node[real]
        known = self._known(at[row], node) * (1 + 1e-9)
        most = np.minimum(most, np.minimum.reduceat(known, np.searchsorted(row, np.arange(len(at)))))
        keep = self._least(at[row], self.levels[0][0][node], self.levels[0][1][node]) <= most[row]
        return row[keep], node[keep], most[row[keep]]


def _near_leaves(at: DataFrame, bounds: _Bounds) -> DataFrame:
    """``(__row, __point, __p0, __p1, __p2, leaf, __most)``: the leaves each point has to look into, and the squared distance that bounds its answer."""
    spark = at.sparkSession
    shared = spark.sparkContext.broadcast(bounds)
    step = 1 << 12

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = TaskContext.get().partitionId() << 36
        for batch in batches:
            place = np.column_stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(3)])
            for lo in range(0, len(place), step):
                row, leaf, most = shared.value.near(place[lo:lo + step])
                picked = batch.slice(lo, step).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(done + lo + row), *picked.columns, pa.array(shared.value.leaf[leaf]), pa.array(most)],
                                                 names=["__row", *batch.schema.names, "leaf", "__most"])
            done += len(place)

    kind = at.schema["__point"].dataType.simpleString()
    # A file of few bytes can hold very many points: they are dealt to as many tasks as a shuffle has.
    dealt = at.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(look, f"__row long, __point {kind}, __p0 double, __p1 double, __p2 double, leaf long, __most double")
