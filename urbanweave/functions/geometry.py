"""Planar geometry as SQL text.

A polygon column is ``parts``: parts -> rings -> points -> coordinates (``array`` four levels deep), the
shape of a GeoJSON MultiPolygon. The first ring of a part is its border, later rings are holes.

Functions take SQL text (a column's name, a lambda's variable) and give SQL text, for ``F.expr``: expressions of this size are
parsed at once where the query is planned, which is far quicker than to build them node by node.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGON = "array<array<array<double>>>"
MULTI_POLYGON = "array<array<array<array<double>>>>"


def parse_parts(kind: Column, coordinates: Column) -> Column:
    """``parts`` of GeoJSON coordinate text; other geometry types give null."""
    return (
        F.when(kind == "Polygon", F.array(F.from_json(coordinates, POLYGON)))
        .when(kind == "MultiPolygon", F.from_json(coordinates, MULTI_POLYGON))
    )


def parse_point(kind: Column, coordinates: Column) -> Column:
    return F.when(kind == "Point", F.from_json(coordinates, "array<double>"))


def number(value: float) -> str:
    """A double."""
    return f"{float(value)!r}D"


def ring_edges(ring: str) -> str:
    """Edges of a ring as structs; an open ring is closed."""
    closed = f"if(element_at({ring}, 1) = element_at({ring}, -1), {ring}, concat({ring}, slice({ring}, 1, 1)))"
    return (f"zip_with(slice({closed}, 1, size({closed}) - 1), slice({closed}, 2, size({closed}) - 1), "
            "(a, b) -> named_struct('x1', get(a, 0), 'y1', get(a, 1), 'x2', get(b, 0), 'y2', get(b, 1)))")


def edges(parts: str) -> str:
    return f"flatten(transform(flatten({parts}), ring -> {ring_edges('ring')}))"


_MOMENTS = ("area", "mx", "my")
_ZERO = "named_struct('area', 0.0D, 'mx', 0.0D, 'my', 0.0D)"


def ring_moments(ring: str, sign: str) -> str:
    """Area and first moments of a ring times ``sign``, in one pass and taken about its first point to keep digits."""
    x0, y0 = (f"get(element_at({ring}, 1), {k})" for k in (0, 1))
    cross = f"((e.x1 - {x0}) * (e.y2 - {y0}) - (e.x2 - {x0}) * (e.y1 - {y0}))"
    step = (f"(t, e) -> named_struct('area', t.area + {cross} / 2, 'mx', t.mx + (e.x1 + e.x2 - {x0} * 2) * {cross} / 6, "
            f"'my', t.my + (e.y1 + e.y2 - {y0} * 2) * {cross} / 6)")
    turn = f"if(t.area < 0, -({sign}), {sign})"
    finish = f"t -> named_struct('area', {turn} * t.area, 'mx', {turn} * (t.mx + {x0} * t.area), 'my', {turn} * (t.my + {y0} * t.area))"
    return f"aggregate({ring_edges(ring)}, {_ZERO}, {step}, {finish})"


def part_moments(rings: str) -> str:
    """``(area, mx, my)`` of one part: the border's less those of the holes."""
    signed = f"transform({rings}, (loop, i) -> {ring_moments('loop', 'if(i = 0, 1.0D, -1.0D)')})"
    added = ", ".join(f"'{name}', total.{name} + item.{name}" for name in _MOMENTS)
    return f"aggregate({signed}, {_ZERO}, (total, item) -> named_struct({added}))"


def area(parts: str) -> str:
    return f"aggregate({parts}, 0.0D, (whole, rings) -> whole + {part_moments('rings')}.area)"


def perimeter(parts: str) -> str:
    """Length of all rings, holes included."""
    return f"aggregate({edges(parts)}, 0.0D, (whole, e) -> whole + sqrt((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1)))"


def crossing_x(edge: str, y: str) -> str:
    """Where the line of an edge has the height ``y``; null for a level one."""
    return f"({edge}.x1 + try_divide(({edge}.x2 - {edge}.x1) * ({y} - {edge}.y1), {edge}.y2 - {edge}.y1))"


def _odd(lines: str, step: str, **given: str) -> str:
    """Is the sum of ``step`` over the edges ``e`` odd? Steps see the given values as fields of ``t``, never as columns.

    Spark numbers lambda variables from 0 where it compares conditions, and columns by their age. A young session's columns have the same numbers:
    with one of them in a lambda a join condition was taken for a filter of one side, and the query failed.
    """
    fields = "".join(f", '{name}', {value}" for name, value in given.items())
    kept = "".join(f", '{name}', t.{name}" for name in given)
    return f"(aggregate({lines}, named_struct('n', 0{fields}), (t, e) -> named_struct('n', t.n + {step}{kept}), t -> t.n) % 2 = 1)"


def inside(lines: str, x: str, y: str) -> str:
    """Even-odd rule over all edges, so holes and several parts need no special case."""
    return _odd(lines, f"if(((e.y1 > t.y) != (e.y2 > t.y)) and t.x < {crossing_x('e', 't.y')}, 1, 0)", x=x, y=y)


def odd_crossings(lines: str, x: str, y: str, right: str, line: str) -> str:
    """Is the number of edges odd that are crossed on the way from ``(x, y)`` up or down to height ``line`` and along it to ``right``?"""
    y_at, x_at = "(e.y1 + try_divide((e.y2 - e.y1) * (t.x - e.x1), e.x2 - e.x1))", crossing_x("e", "t.line")
    along_x = f"if(((e.x1 > t.x) != (e.x2 > t.x)) and (({y_at} > t.y) != ({y_at} > t.line)), 1, 0)"
    along_y = f"if(((e.y1 > t.line) != (e.y2 > t.line)) and (({x_at} > t.x) != ({x_at} > t.right)), 1, 0)"
    return _odd(lines, f"{along_x} + {along_y}", x=x, y=y, right=right, line=line)


def segments_meet(a: str, b: str) -> str:
    """Do two edges cross or touch?"""
    def side(e: str, x: str, y: str) -> str:
        return f"signum(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"

    def overlap(p: str, q: str) -> str:
        return f"least({a}.{p}, {a}.{q}) <= greatest({b}.{p}, {b}.{q}) and least({b}.{p}, {b}.{q}) <= greatest({a}.{p}, {a}.{q})"

    return (f"({overlap('x1', 'x2')} and {overlap('y1', 'y2')}"
            f" and {side(a, f'{b}.x1', f'{b}.y1')} * {side(a, f'{b}.x2', f'{b}.y2')} <= 0"
            f" and {side(b, f'{a}.x1', f'{a}.y1')} * {side(b, f'{a}.x2', f'{a}.y2')} <= 0)")
