"""Projection, filters and reshaping of wide tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of the vegetation zones. All are strict, so a bin on a bound belongs to no zone.
ZONES = {
    "darker": (None, 0.0),
    "dark": (0.0, 0.2),
    "medium": (0.2, 0.4),
    "light": (0.4, 0.6),
    "lighter": (0.6, None),
}


def name(column: str) -> str:
    """A column's name in SQL, which may hold dots or blanks."""
    return f"`{column.replace('`', '``')}`"


def quoted(column: str) -> Column:
    """Column of a name that may hold dots or blanks."""
    return F.col(name(column))


def cast_columns(df: DataFrame, names: Iterable[str], to: str = "double", strict: bool = True) -> DataFrame:
    """Cast text columns; strict casts fail on bad text (ANSI), lenient ones give null."""
    return df.withColumns(
        {name: quoted(name).cast(to) if strict else quoted(name).try_cast(to) for name in names}
    )


def keep_prefixed(df: DataFrame, prefixes: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Keep the columns that start with a prefix, and the named ones."""
    return df.select(*[quoted(c) for c in df.columns if c in also or c.startswith(tuple(prefixes))])


def drop_prefixed(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not c.startswith(tuple(prefixes))])


def rename_months(df: DataFrame, year: int, prefix: str = "CONSUMO_M") -> DataFrame:
    """``<prefix>1..12`` become the first day of each month of ``year``."""
    return df.withColumnsRenamed({f"{prefix}{month}": f"{year:04d}-{month:02d}-01" for month in range(1, 13)})


def unpivot_periods(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "period",
                    value: str = "value") -> DataFrame:
    """One row per listed period column. Rows are expanded in place, without a shuffle."""
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in values], name, value)


def unpivot_rest(df: DataFrame, ids: Sequence[str], name: str = "date", value: str = "value",
                 to: str = "double") -> DataFrame:
    """One row per column that is no id. All of them are cast to one type first."""
    rest = [c for c in df.columns if c not in ids]
    return unpivot_periods(cast_columns(df, rest, to), ids, rest, name, value)


def not_equal_keep_null(df: DataFrame, column: str, value) -> DataFrame:
    """Drop rows that hold ``value`` (taken as the column's type); rows with null stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value).cast(df.schema[column].dataType)))


def columns_agree(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.where(F.col(left) == F.col(right))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in columns]))


def filter_located(df: DataFrame, lat: str, lon: str, missing: str = "NULL") -> DataFrame:
    """Keep rows with at least one known coordinate (text ``NULL`` stands for unknown)."""
    return df.where((F.col(lat) != missing) | (F.col(lon) != missing))


def constant_columns(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as one column per leaf, named by its path."""
    def leaves(schema: T.StructType, column: Column | None, path: str) -> list[Column]:
        out = []
        for field in schema.fields:
            item = quoted(field.name) if column is None else column.getField(field.name)
            name = f"{path}{sep}{field.name}" if path else field.name
            if isinstance(field.dataType, T.StructType):
                out.extend(leaves(field.dataType, item, name))
            else:
                out.append(item.alias(name))
        return out

    return df.select(*leaves(df.schema, None, ""))


def nest_dotted(df: DataFrame, sep: str = ".") -> DataFrame:
    """The inverse of :func:`flatten_struct`: dotted names become a tree of structs."""
    tree: dict = {}
    for name in df.columns:
        *path, leaf = name.split(sep)
        node = tree
        for step in path:
            node = node.setdefault(step, {})
        node[leaf] = quoted(name)

    def build(node: dict) -> list[Column]:
        return [
            (F.struct(*build(item)) if isinstance(item, dict) else item).alias(name)
            for name, item in node.items()
        ]

    return df.select(*build(tree))


def zone_of(bin_centre: Column, closed: str = "none") -> Column:
    """Name of the zone of a bin; ``closed='left'`` gives the bins on a bound to the zone above."""
    zone = F.lit(None).cast("string")
    for name, (low, high) in ZONES.items():
        test = F.lit(True)
        if low is not None:
            test = test & ((bin_centre >= low) if closed == "left" else (bin_centre > low))
        if high is not None:
            test = test & (bin_centre < high)
        zone = F.when(test, name).otherwise(zone)
    return zone


def zones_from_columns(df: DataFrame, prefix: str = "HISTO_", closed: str = "none") -> DataFrame:
    """Sum the histogram columns of each zone inside the row: no shuffle. Nulls count as 0."""
    members: dict[str, list[str]] = {name: [] for name in ZONES}
    for name in df.columns:
        if not name.startswith(prefix):
            continue
        centre = float(name.split("_")[1])
        for zone, (low, high) in ZONES.items():
            above = low is None or centre > low or (closed == "left" and centre == low)
            if above and (high is None or centre < high):
                members[zone].append(name)
    sums = {
        zone: reduce(lambda a, b: a + b, [F.coalesce(quoted(c).cast("double"), F.lit(0.0)) for c in names],
                     F.lit(0.0))
        for zone, names in members.items()
    }
    return drop_prefixed(df.withColumns(sums), [prefix])


def histogram_zones(df: DataFrame, keys: Sequence[str], bin_col: str, value: str, closed: str = "none") -> DataFrame:
    """Zone sums of a long histogram (one row per bin), combined map-side before the shuffle."""
    zone = zone_of(F.col(bin_col), closed)
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(zone == name, F.col(value))), F.lit(0.0)).alias(name) for name in ZONES]
    )


def row_percentages(df: DataFrame, columns: Sequence[str] = tuple(ZONES)) -> DataFrame:
    """Whole-number share of each column in the row's sum, times 100; a zero sum gives null."""
    whole = {c: F.col(c).cast("long") for c in columns}
    total = reduce(lambda a, b: a + b, whole.values())
    return df.withColumns({c: F.try_divide(whole[c], total) * 100 for c in columns})


def pack_vector(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Columns as one array of doubles."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in columns]))
