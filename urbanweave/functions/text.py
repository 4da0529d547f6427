"""Column expressions on identifiers and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier marks used by the cadastre services.
BUILDING_MARK = "BU."
ADDRESS_MARK = "ES.SDGC.AD."
STREET_MARK = "ES.SDGC.TN."


def zero_pad(value: Column, width: int) -> Column:
    """Pad with leading zeros to ``width``; longer text stays whole (``lpad`` alone would cut it)."""
    text = value.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def last_token(value: Column, separator: str = ".") -> Column:
    return F.substring_index(value, separator, -1)


def building_ref(value: Column) -> Column:
    """Building id out of a building or building-part id: the text before ``_`` and after ``BU.``."""
    return F.split_part(F.substring_index(value, "_", 1), F.lit(BUILDING_MARK), F.lit(2))


def street_key_of_address(value: Column) -> Column:
    """First three tokens of an address id; they equal the key of its street."""
    return F.substring_index(F.split_part(value, F.lit(ADDRESS_MARK), F.lit(2)), ".", 3)


def street_key_of_street(value: Column) -> Column:
    return F.split_part(value, F.lit(STREET_MARK), F.lit(2))


def compose_key(*parts: Column | str, sep: str = "-") -> Column:
    """Join key parts with ``sep``; one null part makes the whole key null."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    joined: list[Column] = []
    for column in columns:
        if joined:
            joined.append(F.lit(sep))
        joined.append(column.cast("string"))
    return F.concat(*joined)


def device_hash(key: Column, suffix: str) -> Column:
    """Stable device id: SHA-256 hex of the key and a suffix that names the measured kind."""
    return F.sha2(F.concat(key.cast("string"), F.lit(suffix)), 256)


def normalise_text(*parts: Column | str) -> Column:
    """Lower-case text joined with blanks, null if a part is null."""
    return F.lower(compose_key(*parts, sep=" "))


def split_pair(value: Column, sep: str = "_") -> tuple[Column, Column]:
    """``'lat_lon'`` as two doubles."""
    tokens = F.split(value, sep)
    return F.get(tokens, 0).cast("double"), F.get(tokens, 1).cast("double")


def path_list(value: Column, sep: str = "/") -> Column:
    return F.split(value, sep)


# The two patterns of camel-case word borders.
CAMEL_BORDERS = ("(.)([A-Z][a-z]+)", "([a-z0-9])([A-Z])")


def camel_to_snake(value: Column) -> Column:
    for border in CAMEL_BORDERS:
        value = F.regexp_replace(value, border, "$1_$2")
    return F.lower(value)


def period_index(name: Column, prefix: str = "mi") -> Column:
    """Zero-based period of a wide column name: ``mi7`` is hour 6."""
    return F.regexp_extract(name, f"^{prefix}(\\d+)$", 1).cast("int") - 1


def bin_value(name: Column) -> Column:
    """Bin centre of a histogram column name: ``HISTO_-0.02`` is -0.02."""
    return F.split_part(name, F.lit("_"), F.lit(2)).cast("double")


def coords_to_text(coords: Column, style: str = "text", kind: str = "Point") -> Column:
    """Coordinate items joined with blanks, or a GeoJSON geometry with ``style='geojson'``.

    ``coords`` is an array; nested items (rings) are written as JSON text.
    """
    if style == "geojson":
        return F.to_json(F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")))
    return F.array_join(coords.cast("array<string>") if kind == "Point" else F.transform(coords, lambda item: F.to_json(item)), " ")

