"""Raw key-value cells ``(rowkey, column, value)`` with row keys ``device~time``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.operators.dedup import first_row_per_device

# Separator of row keys and the two column families.
KEY_SEPARATOR = "~"
FAMILIES = ("info", "v")


def encode_cells(df: DataFrame, keys: Sequence[str], families: dict[str, Sequence[str]]) -> DataFrame:
    """Records to cells: one row per family column, named ``family:column``; null values have no cell."""
    cells = F.array(*[
        F.struct(F.lit(f"{family}:{name}").alias("column"), F.col(name).cast("string").alias("value"))
        for family, names in families.items() for name in names
    ])
    key = F.concat_ws(KEY_SEPARATOR, *[F.col(k).cast("string") for k in keys])
    return df.select(key.alias("rowkey"), F.inline(cells)).where(F.col("value").isNotNull())


def decode_raw_cells(cells: DataFrame, columns: Sequence[str], device: str, time: str,
                     families: Sequence[str] = FAMILIES) -> DataFrame:
    """Cells to records with the listed columns. Only the prefixes of ``families`` are taken off the names.

    ``max_by`` style first-non-null aggregates combine map-side; a row key has one cell per column.
    """
    name = F.regexp_replace("column", f"^({'|'.join(families)}):", "")
    named = cells.select("rowkey", name.alias("__name"), "value")
    records = named.groupBy("rowkey").agg(
        *[F.max(F.when(F.col("__name") == c, F.col("value"))).alias(c) for c in columns]
    )
    return records.select(
        F.split_part("rowkey", F.lit(KEY_SEPARATOR), F.lit(1)).alias(device),
        F.split_part("rowkey", F.lit(KEY_SEPARATOR), F.lit(2)).alias(time), *columns,
    )


def distinct_devices(records: DataFrame, device: str) -> DataFrame:
    """The device collection that goes with a batch of readings."""
    return records.select(device, F.col(device).alias("devices")).distinct()


def first_cells_per_device(records: DataFrame, device: str, time: str) -> DataFrame:
    return first_row_per_device(records, device, time)
