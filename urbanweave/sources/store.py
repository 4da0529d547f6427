"""Harmonised time-series store: the same rows laid out for access by device and by time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.functions.clock import (
    BUCKET_COUNT, BUCKET_SECONDS, epoch_seconds, period_end, time_bucket,
)
from urbanweave.session import remove_path, scratch_path
from urbanweave.sources.snapshots import CommitConflict, Snapshot, SnapshotLog

LAYOUTS = {"online": ("device", "start"), "batch": ("start", "device")}


def series_rows(df: DataFrame, device: Column, start: Column, freq: str, value: Column, is_real: bool = True,
                width: int = BUCKET_SECONDS, count: int = BUCKET_COUNT, extra: Sequence[Column] = ()) -> DataFrame:
    """Rows ``(bucket, device, start, end, isReal, value, ..)`` in epoch seconds."""
    first = epoch_seconds(start)
    return df.select(
        time_bucket(first, width, count).alias("bucket"), device.alias("device"), first.alias("start"),
        epoch_seconds(period_end(start, freq)).alias("end"), F.lit(is_real).alias("isReal"), value.alias("value"),
        *extra,
    )


# Fixed value: format of table names.
def table_name(layout: str, prop: str, freq: str, user: str) -> str:
    return f"harmonized_{layout}_{prop}_100_SUM_{freq}_{user}"


#: Columns that name a stored row: a later load overwrites the rows of its keys.
KEY = ("device", "start")


def _log(spark: SparkSession, path: str) -> SnapshotLog:
    """Versions of the series that a layout's path belongs to; both layouts are published by one commit."""
    folder, _, name = path.rstrip("/").rpartition("/")
    for layout in LAYOUTS:
        if name.startswith(f"harmonized_{layout}_"):
            return SnapshotLog(spark, f"{folder}/harmonized_versions_{name[len(layout) + 12:]}")
    raise ValueError(f"{path} is no layout of a series")


def _cell(path: str, load: str, bucket: int | None) -> str:
    return f"{path}/load={load}/bucket={'__HIVE_DEFAULT_PARTITION__' if bucket is None else bucket}"


def _read_cells(spark: SparkSession, path: str, cells: Sequence[tuple[str, int]]) -> DataFrame:
    read = spark.read.option("basePath", path).parquet(*[_cell(path, load, bucket) for load, bucket in cells])
    return read.withColumn("load", F.col("load").cast("string"))


def _ranges(rows: DataFrame) -> list[dict]:
    """Rows and first and last start of every bucket: a bounded table."""
    found = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min("start").alias("first"), F.max("start").alias("last"))
    return [r.asDict() for r in found.collect()]


def write_dual_layout(rows: DataFrame, root: str, prop: str, freq: str, user: str, partitions: int | None = None,
                      mode: str = "errorifexists", order: Sequence[str] = (), key: Sequence[str] = KEY) -> dict[str, str]:
    """Write the rows twice and return the path per layout; read them with :func:`read_series`.

    Modes: ``errorifexists`` for a new series; ``merge`` puts rows by key, as the original store does: of equal ``(device, start)`` in
    the load the last by ``order`` (then the highest) stays, and it overwrites what is stored; ``append`` adds rows without a
    look at each other but fails if a key is stored already. ``key`` names more columns if ``(device, start)`` doesn't tell rows apart, such as
    an event's id where a device sends several readings within a second; all loads of a series should name the same.

    Each layout is partitioned by load and bucket. Rows are spread by range of (bucket, leading keys) and sorted, so that
    file statistics skip what a query does not ask for, and a bucket or device that holds most rows is
    not written by one task. The number of ranges is ``partitions``, else ``spark.sql.shuffle.partitions``
    with small ones merged by AQE. The rows are staged in the shared folder first, so the sources are computed once.

    A merge costs what it touches: only stored cells (load and bucket) of the same times are looked at, by two columns, and only those that
    hold a key of the load are written again, into the folder of this load and without those keys. Both layouts become
    visible by one commit: a job that fails before leaves nothing, and can be run again. Readers keep the version they planned with.
    """
    spark = rows.sparkSession
    paths = {layout: f"{root}/{table_name(layout, prop, freq, user)}" for layout in LAYOUTS}
    log = _log(spark, paths["online"])
    if mode not in ("errorifexists", "append", "merge"):
        raise ValueError(f"mode {mode!r}")
    staged = scratch_path(spark, "staged-series")
    if mode == "merge":
        rest = F.struct(*[F.col(c) for c in (*order, *[c for c in rows.columns if c not in (*key, *order)])])
        newest = rows.groupBy(*key).agg(F.max(rest).alias("__rest"))
        rows = newest.select(*[F.col(c) if c in key else F.col(f"__rest.{c}").alias(c) for c in rows.columns])
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    made = {r["bucket"]: r for r in _ranges(rows)}
    while True:
        base = log.snapshot()
        if mode == "errorifexists" and base.version:
            raise FileExistsError(f"{paths['online']} has rows; merge or append to it")
        touched = _touched(rows, paths["batch"], base.folders, made, key) if base.folders else []
        if touched and mode == "append":
            raise ValueError(f"{len(touched)} stored cells hold keys of the rows to append")
        load, added = f"l{uuid.uuid4().hex}", {}
        for layout, keys in LAYOUTS.items():
            whole = rows
            if touched:
                kept = _read_cells(spark, paths[layout], touched).drop("load")
                whole = kept.join(_keys(rows, key), _same_key(key), "left_anti").unionByName(rows, allowMissingColumns=True)
            columns = ["bucket", *keys]
            ranged = whole.repartitionByRange(partitions, *columns) if partitions else whole.repartitionByRange(*columns)
            ranged.sortWithinPartitions(*columns).write.partitionBy("bucket").parquet(f"{paths[layout]}/load={load}")
        for r in _ranges(_read_cells(spark, paths["batch"], [(load, b) for b in made])) if touched else made.values():
            for layout, path in paths.items():
                added[_cell(path, load, r["bucket"])] = {"layout": layout, "load": load, **r}
        gone = [_cell(path, *cell) for path in paths.values() for cell in touched]
        if _publish(log, base, added, gone, made):
            break
        for path in paths.values():  # another load overlaps: look again
            remove_path(spark, f"{path}/load={load}")
    remove_path(spark, staged)
    return paths


def _keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"__{c}") for c in key])


def _same_key(key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])


def _meets(facts: dict, made: dict) -> bool:
    """Whether a stored cell may hold keys of the new rows. Rows without start have no range."""
    new = made.get(facts["bucket"])
    if new is None:
        return False
    return None in (new["first"], facts["first"]) or (facts["first"] <= new["last"] and new["first"] <= facts["last"])


def _touched(rows: DataFrame, path: str, folders: dict[str, dict], made: dict, key: Sequence[str]) -> list[tuple[str, int]]:
    """Stored cells with a key of the new rows."""
    near = [(f["load"], f["bucket"]) for f in folders.values() if f["layout"] == "batch" and _meets(f, made)]
    if not near:
        return []
    stored = _read_cells(rows.sparkSession, path, near).select("load", "bucket", *key)
    found = stored.join(_keys(rows, key), _same_key(key), "left_semi").select("load", "bucket").distinct()
    return [(r[0], r[1]) for r in found.collect()]  # at most one row a cell


def _publish(log: SnapshotLog, base: Snapshot, added: dict, gone: Sequence[str], made: dict) -> bool:
    """Commit unless a load published meanwhile may hold the same keys or has rewritten the same cells."""
    while True:
        latest = log.snapshot()
        others = [f for name, f in latest.folders.items() if name not in base.folders]
        if any(_meets(f, made) for f in others) or any(name not in latest.folders for name in gone):
            return False
        try:
            if log.commit_after(latest, added, list(gone)):
                return True
        except CommitConflict:
            return False


def compact_series(spark: SparkSession, path: str) -> int:
    """Write the cells of each bucket again as one load, in both layouts, and return the version. Few loads are quicker to read."""
    log = _log(spark, path)
    base = log.snapshot()
    loads, load, added = {f["load"] for f in base.folders.values()}, f"l{uuid.uuid4().hex}", {}
    if len(loads) < 2:
        return base.version
    for layout, keys in LAYOUTS.items():
        own = f"{path.rpartition('/')[0]}/{_sibling(path, layout)}"
        cells = sorted({(f["load"], f["bucket"]) for f in base.folders.values()})
        columns = ["bucket", *keys]
        _read_cells(spark, own, cells).drop("load").repartitionByRange(*columns).sortWithinPartitions(*columns).write.partitionBy("bucket").parquet(f"{own}/load={load}")
        for bucket in {f["bucket"] for f in base.folders.values()}:
            parts = [f for f in base.folders.values() if f["bucket"] == bucket and f["layout"] == layout]
            firsts, lasts = ([f[k] for f in parts if f[k] is not None] for k in ("first", "last"))
            added[_cell(own, load, bucket)] = {"layout": layout, "load": load, "bucket": bucket, "rows": sum(f["rows"] for f in parts),
                                               "first": min(firsts, default=None), "last": max(lasts, default=None)}
    return log.commit(base, added, list(base.folders))


def _sibling(path: str, layout: str) -> str:
    name = path.rstrip("/").rpartition("/")[2]
    own = next(k for k in LAYOUTS if name.startswith(f"harmonized_{k}_"))
    return f"harmonized_{layout}_{name[len(own) + 12:]}"


def clean_series(spark: SparkSession, path: str, delay: float = 7 * 24 * 3600) -> list[str]:
    """Delete cells that were replaced more than ``delay`` seconds ago."""
    return _log(spark, path).clean(delay)


def stored_buckets(spark: SparkSession, path: str) -> list[int]:
    """Buckets that a layout already has: what a backfill need not load again."""
    return sorted({f["bucket"] for f in _log(spark, path).snapshot().folders.values() if f["bucket"] is not None})


def read_series(spark: SparkSession, path: str, buckets: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
    """Rows of one layout; ``buckets`` (see ``buckets_between``) prunes cells. ``version`` reads an older one that wasn't cleaned."""
    layout = path.rstrip("/").rpartition("/")[2].split("_")[1]
    found = _log(spark, path).snapshot(version)
    cells = [(f["load"], f["bucket"]) for f in found.folders.values() if f["layout"] == layout]
    if not cells:
        raise FileNotFoundError(f"no rows were written to {path}")
    wanted = [c for c in cells if buckets is None or c[1] in set(buckets)]
    rows = _read_cells(spark, path, wanted or cells[:1]).drop("load")
    return rows if wanted else rows.limit(0)
