"""Tables written once to the shared folder, so that a lost executor costs no recomputation of what came before."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.session import scratch_path

#: Name of the archive that :func:`ship` gives the executors.
PACKAGE = "urbanweave-package"

#: A batch is held by the JVM and by Python, as it comes in and as it goes out.
BATCH_BYTES = 8 << 20


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows, written as Parquet under the folder of ``spark.checkpoint.dir`` and read back, and their path, to be removed earlier than at the end."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written as Parquet under the folder of ``spark.checkpoint.dir`` and read back."""
    return written(df, label)[0]


def fresh(df: DataFrame, base: str) -> str:
    """A column name that a frame doesn't have yet, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def frequent(counts: DataFrame, key: str, times: str, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (long) and counts of the ``limit`` most frequent rows of a saved table of distinct keys; ties go to the lower key.

    Counts are weighed by level first (32 for each doubling), so that only rows that belong to the list reach the driver, and of the
    last count as many of its keys as a hash's place among them tells, which is a little more than what is still wanted.
    """
    level = F.floor(F.log2(F.col(times).cast("double")) * 32).cast("int")
    known = counts.select(F.col(key).cast("long").alias("key"), F.col(times).cast("long").alias("times")).withColumn("level", level)

    def fetched(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        table = rows.select("key", "times").toArrow()
        keys, own = table.column("key").to_numpy(), table.column("times").to_numpy()
        order = np.lexsort((keys, -own))
        return keys[order], own[order]

    def whole(sizes: list, room: int) -> tuple[int | None, int, int]:
        """The first value that doesn't fit as a whole, what is left for it, and how many it has."""
        for value, n in sorted(sizes, reverse=True):
            if n > room:
                return value, room, n
            room -= n
        return None, room, 0

    cut, room, _ = whole([tuple(r) for r in known.groupBy("level").count().collect()], limit)
    if cut is None:
        return fetched(known)
    parts = [fetched(known.where(F.col("level") > cut))]
    inside = known.where(F.col("level") == cut)
    last, room, n = whole([tuple(r) for r in inside.groupBy("times").count().collect()], room)
    parts.append(fetched(inside.where(F.col("times") > last)))
    share = room / n
    while room:
        share = min(1.0, share * 1.1 + 20 / n)
        least = F.lit(-(1 << 63) + min(int(share * (1 << 64)), (1 << 64) - 1))
        keys, own = fetched(inside.where((F.col("times") == last) & (F.col("key") <= least)))
        if len(keys) >= room or share == 1.0:
            parts.append((keys[:room], own[:room]))
            break
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def prepare(spark: SparkSession) -> None:
    """What tasks over whole texts want: this package on the executors, and Arrow batches of at most :data:`BATCH_BYTES`.

    The setting stays with the session: plans that were declared are run later. A smaller one is left as it is.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    current = str(spark.conf.get(setting)).lower().removesuffix("b")
    if not current.isdigit() or int(current) > BATCH_BYTES or int(current) <= 0:
        spark.conf.set(setting, str(BATCH_BYTES))
    ship(spark)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for a Spark context, so that it need not be installed or on their path."""
    context = spark.sparkContext
    if any(name.endswith(f"{PACKAGE}.zip") for name in context._python_includes):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix=PACKAGE)) / f"{PACKAGE}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, f"{root.name}/{file.relative_to(root)}")
    context.addPyFile(str(path))
