"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes of its Parquet files, that is broadcast after it was measured: several times that in memory.
BROADCAST_LIMIT = 8 * 1024 * 1024
#: And most rows of it: files of repeated values can be far smaller than what they hold.
BROADCAST_ROWS = 1_000_000

#: Settings every job of this library relies on: times are UTC instants, and AQE merges small partitions and splits
#: skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(name: str = "urbanweave", master: str | None = None, **settings: str) -> SparkSession:
    """A session with :data:`SETTINGS`; keyword arguments use ``_`` for ``.`` in setting names."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local master may run without it: there a fresh temporary folder is taken.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="urbanweave-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(base)
    return base


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table under a folder of this application, which is removed when the application ends."""
    base = f"{shared_folder(spark)}/scratch-{spark.sparkContext.applicationId}"
    files, target = _file_system(spark, base)
    files.mkdirs(target)
    files.deleteOnExit(target)
    return f"{base}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder whose rows no frame reads any more."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet in the shared folder and read back: later rounds neither recompute nor depend on one executor.

    Unlike a checkpoint of rows this is columnar: later reads take the columns they need, and Spark knows its true size.
    """
    return _written(df)[0]


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def settle(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The smaller side of a join, written once and measured: broadcast within ``limit`` bytes of Parquet and
    :data:`BROADCAST_ROWS`, never beyond them.

    Spark's own estimate is no bound for a side that was exploded. A larger side is joined by sort-merge; as
    it is read back from the shared folder, its exchange feeds the join directly, which is what AQE needs to
    split skewed partitions of the other side.
    """
    saved, path = _written(df)
    files, target = _file_system(df.sparkSession, path)
    small = files.getContentSummary(target).getLength() <= limit and saved.count() <= BROADCAST_ROWS
    return F.broadcast(saved) if small else saved.hint("merge")
