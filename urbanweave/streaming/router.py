"""Streaming: envelopes in, harmonised keyed tables out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from urbanweave.operators.dedup import dedup_keep_last
from urbanweave.session import remove_path
from urbanweave.sources.messages import ENVELOPE
from urbanweave.sources.snapshots import CommitConflict, Snapshot, SnapshotLog

#: Subfolders of the committed state: a stream (its id is kept in its checkpoint), and in it one per micro-batch.
_STREAM, _BATCH = "stream_id", "batch_id"
#: Number of the commit a row came by: orders the batches of several streams.
_ORDER = "__commit"


def route_messages(messages: DataFrame, collection_type: str, text: str = "value") -> DataFrame:
    """Records of one collection type: envelope fields plus ``record`` (map), one row per record.

    Works on batch and streaming frames alike. Other types are filtered before their data is expanded.
    """
    envelope = messages.select(F.from_json(F.col(text), ENVELOPE).alias("m"))
    return envelope.where(F.col("m.collection_type") == collection_type).select(
        "m.namespace", "m.user", "m.timezone", "m.source", F.explode("m.data").alias("record")
    )


def store_table(collection_type: Column, source: str, user: Column) -> Column:
    """Raw table of a message; device lists are not stored."""
    return F.when(collection_type == "invoices", F.concat(F.lit(f"raw_{source}_ts_invoices__"), user))


def _log(spark: SparkSession, table: str) -> SnapshotLog:
    return SnapshotLog(spark, f"{table}/_versions")


def harmonize_stream(source: DataFrame, harmonize: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                     order: Sequence[str], table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Harmonise a stream of messages and store it under ``table``; read it with :func:`read_upserted`.

    Each micro-batch writes its own folder below that of its stream, with one row per key, and publishes it as a version of the table.
    A batch that is replayed writes its folder anew, unless it was published before. Several streams, and a stream begun anew with
    another checkpoint, share a table without touching each other's folders. The target is never rewritten: a batch costs
    what it brings. The version that was published last wins per key at read time, whichever clock its writer has.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        log, folder = _log(spark, table), f"{table}/{_STREAM}={stream}/{_BATCH}={batch_id}"
        base = log.snapshot()
        if _published(base, folder, stream, batch_id):
            return
        dedup_keep_last(harmonize(batch), keys, order).write.mode("overwrite").parquet(folder)
        log.commit(base, {folder: {"stream": stream, "batch": batch_id}})

    writer = source.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _published(base: Snapshot, folder: str, stream: str, batch_id: int) -> bool:
    """Whether a batch is in the table, by itself or in what it was compacted to."""
    return folder in base.folders or any(batch_id <= f.get("holds", {}).get(stream, -1) for f in base.folders.values())


def _versions(spark: SparkSession, table: str, schema: T.StructType, found: Snapshot) -> DataFrame:
    """All rows of a version, with the number of the commit they came by."""
    whole = T.StructType([*schema.fields, T.StructField(_STREAM, T.StringType()), T.StructField(_BATCH, T.LongType())])
    if not found.folders:
        return spark.createDataFrame([], whole).withColumn(_ORDER, F.lit(0).cast("long"))
    rows = spark.read.schema(whole).option("basePath", table).parquet(*found.folders)
    places = [(f["stream"], f["batch"], f["order"]) for f in found.folders.values()]
    numbers = spark.createDataFrame(places, f"__stream string, __batch long, {_ORDER} long")  # one row a folder
    return rows.join(F.broadcast(numbers), (F.col(_STREAM) == F.col("__stream")) & (F.col(_BATCH) == F.col("__batch"))).drop("__stream", "__batch")


def read_upserted(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str],
                  order: Sequence[str] = (), version: int | None = None) -> DataFrame:
    """Rows of a table written by :func:`harmonize_stream`, of its latest version or an older one: later commits win, then later ``order``.

    The frame keeps to its version: what streams and compactions do meanwhile neither shows in it nor breaks it.
    """
    rows = _versions(spark, table, schema, _log(spark, table).snapshot(version))
    return dedup_keep_last(rows, keys, [_ORDER, *order]).drop(_ORDER, _STREAM, _BATCH)


def compact_upserted(spark: SparkSession, table: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = ()) -> str:
    """Publish a version that has the current rows in one folder instead of all versions of them, so that reads stop paying for old ones.

    Streams may go on: what they publish meanwhile is newer than the compacted rows, whose place is that of the version they were
    read from. Of two compactions at once the first to publish counts. Replaced folders stay for readers until :func:`clean_upserted`.
    """
    log = _log(spark, table)
    base = log.snapshot()
    if len(base.folders) < 2:
        return table
    holds: dict[str, int] = {}
    for facts in base.folders.values():
        for stream, batch in (facts.get("holds") or {facts["stream"]: facts["batch"]}).items():
            holds[stream] = max(batch, holds.get(stream, -1))
    name = f"compacted-{uuid.uuid4().hex}"
    folder = f"{table}/{_STREAM}={name}/{_BATCH}=0"
    dedup_keep_last(_versions(spark, table, schema, base), keys, [_ORDER, *order]).drop(_ORDER, _STREAM, _BATCH).write.parquet(folder)
    try:
        log.commit(base, {folder: {"stream": name, "batch": 0, "order": base.version, "holds": holds}}, list(base.folders))
    except CommitConflict:
        remove_path(spark, folder)
    return table


def clean_upserted(spark: SparkSession, table: str, delay: float = 24 * 3600) -> list[str]:
    """Delete folders that were replaced more than ``delay`` seconds ago, and return them."""
    return _log(spark, table).clean(delay)
