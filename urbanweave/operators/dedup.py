"""Deduplication and ranking with an explicit order.

``row_number() <= k`` is planned with a group limit before the shuffle, so a key that holds a large share
of all rows leaves each map task with ``k`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.session import settle

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int = 1) -> DataFrame:
    """First ``count`` rows per key in the given order; null keys are equal to each other."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= count).drop(_RANK)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order])


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_row_per_device(df: DataFrame, device: str, time: str, tie: Sequence[str] = ()) -> DataFrame:
    """Earliest row of each device: the distributed form of a skip scan over row keys."""
    return dedup_keep_first(df, [device], [time, *tie])


def upsert_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of both frames, one per key: the batch wins over the target, the last of ``order`` within it.

    The target has one row per key, so it is neither shuffled nor ranked unless the keys of the batch are too many to
    broadcast: they are measured, and target rows with one of them left out. Null keys equal each other.
    """
    newest = dedup_keep_last(batch, keys, order)
    key = F.struct(*[F.col(c) for c in keys])  # never null, and its null fields are equal
    changed = settle(newest.select(key.alias("__changed")))
    kept = target.withColumn("__key", key).join(changed, F.col("__key") == F.col("__changed"), "left_anti").drop("__key")
    return kept.unionByName(newest, allowMissingColumns=True)


def pick_by_source_priority(df: DataFrame, entity: Sequence[str], source: str, priorities: Sequence[str],
                            tie: Sequence[str], flag: str = "selected") -> DataFrame:
    """Flag one row per entity: the best ranked source, then the lowest ``tie``. Unlisted sources come last.

    The best key per entity is aggregated first (combined map-side) and joined back, so that an entity with
    very many rows is not sorted by one task. ``tie`` must tell the rows of an entity apart.
    """
    place = F.array_position(F.array(*[F.lit(p) for p in priorities]), F.col(source))
    rank = F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(priorities) + 1))
    key = F.struct(rank.alias("rank"), *[F.col(c) for c in tie])
    keyed = df.withColumn("__key", key)
    # A struct is never null and its null fields equal each other, so rows of a null entity are ranked as well.
    keyed = keyed.withColumn("__entity", F.struct(*[F.col(c) for c in entity]))
    best = settle(keyed.groupBy("__entity").agg(F.min("__key").alias("__best")))
    return (
        keyed.join(best, "__entity", "left").drop("__entity")
        .withColumn(flag, F.coalesce(F.col("__key") == F.col("__best"), F.lit(False)))
        .drop("__key", "__best")
    )


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, shard: Column,
                  shards: int) -> DataFrame:
    """Dense numbers 1.. within each key, in ``(shard, order)`` order, without one task per key.

    ``shard`` is an integer expression in ``[0, shards)``. Rows are numbered inside ``(key, shard)`` and
    shifted by the sizes of the shards before, which come from one small aggregate.
    """
    # The struct is never null, and its null fields equal each other; joined on it, both sides keep the
    # partitioning their window and aggregate already have.
    group = F.struct(*[F.col(k) for k in keys], shard.cast("int").alias("__shard"))
    sharded = df.withColumn("__group", group)
    sizes = sharded.groupBy("__group").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*[F.col(f"__group.{k}") for k in keys]).orderBy("__group.__shard").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("__group", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    local = Window.partitionBy("__group").orderBy(*order)
    return sharded.withColumn("__local", F.row_number().over(local)).join(offsets, "__group").select(
        *[F.col(c) for c in df.columns], (F.col("__local") + F.col("__offset")).cast("long").alias(out)
    )
