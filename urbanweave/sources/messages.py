"""Message envelopes and the plan of a backfill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.operators.dedup import number_within

# Fixed value: records per message.
MESSAGE_SIZE = 10

ENVELOPE = (
    "namespace string, user string, timezone string, collection_type string, source string, "
    "row_keys array<string>, data array<map<string,string>>"
)


def build_envelopes(records: DataFrame, groups: Sequence[str], order: Sequence[str], collection_type: Column,
                    namespace: str, user: Column, timezone: str, source: Column, row_keys: Sequence[str],
                    data: Sequence[str], shard: Column, shards: int, size: int = MESSAGE_SIZE) -> DataFrame:
    """One row per message: the group, ``chunk``, ``records`` and the JSON ``message`` of up to ``size`` records.

    Records are numbered per group without one task per group (see ``number_within``), so a group may hold
    any share of all records; a message gathers ``size`` records at most.
    """
    numbered = number_within(
        records.withColumns({"__type": collection_type, "__user": user.cast("string"), "__source": source}),
        groups, order, "__no", shard, shards,
    )
    item = F.create_map(*[x for c in data for x in (F.lit(c), F.col(c).cast("string"))])
    chunk = F.floor((F.col("__no") - 1) / size).cast("long")
    gathered = numbered.groupBy(*groups, chunk.alias("chunk"), "__type", "__user", "__source").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__no").alias("no"), F.to_json(item).alias("item")))).alias("items"),
    )
    body = F.transform("items", lambda i: F.from_json(i.item, "map<string,string>"))
    message = F.to_json(F.struct(
        F.lit(namespace).alias("namespace"), F.col("__user").alias("user"), F.lit(timezone).alias("timezone"),
        F.col("__type").alias("collection_type"), F.col("__source").alias("source"),
        F.array(*[F.lit(k) for k in row_keys]).alias("row_keys"), body.alias("data"),
    ))
    return gathered.select(*groups, "chunk", F.size("items").alias("records"), message.alias("message"))


def plan_missing_partitions(ids: DataFrame, existing: DataFrame, id_col: str, start: date, end: date) -> DataFrame:
    """Months in ``[start, end)`` without data for an id: ``(id, month, first_day, last_day)``.

    ``existing`` holds ``(id, month)`` with the month as ``yyyy-MM``.
    """
    first = F.lit(start.isoformat()).cast("date")
    stop = F.date_sub(F.lit(end.isoformat()).cast("date"), 1)
    span = F.sequence(first, stop, F.expr("interval 1 month")) if start < end else F.array().cast("array<date>")
    months = ids.select(id_col).distinct().select(id_col, F.explode(span).alias("first_day"))
    planned = months.select(
        id_col, F.date_format("first_day", "yyyy-MM").alias("month"), "first_day",
        F.date_sub(F.add_months("first_day", 1), 1).alias("last_day"),
    )
    return planned.join(existing.select(id_col, "month"), [id_col, "month"], "left_anti")
