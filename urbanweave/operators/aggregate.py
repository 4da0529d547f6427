"""Aggregations of harmonised series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.functions.clock import truncate_to


def sum_by_series(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Sum per key. Rows with a null key are left out and a sum over nulls only is 0."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))


#: Functions a rule of :func:`device_aggregate` may ask for.
FUNCTIONS = ("SUM", "AVG", "CDD", "HDD")


def device_aggregate(df: DataFrame, rules: Sequence[dict], group: Sequence[str], prop: str, source: str | None,
                     time: str, value: str, heating_base: float = 18.0, cooling_base: float = 21.0) -> DataFrame:
    """Aggregated devices: one row per group, rule, period and function.

    A rule is ``{measured_property, source, freq, agg_name, required, agg_func}``; without ``source`` it holds for all sources.
    ``agg_func`` lists SUM, AVG, CDD and HDD. Degree days are those of the daily means of a group, added up over the
    period. Rules are a handful of literals, so they are matched inside the row; values are summed by day first, and the few
    day rows of a period once more.
    """
    for rule in rules:
        if unknown := set(rule["agg_func"]) - set(FUNCTIONS):
            raise ValueError(f"{rule['agg_name']}: unknown functions {sorted(unknown)}")
    hits = []
    for rule in rules:
        test = F.col(prop) == rule["measured_property"]
        if rule.get("source") is not None:
            if source is None:
                raise ValueError(f"{rule['agg_name']}: its source needs a source column")
            test &= F.col(source) == rule["source"]
        hits.append(F.when(test, F.struct(
            F.lit(rule["agg_name"]).alias("agg_name"),
            F.lit(rule["freq"]).alias("freq"),
            F.lit(bool(rule.get("required", False))).alias("required"),
            F.array(*[F.lit(f) for f in rule["agg_func"]]).alias("functions"),
            truncate_to(F.col(time), rule["freq"]).alias("period"),
        )))
    matched = df.select(*group, F.col(value).alias("__value"), F.to_date(time).alias("__day"),
                        F.explode(F.array_compact(F.array(*hits))).alias("__rule"))
    days = matched.groupBy(*group, "__rule", "__day").agg(
        F.sum("__value").alias("__sum"), F.count("__value").alias("__count"), F.avg("__value").alias("__mean")
    )
    sums = days.groupBy(*group, "__rule").agg(
        F.sum("__sum").alias("SUM"), F.try_divide(F.sum("__sum"), F.sum("__count")).alias("AVG"),
        F.sum(F.greatest(F.col("__mean") - F.lit(cooling_base), F.when(F.col("__mean").isNotNull(), 0.0))).alias("CDD"),
        F.sum(F.greatest(F.lit(heating_base) - F.col("__mean"), F.when(F.col("__mean").isNotNull(), 0.0))).alias("HDD"),
    )
    value_of = F.when(F.lit(False), F.lit(0.0))
    for name in FUNCTIONS:
        value_of = value_of.when(F.col("agg_func") == name, F.col(name))
    return sums.select(
        *group, "__rule.agg_name", "__rule.freq", "__rule.required", "__rule.period", *FUNCTIONS,
        F.explode("__rule.functions").alias("agg_func"),
    ).withColumn("value", value_of).drop(*FUNCTIONS)


def degree_days(df: DataFrame, station: str, time: str, temperature: str, heating_base: float = 18.0,
                cooling_base: float = 21.0) -> DataFrame:
    """Heating and cooling degree days out of the daily mean; the bases are the caller's choice."""
    daily = df.groupBy(F.col(station), F.to_date(time).alias("day")).agg(F.avg(temperature).alias("mean"))
    return daily.select(
        station, "day", "mean",
        F.greatest(F.lit(heating_base) - F.col("mean"), F.lit(0.0)).alias("hdd"),
        F.greatest(F.col("mean") - F.lit(cooling_base), F.lit(0.0)).alias("cdd"),
    )
