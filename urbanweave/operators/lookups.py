"""Dictionary lookups and joins.

Plain tables are left to Spark, which broadcasts a side below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles, with skewed partitions split by AQE. Derived sides are measured first (``settle``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.functions.text import compose_key, zero_pad
from urbanweave.operators.dedup import first_per_key
from urbanweave.operators.fuzzy import similar_pairs
from urbanweave.session import cut_lineage, settle


def semi_join_known(df: DataFrame, known: DataFrame, on: str, known_on: str | None = None) -> DataFrame:
    """Rows whose key exists in ``known``."""
    keys = known.select(F.col(known_on or on).alias("__known"))
    return df.join(keys, df[on] == keys["__known"], "left_semi")


def dictionary_entries(dictionary: DataFrame, key: str | Column, value: str, order: Sequence[str] = ()) -> DataFrame:
    """Dictionary with one value per key, written and measured once: the last of ``order`` wins, then the highest value."""
    rank = F.struct(*[F.col(c) for c in order], F.col(value))
    return settle(dictionary.groupBy((F.col(key) if isinstance(key, str) else key).alias("__key")).agg(
        F.max_by(F.col(value), rank).alias("__value")).withColumn("__hit", F.lit(True)))


def lookup(df: DataFrame, dictionary: DataFrame, on: Column, key: str | Column, value: str, out: str,
           on_missing: str = "null", order: Sequence[str] = ()) -> DataFrame:
    """Map ``on`` through a dictionary into column ``out``.

    ``on_missing``: ``'fail'`` stops the job at the first unknown key, ``'null'`` maps it to null,
    ``'reject'`` keeps only the rows without a match (to be stored aside), ``'drop'`` only those with one.
    Keys that the dictionary repeats have one value (see :func:`dictionary_entries`), so no row is multiplied.
    """
    return look_into(df, dictionary_entries(dictionary, key, value, order), on, out, on_missing)


def look_into(df: DataFrame, entries: DataFrame, on: Column, out: str, on_missing: str = "null") -> DataFrame:
    """:func:`lookup` in entries that several lookups share."""
    marked = df.withColumn("__on", on)
    if on_missing == "reject":
        return marked.join(entries, F.col("__on") == F.col("__key"), "left_anti").drop("__on")
    joined = marked.join(entries, F.col("__on") == F.col("__key"), "inner" if on_missing == "drop" else "left")
    mapped = F.col("__value")
    if on_missing == "fail":
        message = F.concat(F.lit(f"{out}: unknown key "), F.coalesce(F.col("__on").cast("string"), F.lit("null")))
        mapped = F.when(F.col("__hit"), mapped).otherwise(F.raise_error(message))
    elif on_missing not in ("null", "drop"):
        raise ValueError(f"on_missing={on_missing!r}")
    return joined.withColumn(out, mapped).drop("__on", "__key", "__value", "__hit")


def lookup_strict(df: DataFrame, dictionary: DataFrame, on: str, key: str, value: str, out: str,
                  order: Sequence[str] = ()) -> DataFrame:
    return lookup(df, dictionary, F.col(on), key, value, out, "fail", order)


def lookup_lenient(df: DataFrame, dictionary: DataFrame, on: str, key: str, value: str, out: str,
                   order: Sequence[str] = ()) -> DataFrame:
    return lookup(df, dictionary, F.col(on), key, value, out, "null", order)


def tariff_entries(dictionary: DataFrame, source: str = "SOURCE", tariff: str = "Tariff", sector: str = "EconomicSector",
                   order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Tariffs by composite key, and sector names by its first part, for several calls of :func:`tariff_taxonomy`."""
    prefix = F.split_part(F.col(source), F.lit("~"), F.lit(1))
    return dictionary_entries(dictionary, source, tariff, order), dictionary_entries(dictionary, prefix, sector, order)


def tariff_taxonomy(df: DataFrame, dictionary: DataFrame | tuple[DataFrame, DataFrame], parts: Sequence[str], source: str = "SOURCE",
                    tariff: str = "Tariff", sector: str = "EconomicSector", order: Sequence[str] = (),
                    on_missing: str = "fail") -> DataFrame:
    """Composite key ``a~b~c`` to tariff, and its first part to the sector name.

    The first of ``parts`` is the sector column and is replaced. Dictionary rows later in ``order`` win. ``dictionary`` is the
    table, or what :func:`tariff_entries` made of it.
    """
    tariffs, sectors = dictionary if isinstance(dictionary, tuple) else tariff_entries(dictionary, source, tariff, sector, order)
    found = look_into(df, tariffs, compose_key(*parts, sep="~"), "tariff", on_missing)
    return look_into(found, sectors, F.col(parts[0]), parts[0], on_missing)


def join_derived_key(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column,
                     keep: Sequence[Column]) -> DataFrame:
    """Inner join on keys computed on both sides; ``keep`` are the columns taken from the right."""
    a = left.withColumn("__lk", left_key)
    b = right.select(right_key.alias("__rk"), *keep)
    return a.join(b, F.col("__lk") == F.col("__rk"), "inner").drop("__lk", "__rk")


def join_matches(left: DataFrame, right: DataFrame, on: str, right_on: str) -> DataFrame:
    """Left join of matched text; duplicates on the right give several rows."""
    return left.join(right, left[on] == right[right_on], "left")


def postal_station_fallback(df: DataFrame, stations: DataFrame, code: str, station_code: str,
                            payload: Sequence[str], width: int = 5) -> DataFrame:
    """Station of the postal code itself, else of the next code, else of the code before.

    A code that ends in 0 has no fallback to the one before, one that ends in 9 none to the next. The
    station table is expanded to the codes each station can serve, so the large side is joined once.
    """
    served = stations.select(
        F.col(station_code).cast("long").alias("__own"), *payload,
        F.explode(F.array(*[
            F.struct(F.lit(rank).alias("rank"), F.lit(shift).alias("shift"))
            for rank, shift in ((0, 0), (1, -1), (2, 1))
        ])).alias("__try"),
    ).withColumn("__code", F.col("__own") + F.col("__try.shift"))
    digit = F.pmod(F.col("__code"), F.lit(10))
    allowed = (
        (F.col("__try.rank") == 0)
        | ((F.col("__try.rank") == 1) & (digit != 9))
        | ((F.col("__try.rank") == 2) & (digit != 0))
    )
    best = first_per_key(
        served.where(allowed & (F.col("__code") >= 0)), ["__code"],
        [F.col("__try.rank").asc(), *[F.col(c).asc_nulls_last() for c in payload]],
    ).select(
        zero_pad(F.col("__code"), width).alias("__code"),
        zero_pad(F.col("__own"), width).alias("matched_code"), *payload,
    )
    return df.join(best, zero_pad(df[code], width) == best["__code"], "left").drop("__code")


def _zone_names(df: DataFrame, on: dict[str, str]) -> DataFrame:
    """One row per level, with the zone name of the row in ``__zone.name``."""
    return df.withColumn("__zone", F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), F.lower(F.trim(F.col(name))).alias("name"))
        for level, name in on.items()
    ]))).withColumn("level", F.col("__zone.level"))


def link_admin_zone(df: DataFrame, gazetteer: DataFrame, levels: DataFrame, country: str,
                    on: dict[str, str], threshold: float | None = None, rejects: bool = False) -> DataFrame:
    """Links ``(level, relation, uri)`` of each row to the zones of a gazetteer.

    ``levels`` is the configuration ``(country, level, feature_code, relation)``; ``gazetteer`` holds
    ``(country, feature_code, name, uri)``; ``on`` names the column of ``df`` that holds the zone name of a
    level. Names are compared lower-case and trimmed. With a ``threshold``, a name that no zone of its country and level has takes
    the most similar name of its country and level, if it scores that much. ``rejects`` gives the rows and levels without a link instead.
    """
    wanted = _zone_names(df, on)
    zones = gazetteer.join(levels, ["country", "feature_code"]).select(
        F.col("country").alias("__country"), F.col("level").alias("__level"), "relation", "uri",
        F.lower(F.trim("name")).alias("__name"),
    )
    if threshold is not None:
        zones = cut_lineage(zones)
        wanted = _with_nearest_names(wanted, zones, country, list(on), threshold)
    same = (F.col(country) == F.col("__country")) & (F.col("level") == F.col("__level")) & (F.col("__zone.name") == F.col("__name"))
    if rejects:
        return wanted.join(zones, same, "left_anti").drop("__zone")
    return wanted.join(zones, same, "inner").drop("__country", "__level", "__zone", "__name")


def _with_nearest_names(wanted: DataFrame, zones: DataFrame, country: str, levels: Sequence[str], threshold: float) -> DataFrame:
    """Names that no zone has, replaced by the most similar ones of their country and level; ties go to the lower name.

    All pairs of distinct names within the threshold are found for a level, then kept where a country has both.
    """
    out = None
    for level in levels:
        own, names = wanted.where(F.col("level") == level), zones.where(F.col("__level") == level)
        same = (F.col(country) == F.col("__country")) & (F.col("__zone.name") == F.col("__name"))
        missing = cut_lineage(own.join(names, same, "left_anti").select(F.col(country).alias("__land"), F.col("__zone.name").alias("__missing")).dropna().distinct())
        offered = cut_lineage(names.select(F.col("__country").alias("__land"), F.col("__name").alias("__near")).dropna().distinct())
        pairs = similar_pairs(missing.select(F.col("__missing").alias("text")).distinct(), offered.select(F.col("__near").alias("text")).distinct(), threshold)
        pairs = pairs.where(F.col("score") >= threshold).select(F.col("left_text").alias("__missing"), F.col("right_text").alias("__near"), F.col("score").alias("__score"))
        met = pairs.join(missing, "__missing").join(offered, ["__land", "__near"])
        near = settle(first_per_key(met, ["__land", "__missing"], [F.col("__score").desc(), F.col("__near").asc()]).select("__land", "__missing", "__near"))
        met = own.join(near, (F.col("__zone.name") == F.col("__missing")) & (F.col(country) == F.col("__land")), "left").withColumn(
            "__zone", F.struct(F.col("__zone.level").alias("level"), F.coalesce("__near", "__zone.name").alias("name"))).drop("__land", "__missing", "__near")
        out = met if out is None else out.unionByName(met)
    return out
