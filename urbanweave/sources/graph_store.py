"""A stored graph that sources are loaded into one after the other: what is there already is not added again.

Facts (types and values of nodes) and edges lie in folders by a hash of the node's URI; every load adds folders, and one commit publishes
them all (see :mod:`urbanweave.sources.snapshots`). A load looks only at the parts its nodes fall in, and meets stored rows through
its own keys, measured and broadcast if they are few: then the store isn't shuffled. Loading a source twice adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.operators.graph import LIST_PREDICATES, RDF_TYPE, TAGS, graph_edges, merge_nodes
from urbanweave.session import cut_lineage, remove_path, settle
from urbanweave.sources.snapshots import Snapshot, SnapshotLog

#: Parts of the store.
PARTS = 64

FACTS = ("s", "p", "o", "o_kind", *TAGS)
EDGES = ("src", "rel", "dst")


def _log(spark: SparkSession, root: str) -> SnapshotLog:
    return SnapshotLog(spark, f"{root}/_versions")


def _part(uri: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(uri), F.lit(parts)).cast("int")


def _stored(spark: SparkSession, root: str, table: str, found: Snapshot, parts: Sequence[int] | None = None) -> DataFrame | None:
    """Rows of a table with the number of their load, in some parts or all."""
    folders = [name for name, f in found.folders.items() if f["table"] == table and (parts is None or f["part"] in parts)]
    return spark.read.option("basePath", f"{root}/{table}").parquet(*folders) if folders else None


def _same(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])  # never null; null fields are equal


def _new_rows(new: DataFrame, stored: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Distinct new rows that aren't stored: stored rows are met by the new keys, so only those are left to compare with."""
    if stored is None:
        return new
    wanted = settle(new.select(_same(keys).alias("__wanted")))
    there = cut_lineage(stored.withColumn("__key", _same(keys)).join(wanted, F.col("__key") == F.col("__wanted"), "left_semi").select(F.col("__key").alias("__there")))
    return new.withColumn("__key", _same(keys)).join(there, F.col("__key") == F.col("__there"), "left_anti").drop("__key")


def _changed(new: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Single values that differ from those of the last load that has any."""
    if stored is None:
        return new
    key = ("s", "p")
    wanted = settle(new.select(_same(key).alias("__wanted")))
    near = stored.withColumn("__key", _same(key)).join(wanted, F.col("__key") == F.col("__wanted"), "left_semi")
    value = ("o", "o_kind", *TAGS)
    last = cut_lineage(near.groupBy("__key").agg(F.max(F.struct("load", *value)).alias("__last")).select(F.col("__key").alias("__of"), _same([f"__last.{c}" for c in value]).alias("__had")))
    met = new.withColumn("__key", _same(key)).join(last, F.col("__key") == F.col("__of"), "left")
    return met.where(F.col("__had").isNull() | (_same(value) != F.col("__had"))).select(*new.columns)


def load_graph(triples: DataFrame, root: str, list_predicates: Sequence[str] = LIST_PREDICATES, parts: int = PARTS) -> int:
    """Add the triples of a source and return the version; the same version as before if nothing is new.

    Types, values of the listed predicates and edges are united. Of other properties a node has one value: that of the last load that
    states one (the highest of a load).
    """
    spark = triples.sparkSession
    log = _log(spark, root)
    for tag in TAGS:
        if tag not in triples.columns:
            triples = triples.withColumn(tag, F.lit(None).cast("string"))
    facts = triples.where((F.col("o_kind") == "literal") | (F.col("p") == RDF_TYPE)).select(*FACTS)
    many = F.col("p").isin(RDF_TYPE, *list_predicates)
    rest = F.struct(*[F.col(c) for c in FACTS[2:]])
    single = facts.where(~many).groupBy("s", "p").agg(F.max(rest).alias("v")).select("s", "p", *[F.col(f"v.{c}").alias(c) for c in FACTS[2:]])
    new = {"facts": cut_lineage(facts.where(many).distinct().withColumn("many", F.lit(True)).unionByName(single.withColumn("many", F.lit(False))).withColumn("part", _part("s", parts))),
           "edges": cut_lineage(graph_edges(triples).withColumn("part", _part("src", parts)))}
    touched = {name: [r[0] for r in rows.select("part").distinct().collect()] for name, rows in new.items()}  # at most ``parts`` each
    while True:
        base = log.snapshot()
        load, added = base.version + 1, {}
        there = {name: _stored(spark, root, name, base, touched[name]) for name in new}
        listed, one = new["facts"].where("many").drop("many"), new["facts"].where("not many").drop("many")
        fresh = {"facts": _new_rows(listed, there["facts"], FACTS).unionByName(_changed(one, there["facts"])), "edges": _new_rows(new["edges"], there["edges"], EDGES)}
        folder = f"load={load}-{uuid.uuid4().hex[:8]}"
        for name, rows in fresh.items():
            rows, path = cut_lineage(rows), f"{root}/{name}/{folder}"
            held = [r[0] for r in rows.select("part").distinct().collect()]
            if held:
                rows.withColumn("load", F.lit(load)).repartition("part").sortWithinPartitions("part", rows.columns[0]).write.partitionBy("part").parquet(path)
            added |= {f"{path}/part={part}": {"table": name, "part": part, "load": load} for part in held}
        if not added or log.commit_after(base, added):
            return base.version if not added else load
        for name in fresh:  # another load came first: compare with it too
            remove_path(spark, f"{root}/{name}/{folder}")


def read_graph(spark: SparkSession, root: str, list_predicates: Sequence[str] = LIST_PREDICATES, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``nodes(uri, labels, props)`` and ``edges(src, rel, dst)`` of a version."""
    found = _log(spark, root).snapshot(version)
    facts, edges = (_stored(spark, root, name, found) for name in ("facts", "edges"))
    nodes = merge_nodes(facts if facts is not None else spark.createDataFrame([], ", ".join(f"{c} string" for c in FACTS) + ", load int"), list_predicates, "load")
    return nodes, edges.select(*EDGES) if edges is not None else spark.createDataFrame([], ", ".join(f"{c} string" for c in EDGES))
