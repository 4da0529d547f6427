"""Connected components by alternating large and small stars: every round is two joins, written to the shared folder.

A large star ties all larger neighbours of a node to its smallest one, a small star its smaller neighbours. Minima combine map-side and the
joins are ones AQE can split, so a hub is no hot task. Only a row count and a checksum of each round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.shared import saved


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` of every node of an edge between two different nodes; the label is the smallest node of the component."""
    stars = saved(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "stars")
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("of")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        own = least.select(F.col("u").alias("of"), F.col("m").alias("m"))
        small = large.join(own, F.col("u") == F.col("of")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = saved(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).union(stars.select("v", "v").distinct())
