"""Registry of the queries run on the test tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Test tables by name: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(key: str, sql: str | None = None):
    """Register ``function(tables) -> DataFrame`` under ``key``."""
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(Tables(spark, folder))

        run.__name__ = key
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return function

    return register
