"""Named queries over the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Driver tables by name: ``t.lineitem`` reads ``<dir>/lineitem.parquet``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, table: str) -> DataFrame:
        if table not in self._read:
            self._read[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._read[table]


def query(sql: str | None = None, name: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register
