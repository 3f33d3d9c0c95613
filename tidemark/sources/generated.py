"""Sources that need no files: literal rows and calendars."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[tuple[Any, ...]], schema: str) -> DataFrame:
    """Rows written in code, under a DDL schema."""
    return spark.createDataFrame(list(rows), schema)


def month_sequence(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MONTH")))


def calendar_months(spark: SparkSession, start: Any, end: Any, name: str = "mes_ref") -> DataFrame:
    """First day of each month from ``start`` to ``end``, both included."""
    bounds = F.lit(start).cast("date"), F.lit(end).cast("date")
    return spark.range(1).select(month_sequence(*bounds).alias(name))


def months_between_bounds(df: DataFrame, month: Column, name: str = "mes_ref") -> DataFrame:
    """Calendar that spans the months seen in a table; empty for an empty table."""
    bounds = df.agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    return bounds.filter(F.col("_a").isNotNull()).select(month_sequence(F.col("_a"), F.col("_b")).alias(name))
