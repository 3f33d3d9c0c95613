"""Duplicates, sub-rows and grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse_duplicates(df: DataFrame, copies: str = "__copias") -> DataFrame:
    """One row per distinct row, with how many copies it had.

    Copies meet in the map-side aggregate, so a row repeated across the table is no hot key.
    """
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))


def dedup_report(collapsed: DataFrame, value: Column, copies: str = "__copias") -> DataFrame:
    """Rows and value before and after removing copies, from one pass over the collapsed rows."""
    n = F.col(copies)
    zero = lambda c: F.coalesce(c, F.lit(0))
    value = F.coalesce(value, F.lit(0))
    return collapsed.agg(
        zero(F.sum(n)).alias("linhas_antes"),
        F.count(F.lit(1)).alias("linhas_depois"),
        zero(F.sum(n - 1)).alias("linhas_removidas"),
        zero(F.sum(value * (n - 1))).alias("soma_removida"),
        # magnitudes cannot cancel each other, so this is 0 only if every removed copy is worth 0
        zero(F.sum(F.abs(value) * (n - 1))).alias("modulo_removido"),
    )


class ValueLost(ValueError):
    """Removing duplicates would change a total."""


def dedup_conserving(collapsed: DataFrame, value: Column, tolerance: float = 0, copies: str = "__copias") -> DataFrame:
    """Rows without their copies; raises when the copies carry value, even where gains and losses cancel.

    Takes the output of :func:`collapse_duplicates`, staged if the caller goes on to use it,
    so that the gate and the result share one shuffle.
    """
    removed = dedup_report(collapsed, value, copies).first()["modulo_removido"]
    if removed > tolerance:
        raise ValueLost(f"exact duplicates carry value: {removed}")
    return collapsed.drop(copies)


def consolidate_subrows(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column | str],
    count_name: str = "qt_linhas_origem",
    dtype: str = "decimal(20,2)",
) -> DataFrame:
    """One row per key: parts added up, and how many source rows they came from.

    NULL parts are ignored; a key with no readable part at all keeps a NULL total.
    """
    totals = [F.sum(F.col(c) if isinstance(c, str) else c).cast(dtype).alias(name) for name, c in sums.items()]
    return df.groupBy(*keys).agg(*totals, F.count(F.lit(1)).alias(count_name))


def pivot_sum(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    value: str,
    columns: Mapping[str, str],
    flags: Sequence[str] = (),
    dtype: str = "decimal(20,2)",
) -> DataFrame:
    """Totals per key, one column per code; 0 where a code is absent. Flags are OR-ed."""
    zero = F.lit(0).cast(dtype)
    totals = [
        F.sum(F.when(F.col(code) == c, F.col(value)).otherwise(zero)).cast(dtype).alias(name) for c, name in columns.items()
    ]
    return df.groupBy(*keys).agg(*totals, *[F.bool_or(f).alias(f) for f in flags])


def rows_per_key(df: DataFrame, keys: Sequence[str], count_name: str = "linhas") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))


def grain_profile(df: DataFrame, keys: Sequence[str], by: Mapping[str, Column]) -> DataFrame:
    """Mean and largest number of rows per key, over groups of keys."""
    per_key = rows_per_key(df, keys)
    return per_key.groupBy(*[c.alias(name) for name, c in by.items()]).agg(
        F.avg("linhas").alias("media_linhas_por_chave"), F.max("linhas").alias("max_linhas_por_chave")
    )


def first_grain_break(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """First time at which some key has more than one row; NULL if there is none."""
    return rows_per_key(df, keys).filter("linhas > 1").agg(F.min(time).alias("primeira_quebra"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key, as one number."""
    extra = rows_per_key(df, keys).agg(F.sum(F.col("linhas") - 1).alias("duplicadas"))
    return extra.select(F.coalesce("duplicadas", F.lit(0)).alias("duplicadas"))


class DuplicateKey(ValueError):
    """A declared key is not unique."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    extra = duplicate_keys(df, keys).first()["duplicadas"]
    if extra:
        raise DuplicateKey(f"{table}: {extra} duplicate rows for key {list(keys)}")
