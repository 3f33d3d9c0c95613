"""Joins on shared keys: spine, reconciliation, orphans, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import band, count_where
from tidemark.operators.cleanse import union_all

BAND_EDGES = (0.001, 0.01, 0.05)
BAND_LABELS = ("ATE_0,1%", "ATE_1%", "ATE_5%", "ACIMA_5%")


def spine_join(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]],
    keys: Sequence[str],
    presence: str = "fl_tem_{}",
) -> DataFrame:
    """Every key of any source, with the measures of all of them.

    The same rows as a union of keys left-joined to each source, got from one shuffle: the
    sources are stacked into a common layout and grouped once. Each source has one row per
    key; missing amounts are 0, missing flags false, and a presence flag tells them apart.
    """
    types: dict[str, T.DataType] = {}
    for df, measures in sources.values():
        for m in measures:
            if m in types:
                raise ValueError(f"measure {m!r} comes from two sources")
            types[m] = df.schema[m].dataType
    stacked = union_all([
        df.select(
            *keys,
            F.lit(name).alias("__fonte"),
            *[(F.col(m) if m in measures else F.lit(None).cast(t)).alias(m) for m, t in types.items()],
        )
        for name, (df, measures) in sources.items()
    ])

    def merged(measure: str, dtype: T.DataType):
        if isinstance(dtype, T.BooleanType):
            return F.coalesce(F.bool_or(measure), F.lit(False)).alias(measure)
        return F.coalesce(F.sum(measure), F.lit(0)).cast(dtype).alias(measure)

    return stacked.groupBy(*keys).agg(
        *[merged(m, t) for m, t in types.items()],
        *[F.bool_or(F.col("__fonte") == name).alias(presence.format(name)) for name in sources],
    )


def reconcile(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    value: str,
    bands: Sequence[float] = BAND_EDGES,
    labels: Sequence[str] = BAND_LABELS,
    floor: float = 1,
) -> DataFrame:
    """Two sources of one amount, key by key: difference, relative difference and its band.

    Filter both inputs before the call; after a full outer join a filter on the merged key no
    longer reaches the scans. Keys only one source has are kept as SO_FONTE_A / SO_FONTE_B.
    """
    left = a.select(*keys, F.col(value).alias("vl_fonte_a"))
    right = b.select(*keys, F.col(value).alias("vl_fonte_b"))
    seen_a, seen_b = F.coalesce("vl_fonte_a", F.lit(0)), F.coalesce("vl_fonte_b", F.lit(0))
    joined = left.join(right, list(keys), "full_outer").withColumn("vl_diferenca", seen_a - seen_b)
    # decimal division, so that the fraction is rounded to six places before it is banded
    over = F.greatest(F.abs(seen_a), F.lit(floor)).cast("decimal(20,2)")
    relative = (F.abs(F.col("vl_diferenca")).cast("decimal(32,2)") / over).cast("decimal(38,6)")
    one_sided = F.when(F.col("vl_fonte_b").isNull(), "SO_FONTE_A").when(F.col("vl_fonte_a").isNull(), "SO_FONTE_B")
    return joined.withColumn("pc_diferenca", relative).withColumn(
        "classe_conciliacao", F.coalesce(one_sided, band("pc_diferenca", bands, labels))
    )


def reconcile_summary(reconciled: DataFrame, by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Rows and percentage per band, the percentage rounded before anyone adds bands up."""
    counts = reconciled.groupBy(*by, "classe_conciliacao").agg(F.count(F.lit(1)).alias("linhas"))
    # the window sees one row per band, not the rows behind it
    total = F.sum("linhas").over(Window.partitionBy(*by))
    return counts.withColumn("pct", F.round(100 * F.col("linhas") / total, digits))


def percent_reconciled(reconciled: DataFrame, by: Sequence[str], within: Sequence[str] = BAND_LABELS[:2], at_least: float = 90) -> DataFrame:
    """Per group, the percentage of keys inside the accepted bands and its status."""
    summary = reconcile_summary(reconciled, by)
    inside = F.sum(F.when(F.col("classe_conciliacao").isin(list(within)), F.col("pct")).otherwise(F.lit(0.0)))
    graded = summary.groupBy(*by).agg(inside.alias("pct_conciliado"))
    return graded.withColumn("status", F.when(F.col("pct_conciliado") >= at_least, "OK").otherwise("ALERTA"))


def orphan_keys(df: DataFrame, dimension: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Distinct keys the dimension lacks. Deduplicated before the join, so no key is hot in it."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*names).distinct().join(dimension.select(*names), names, "left_anti")


def orphan_rows(df: DataFrame, dimension: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows whose key the dimension lacks, as one number."""
    names = [keys] if isinstance(keys, str) else list(keys)
    per_key = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    lost = per_key.join(dimension.select(*names), names, "left_anti").agg(F.sum("__n").alias("orfaos"))
    return lost.select(F.coalesce("orfaos", F.lit(0)).alias("orfaos"))


def coverage_gap(flow: DataFrame, stock: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Flow rows with no stock at the same key: how many, worth how much."""
    bare = flow.join(stock.select(*keys), list(keys), "left_anti")
    return bare.agg(F.count(F.lit(1)).alias("sem_estoque"), F.coalesce(F.sum(value), F.lit(0)).alias("valor_sem_estoque"))


def conservation(before: DataFrame, after: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """Per measure ``{after column: before column}``, both totals and their exact difference."""

    def totals(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
        sums = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,2)").alias(f"m{i}") for i, c in enumerate(columns)])
        rows = [F.struct(F.lit(m).alias("metrica"), F.col(f"m{i}").alias(side)) for i, m in enumerate(measures)]
        return sums.select(F.inline(F.array(*rows)))

    joined = totals(before, list(measures.values()), "antes").join(totals(after, list(measures), "depois"), "metrica")
    gap = F.col("depois") - F.col("antes")
    return joined.withColumn("diferenca", gap).withColumn("status", F.when(gap == 0, "OK").otherwise("FALHA"))


def coverage_by_flag(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How many rows each presence flag marks."""
    return df.agg(*[count_where(F.col(f)).alias(f) for f in flags])
