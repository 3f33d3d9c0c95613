"""Dimensions and facts of a star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import unit_code
from tidemark.operators.combine import spine_join
from tidemark.operators.temporal import latest_per_key
from tidemark.sources.generated import calendar_months

AMOUNT = "decimal(20,2)"


def calendar_attributes(months: DataFrame, last_full_year: int, ytd_month: int, month: str = "mes_ref") -> DataFrame:
    m = F.col(month)
    return months.select(
        m,
        F.date_format(m, "yyyyMM").alias("ano_mes"),
        F.year(m).alias("ano"),
        F.month(m).alias("mes"),
        F.quarter(m).alias("trimestre"),
        (F.year(m) <= last_full_year).alias("fl_ano_completo"),
        (F.month(m) <= ytd_month).alias("fl_periodo_ytd"),
    )


def dim_calendar(spark: SparkSession, start: Any, end: Any, last_full_year: int, ytd_month: int) -> DataFrame:
    """One row per month, flagged as part of a full year and of the year-to-date period."""
    return calendar_attributes(calendar_months(spark, start, end), last_full_year, ytd_month)


def dim_latest(
    history: DataFrame,
    key: str,
    attributes: Sequence[str],
    order: str,
    tie_breakers: Sequence[str],
    unknown: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Members with their most recent attributes, plus a synthetic unknown member."""
    columns = list(dict.fromkeys([key, *attributes, order, *tie_breakers]))
    members = latest_per_key(history.select(*columns), [key], order, tie_breakers).select(key, *attributes)
    if unknown is None:
        return members
    extra = members.sparkSession.range(1).select(*[F.lit(unknown[c]).alias(c) for c in [key, *attributes]])
    return members.unionByName(extra)


def economic_unit(
    df: DataFrame,
    group: str,
    entity: str,
    generic_codes: Sequence[str],
    prefix: str = "EMP_",
    unit: str = "unidade",
) -> DataFrame:
    """Add the unit an amount counts for: the group, or the entity itself under a generic group."""
    return df.withColumn(unit, unit_code(group, entity, generic_codes, prefix))


def unit_names(
    groups: DataFrame,
    entities: DataFrame,
    group: tuple[str, str],
    entity: tuple[str, str],
    generic_codes: Sequence[str],
    prefix: str = "EMP_",
    suffix: str = " (sem grupo)",
    unit: str = "unidade",
    name: str = "nome_unidade",
) -> DataFrame:
    """Name of every possible unit.

    Joined after amounts are totalled per unit, where each unit is one row per period: the generic
    group, which many entities share, is never a join key.
    """
    real = groups.filter(~F.col(group[0]).isin(list(generic_codes)))
    own = entities.select(
        F.concat(F.lit(prefix), F.col(entity[0])).alias(unit), F.concat(F.col(entity[1]), F.lit(suffix)).alias(name)
    )
    return real.select(F.col(group[0]).alias(unit), F.col(group[1]).alias(name)).unionByName(own)


def flow_fact(
    sources: Mapping[str, tuple[DataFrame, Sequence[str]]],
    keys: Sequence[str],
    bridge: DataFrame,
    bridge_keys: Sequence[str],
    derived: Mapping[str, Column],
    period: Column | None = None,
    dtype: str = AMOUNT,
) -> DataFrame:
    """Flows of all sources on one grain, with derived amounts and the group in force.

    The period is cut from each source before they meet, so it reaches the scans.
    """
    if period is not None:
        sources = {name: (df.filter(period), measures) for name, (df, measures) in sources.items()}
    spine = spine_join(sources, keys)
    amounts = {n: c.cast(dtype) for n, c in derived.items()}
    return spine.withColumns(amounts).join(bridge, list(bridge_keys)) if amounts else spine.join(bridge, list(bridge_keys))


def stock_fact(
    stock: DataFrame, bridge: DataFrame, bridge_keys: Sequence[str], columns: Sequence[str], period: Column | None = None
) -> DataFrame:
    """Month-end balances with the group in force. Add them up across entities, never over months."""
    kept = stock if period is None else stock.filter(period)
    return kept.join(bridge, list(bridge_keys)).select(*columns)


def primary_key_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows beyond the first of their key, one row per table."""
    from tidemark.operators.cleanse import union_all
    from tidemark.operators.dedup import duplicate_keys

    return union_all([duplicate_keys(df, keys).select(F.lit(t).alias("tabela"), "duplicadas") for t, (df, keys) in tables.items()])


def _known_values(references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """The keys of all parents ``{reference: (parent, parent column)}``, stacked, as text."""
    from tidemark.operators.cleanse import union_all

    stacked = [parent.select(F.lit(name).alias("__ref"), F.col(target).cast("string").alias("__value")) for name, (parent, target) in references.items()]
    return union_all(stacked).distinct().withColumn("__known", F.lit(True))


def orphan_report(child: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows of one table without a parent, for all its references ``{name: (column, parent, parent column)}``, from one scan.

    The table's distinct (reference, value) pairs, counted before they are shuffled, meet the stacked keys of all parents in
    one join. A NULL has no parent. One row for each reference, 0 included.
    """
    cells = [F.struct(F.lit(name).alias("__ref"), F.col(c).cast("string").alias("__value")) for name, (c, _, _) in references.items()]
    pairs = child.select(F.inline(F.array(*cells))).groupBy("__ref", "__value").agg(F.count(F.lit(1)).alias("__n"))
    met = pairs.join(_known_values({n: (parent, target) for n, (_, parent, target) in references.items()}), ["__ref", "__value"], "left")
    lost = [F.coalesce(F.sum(F.when((F.col("__ref") == n) & F.col("__known").isNull(), F.col("__n"))), F.lit(0)).alias(f"o{i}") for i, n in enumerate(references)]
    rows = [F.struct(F.lit(n).alias("referencia"), F.col(f"o{i}").alias("orfaos")) for i, n in enumerate(references)]
    return met.agg(*lost).select(F.inline(F.array(*rows)))


def foreign_key_report(references: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows without a parent, one row per reference ``{name: (child, column, parent, parent column)}``; each child frame is scanned once."""
    from tidemark.operators.cleanse import union_all

    children: dict[int, tuple[DataFrame, dict[str, tuple[str, DataFrame, str]]]] = {}
    for name, (child, column, parent, target) in references.items():
        children.setdefault(id(child), (child, {}))[1][name] = (column, parent, target)
    return union_all([orphan_report(child, own) for child, own in children.values()])


def table_audit(
    df: DataFrame, keys: Sequence[str], references: Mapping[str, tuple[DataFrame, str]] | None = None, measures: Sequence[str] = ()
) -> DataFrame:
    """One row about a table from one scan of it: ``duplicadas``, ``orfaos_<column>`` and ``total_<measure>``.

    Rows are grouped by the key, by each reference ``{column: (parent, parent column)}`` and as a whole in one pass, over grouping
    sets. Groups of the key are then only counted, so what meets the parents' keys is small.
    """
    references = references or {}
    columns = list(dict.fromkeys([*keys, *references]))
    sets = [list(keys), *[[c] for c in references if [c] != list(keys)], []]
    number = {tuple(s): sum((c not in s) << (len(columns) - 1 - i) for i, c in enumerate(columns)) for s in sets}
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n"), *[F.sum(m).cast("decimal(38,2)").alias(f"__t{i}") for i, m in enumerate(measures)]
    )
    of = lambda *s: F.col("__set") == number[tuple(s)]
    ref, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in references:
        ref, value = F.when(of(c), F.lit(c)).otherwise(ref), F.when(of(c), F.col(c).cast("string")).otherwise(value)
    slim = grouped.groupBy("__set", ref.alias("__ref"), value.alias("__value")).agg(
        F.sum("__n").alias("__n"), F.sum(F.col("__n") - 1).alias("__extra"), *[F.max(f"__t{i}").alias(f"__t{i}") for i in range(len(measures))]
    )
    met = slim.join(_known_values(references), ["__ref", "__value"], "left") if references else slim
    total = lambda x, cond: F.coalesce(F.sum(F.when(cond, F.col(x))), F.lit(0))
    out = [total("__extra", of(*keys)).alias("duplicadas")]
    out += [total("__n", of(c) & F.col("__known").isNull()).alias(f"orfaos_{c}") for c in references]
    out += [F.coalesce(F.max(F.when(of(), F.col(f"__t{i}"))), F.lit(0)).cast("decimal(38,2)").alias(f"total_{m}") for i, m in enumerate(measures)]
    return met.agg(*out)
