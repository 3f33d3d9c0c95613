"""Shares, concentration, rates and series tests."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio, ratio_of_sums
from tidemark.operators.ranking import topk_per_group
from tidemark.operators.temporal import pct_change, trailing_mean


def share_of_total(df: DataFrame, by: Sequence[str], value: str, out: str = "participacao", positive_only: bool = True) -> DataFrame:
    """Each row's part of its group's total, in doubles.

    The totals are aggregated and joined back, not windowed: a group may hold a large part of
    the table, and a window would gather it in one task.
    """
    kept = df.filter(F.col(value) > 0) if positive_only else df
    totals = kept.groupBy(*by).agg(F.sum(value).alias("__total"))
    return kept.join(totals, list(by)).withColumn(out, ratio(F.col(value), F.col("__total"))).drop("__total")


def _concentration_parts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Count, total and sum of squares of the positive values per group."""
    v = F.col(value)
    return df.filter(v > 0).groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(v).cast("double").alias("__total"), F.sum(v * v).cast("double").alias("__squares")
    )


def _index() -> Column:
    return F.col("__squares") / (F.col("__total") * F.col("__total")) * 10000


def _top_total(df: DataFrame, by: Sequence[str], entity: str, value: str, k: int) -> DataFrame:
    top = topk_per_group(df.filter(F.col(value) > 0), by, value, k, [entity])
    return top.groupBy(*by).agg(F.sum(value).cast("double").alias("__top"))


def hhi(df: DataFrame, by: Sequence[str], value: str, out: str = "hhi", units: str = "n_unidades") -> DataFrame:
    """Sum of squared percentage shares of the positive values, and how many there are.

    Worked out as squares over squared total, one aggregate: no share per row is needed. With
    DECIMAL values the squares add up exactly, so the order of addition does not show.
    """
    return _concentration_parts(df, by, value).select(*by, F.col("__n").alias(units), _index().alias(out))


def topk_share(
    df: DataFrame, by: Sequence[str], entity: str, value: str, k: int = 5, out: str = "participacao_top"
) -> DataFrame:
    """Part of the total that the ``k`` greatest entities of each group hold."""
    whole = _concentration_parts(df, by, value).select(*by, "__total")
    return _top_total(df, by, entity, value, k).join(whole, list(by)).select(*by, (F.col("__top") / F.col("__total")).alias(out))


def concentration(
    df: DataFrame, by: Sequence[str], entity: str, value: str, k: int = 5, share: str = "participacao_top_pct"
) -> DataFrame:
    """Entities, top-k share in percent and HHI per group. ``df`` has one row per group and entity.

    Two aggregates over the same grouped rows, which Spark computes once and reads twice.
    """
    joined = _concentration_parts(df, by, value).join(_top_total(df, by, entity, value, k), list(by))
    return joined.select(
        *by, F.col("__n").alias("n_unidades"), (100 * (F.col("__top") / F.col("__total"))).alias(share), _index().alias("hhi")
    )


def flow_to_stock_rate(
    flow: DataFrame,
    stock: DataFrame,
    by: Sequence[str],
    period: str,
    month: str,
    flow_col: str,
    stock_col: str,
) -> DataFrame:
    """Flow of a period over the mean of its monthly stocks, in percent.

    Both sides are totalled per month before they meet: the stock must not be repeated per flow
    row, and is averaged over months, never added up. Months only one side has do not count.
    """
    monthly_flow = flow.groupBy(period, *by, month).agg(F.sum(flow_col).alias("__flow"))
    monthly_stock = stock.groupBy(*by, month).agg(F.sum(stock_col).alias("__stock"))
    met = monthly_flow.join(monthly_stock, [*by, month])
    total, mean = F.sum("__flow").cast("double"), F.sum("__stock").cast("double") / F.count("__stock")
    return met.groupBy(period, *by).agg(
        F.sum("__flow").alias("fluxo"), mean.alias("estoque_medio"), F.try_divide(100 * total, mean).alias("taxa_pct")
    )


def continuity_test(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    value: str,
    break_at: Any,
    hist_from: Any,
    hist_to: Any,
    q: float = 0.9,
) -> DataFrame:
    """Does the change at a known break stay within the usual changes of the series?

    One row per series: the absolute change at ``break_at`` against quantile ``q`` of the
    absolute changes of the history window. Takes one row per series and time.
    """
    changes = pct_change(df, series, time, value, "__c").withColumn("__abs", F.abs("__c"))
    day = lambda d: F.lit(d).cast("date")
    in_history = F.col(time).between(day(hist_from), day(hist_to))
    tested = changes.groupBy(*series).agg(
        F.max(F.when(F.col(time) == day(break_at), F.col("__abs"))).alias("variacao_abs"),
        F.percentile_approx(F.when(in_history, F.col("__abs")), q).alias("limite"),
    )
    return tested.withColumn("status", F.when(F.col("variacao_abs") <= F.col("limite"), "OK").otherwise("ALERTA"))


def symmetry_test(df: DataFrame, period: Column, inflow: str, outflow: str, name: str = "ano", digits: int = 2) -> DataFrame:
    """Difference of the two directions per period, in percent of the outflow, rounded before anyone judges it."""
    yearly = df.groupBy(period.alias(name)).agg(F.sum(inflow).alias("entrada"), F.sum(outflow).alias("saida"))
    gap = (F.col("entrada") - F.col("saida")).cast("double")
    return yearly.withColumn("dif_pct", F.round(F.try_divide(100 * gap, F.col("saida").cast("double")), digits))


def worst_asymmetry(symmetry: DataFrame, periods: Column, limit: float = 15) -> DataFrame:
    worst = symmetry.filter(periods).agg(F.max(F.abs("dif_pct")).alias("maior_dif_pct"))
    return worst.withColumn("status", F.when(F.col("maior_dif_pct") < limit, "OK").otherwise("ALERTA"))


def outliers(
    df: DataFrame, by: Sequence[str], order: str, value: str, n: int = 12, k: float = 5, min_value: float = 0
) -> DataFrame:
    """Rows above ``k`` times the mean of the ``n`` rows before them, and above a floor.

    Filter the period before the call: the trailing mean starts with the rows it is given.
    """
    scored = trailing_mean(df, by, order, value, n, "media_anterior")
    v, mean = F.col(value).cast("double"), F.col("media_anterior")
    hit = scored.filter((mean > 0) & (v > k * mean) & (v > min_value))
    return hit.withColumn("multiplo", v / mean)


def value_distribution(df: DataFrame, code: str, value: str) -> DataFrame:
    """Rows and total per code."""
    return df.groupBy(code).agg(F.count(F.lit(1)).alias("linhas"), F.sum(value).alias("valor_total"))


def implausible_average(quantity: Column, value: Column, limit: float) -> Column:
    """Value per unit below the limit; FALSE for no units, NULL when the quantity is unknown."""
    return (quantity > 0) & (F.try_divide(value.cast("double"), quantity.cast("double")) < limit)


def group_changes(df: DataFrame, entity: str, group: str) -> DataFrame:
    """Entities whose group changed, with the groups they had.

    Pairs are made distinct first. A history of one group per month bounds the list by its months.
    """
    pairs = df.select(entity, group).distinct()
    return (
        pairs.groupBy(entity)
        .agg(F.count(group).alias("n_grupos"), F.sort_array(F.collect_list(group)).alias("grupos"))
        .filter("n_grupos > 1")
    )


__all__ = [
    "concentration",
    "continuity_test",
    "flow_to_stock_rate",
    "group_changes",
    "hhi",
    "implausible_average",
    "outliers",
    "ratio_of_sums",
    "share_of_total",
    "symmetry_test",
    "topk_share",
    "value_distribution",
    "worst_asymmetry",
]
