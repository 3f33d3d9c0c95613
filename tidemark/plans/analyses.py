"""Business questions over a star of flows and stocks.

Every function takes frames with the contract's column names (mes_ref, cod_empresa, cod_produto,
cod_grupo, vl_*) and returns amounts in ``Money`` units.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio, ratio_of_sums
from tidemark.operators.metrics import concentration, flow_to_stock_rate, share_of_total
from tidemark.operators.period import ALWAYS, YEAR, Period, during, on_calendar
from tidemark.operators.ranking import (
    rank_shift,
    rank_shift_summary,
    top_rows,
    topk_by_magnitude,
    topk_entities_history,
    topk_per_group,
)
from tidemark.operators.star import economic_unit
from tidemark.operators.temporal import moving_mean
from tidemark.session import stage

# Codes that stand for no real group.
GENERIC_GROUPS = ("99999", "NAO_INFORMADO")

FLOW_AMOUNTS = (
    "vl_contribuicao",
    "vl_resgate",
    "vl_flcr",
    "vl_portab_aceita",
    "vl_portab_cedida",
    "vl_portab_liquida",
    "vl_captacao_liquida",
)


@dataclass(frozen=True)
class Money:
    """Unit, rounding and name suffix of reported amounts."""

    unit: float = 1e9
    digits: int = 2
    suffix: str = "_bi"

    def col(self, amount: Column | str, name: str) -> Column:
        c = F.col(amount) if isinstance(amount, str) else amount
        return F.round(c.cast("double") / F.lit(self.unit), self.digits).alias(name + self.suffix)


def monthly_totals(flow: DataFrame, measures: Sequence[str], by: Sequence[str] = ("cod_produto",)) -> DataFrame:
    """Totals per month: a handful of rows, whatever the size of the fact, for what follows to work on."""
    stored_by = [YEAR] if YEAR in flow.columns else []
    return flow.groupBy("mes_ref", *stored_by, *by).agg(*[F.sum(m).alias(m) for m in measures])


def annual_flow(flow: DataFrame, calendar: DataFrame, money: Money = Money(), ratio_digits: int = 3) -> DataFrame:
    """Contributions, redemptions and net flow per full year and product."""
    monthly = monthly_totals(flow, ["vl_contribuicao", "vl_resgate"])
    years = on_calendar(monthly, calendar.filter("fl_ano_completo").select("mes_ref", "ano"))
    paid, drawn = F.sum("vl_contribuicao"), F.sum("vl_resgate")
    return years.groupBy("ano", "cod_produto").agg(
        money.col(paid, "contribuicoes"),
        money.col(drawn, "resgates"),
        money.col(paid - drawn, "flcr"),
        F.round(ratio_of_sums("vl_resgate", "vl_contribuicao"), ratio_digits).alias("resgate_por_real_contribuido"),
    )


def ytd_flow(flow: DataFrame, calendar: DataFrame, first_year: int, money: Money = Money()) -> DataFrame:
    """The same for the months every year has, from ``first_year`` on."""
    monthly = monthly_totals(during(flow, Period.months(f"{first_year}-01")), ["vl_contribuicao", "vl_resgate"])
    months = calendar.filter("fl_periodo_ytd").filter(F.col("ano") >= first_year).select("mes_ref", "ano")
    paid, drawn = F.sum("vl_contribuicao"), F.sum("vl_resgate")
    return (
        on_calendar(monthly, months)
        .groupBy("ano", "cod_produto")
        .agg(money.col(paid, "contribuicoes_jan_jul"), money.col(drawn, "resgates_jan_jul"), money.col(paid - drawn, "flcr_jan_jul"))
    )


def monthly_flow(flow: DataFrame, start: str, n: int = 3, money: Money = Money()) -> DataFrame:
    """Monthly series with its moving mean; the period is cut first, so early means cover fewer months."""
    monthly = monthly_totals(during(flow, Period.months(start)), ["vl_contribuicao", "vl_resgate"])
    monthly = monthly.withColumn("vl_flcr", F.col("vl_contribuicao") - F.col("vl_resgate"))
    smoothed = moving_mean(monthly, ["cod_produto"], "mes_ref", "vl_flcr", n, "__mm")
    return smoothed.select(
        "mes_ref",
        "cod_produto",
        money.col("vl_contribuicao", "contribuicoes"),
        money.col("vl_resgate", "resgates"),
        money.col("vl_flcr", "flcr"),
        money.col("__mm", f"flcr_mm{n}"),
    )


def redemption_rate(
    flow: DataFrame, stock: DataFrame, calendar: DataFrame, first_ytd_year: int, money: Money = Money(), rate_digits: int = 2
) -> DataFrame:
    """Redemptions over mean stock, per full year and for the months every year has; the latter not annualised."""
    drawn = monthly_totals(flow, ["vl_resgate"])
    bases = {
        "ANO_COMPLETO": F.col("fl_ano_completo"),
        "JAN_JUL": F.col("fl_periodo_ytd") & (F.col("ano") >= first_ytd_year),
    }
    labels = F.filter(F.array(*[F.when(cond, F.lit(b)) for b, cond in bases.items()]), lambda x: x.isNotNull())
    months = calendar.select("mes_ref", "ano", F.explode(labels).alias("base"))  # a month can count in both bases
    held = on_calendar(monthly_totals(stock, ["vl_pmbac"]), months.select("mes_ref").distinct()).drop(YEAR)
    dated = on_calendar(drawn, months).drop(YEAR).withColumn("periodo", F.struct("base", "ano"))
    rate = flow_to_stock_rate(dated, held, ["cod_produto"], "periodo", "mes_ref", "vl_resgate", "vl_pmbac")
    return rate.select(
        "periodo.ano",
        "cod_produto",
        "periodo.base",
        money.col("fluxo", "resgates"),
        money.col("estoque_medio", "pmbac_media"),
        F.round("taxa_pct", rate_digits).alias("taxa_resgate_pct"),
    )


def unit_contributions(
    flow: DataFrame, calendar: DataFrame, generic_codes: Sequence[str] = GENERIC_GROUPS, period: Period = ALWAYS
) -> DataFrame:
    """Contributions per full year, product and economic unit."""
    months = calendar.filter("fl_ano_completo").select("mes_ref", "ano")
    units = economic_unit(on_calendar(during(flow, period), months), "cod_grupo", "cod_empresa", generic_codes)
    return units.groupBy("ano", "cod_produto", "unidade").agg(F.sum("vl_contribuicao").alias("contrib"))


def contribution_concentration(units: DataFrame, k: int = 5, share_digits: int = 1, hhi_digits: int = 0) -> DataFrame:
    """Number of units, share of the ``k`` greatest and HHI per year and product."""
    found = concentration(units, ["ano", "cod_produto"], "unidade", "contrib", k, "share")
    return found.select(
        "ano",
        "cod_produto",
        "n_unidades",
        F.round("share", share_digits).alias(f"share_top{k}_pct"),
        F.round("hhi", hhi_digits).alias("hhi"),
    )


def top_units(
    units: DataFrame, names: DataFrame, years: Sequence[int], k: int = 5, money: Money = Money(), share_digits: int = 1
) -> DataFrame:
    """The ``k`` greatest units of chosen years, with value and share."""
    by = ["ano", "cod_produto"]
    shared = share_of_total(units.filter(F.col("ano").isin(list(years))), by, "contrib", "__s")
    top = topk_per_group(shared, by, "contrib", k, ["unidade"])
    return top.join(names, "unidade").select(
        *by,
        "pos",
        "unidade",
        "nome_unidade",
        money.col("contrib", "contribuicoes"),
        F.round(100 * F.col("__s"), share_digits).alias("participacao_pct"),
    )


def labelled_flows(
    flow: DataFrame, calendar: DataFrame, generic_codes: Sequence[str] = GENERIC_GROUPS, period: Period = ALWAYS
) -> DataFrame:
    """Fact rows with their unit and the labels of the periods they count in (NULL when in none)."""
    year = F.col("ano").cast("string")
    periods = calendar.select(
        "mes_ref",
        F.when(F.col("fl_ano_completo"), year).alias("periodo_ano"),
        F.when(F.col("fl_periodo_ytd"), F.concat(year, F.lit("_JAN_JUL"))).alias("periodo_ytd"),
    )
    return economic_unit(on_calendar(during(flow, period), periods), "cod_grupo", "cod_empresa", generic_codes)


def unit_totals(labelled: DataFrame, by: Sequence[str] = ("periodo_ano", "unidade")) -> DataFrame:
    return labelled.groupBy(*by).agg(*[F.sum(m).alias(m) for m in FLOW_AMOUNTS])


def market_balance(labelled: DataFrame, money: Money = Money()) -> DataFrame:
    """Portability in, out and net over the whole market, per full year."""
    yearly = unit_totals(labelled.filter(F.col("periodo_ano").isNotNull()), ["periodo_ano"])
    return yearly.select(
        F.col("periodo_ano").alias("ano"),
        money.col("vl_portab_aceita", "aceita"),
        money.col("vl_portab_cedida", "cedida"),
        money.col("vl_portab_liquida", "saldo_liquido_mercado"),
    )


def unit_balance(
    labelled: DataFrame, names: DataFrame, year: str, money: Money = Money(), pct_digits: int = 1
) -> DataFrame:
    """Net portability per unit and against its contributions; only units that ported anything."""
    totals = unit_totals(labelled.filter(F.col("periodo_ano") == year), ["unidade"])
    ported = totals.filter(F.col("vl_portab_aceita") + F.col("vl_portab_cedida") > 0)
    pct = 100 * ratio(F.col("vl_portab_liquida"), F.col("vl_contribuicao"))
    return ported.join(names, "unidade").select(
        "nome_unidade",
        "unidade",
        money.col("vl_portab_aceita", "aceita"),
        money.col("vl_portab_cedida", "cedida"),
        money.col("vl_portab_liquida", "saldo_liquido_portab"),
        money.col("vl_contribuicao", "contribuicoes"),
        F.round(pct, pct_digits).alias("saldo_portab_pct_contrib"),
    )


def greatest_balances(balance: DataFrame, money: Money = Money(), k: int = 15) -> DataFrame:
    return topk_by_magnitude(balance, f"saldo_liquido_portab{money.suffix}", k, ["unidade"])


def leaders_history(
    labelled: DataFrame,
    names: DataFrame,
    chosen: tuple[str, str],
    shown: tuple[str, str],
    k: int = 8,
    money: Money = Money(),
) -> DataFrame:
    """Yearly net portability of the units that ported most over the chosen years."""
    totals = stage(
        labelled.filter(F.col("periodo_ano").isNotNull())
        .groupBy("periodo_ano", "unidade")
        .agg(*[F.sum(m).alias(m) for m in ("vl_portab_aceita", "vl_portab_cedida", "vl_portab_liquida")]),
        "unit-year",
    )
    volume = F.col("vl_portab_aceita") + F.col("vl_portab_cedida")
    year = F.col("periodo_ano")
    kept = topk_entities_history(totals, "unidade", volume, k, year.between(*chosen), year.between(*shown))
    return kept.join(names, "unidade").select(
        year.alias("ano"), "unidade", "nome_unidade", money.col("vl_portab_liquida", "saldo_liquido_portab")
    )


def _ranked_units(labelled: DataFrame, year: str) -> DataFrame:
    totals = unit_totals(labelled.filter(F.col("periodo_ano") == year), ["unidade"]).filter("vl_contribuicao > 0")
    slim = stage(totals.select("unidade", "vl_flcr", "vl_portab_liquida", "vl_captacao_liquida"), "unit-rank")
    return rank_shift(slim, ["unidade"], "vl_flcr", "vl_captacao_liquida", "posicao_flcr", "posicao_captacao")


def rank_change(labelled: DataFrame, names: DataFrame, year: str, money: Money = Money()) -> DataFrame:
    """Position of each unit by own flow and by flow including portability."""
    return (
        _ranked_units(labelled, year)
        .join(names, "unidade")
        .select(
            "unidade",
            "nome_unidade",
            money.col("vl_flcr", "flcr"),
            money.col("vl_portab_liquida", "saldo_portab"),
            money.col("vl_captacao_liquida", "captacao_liquida"),
            "posicao_flcr",
            "posicao_captacao",
            "variacao_posicao",
            "muda_de_sinal",
        )
    )


def rank_leaders(changes: DataFrame, k: int = 12) -> DataFrame:
    """First positions by the wider measure."""
    return top_rows(changes, [F.asc("posicao_captacao"), F.asc("unidade")], k)


def rank_change_summary(labelled: DataFrame, year: str) -> DataFrame:
    return rank_shift_summary(_ranked_units(labelled, year))


def recent_rows(fact: DataFrame, k: int = 20) -> DataFrame:
    """Latest month first, then the greatest contribution."""
    order = [F.desc("mes_ref"), F.desc("vl_contribuicao"), F.asc("cod_empresa"), F.asc("cod_produto")]
    return top_rows(fact, order, k)
