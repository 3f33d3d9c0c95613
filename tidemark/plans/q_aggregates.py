"""A: aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, percent_where, ratio_of_sums, sum_where
from tidemark.operators.catalog import profile_columns
from tidemark.operators.dedup import consolidate_subrows, duplicate_keys, first_grain_break, grain_profile, pivot_sum
from tidemark.operators.metrics import flow_to_stock_rate, hhi, topk_share, value_distribution
from tidemark.operators.temporal import pct_change
from tidemark.plans import analyses as an
from tidemark.operators.ranking import first_values
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query


@query(f"""WITH {r.LINES} SELECT tipo, cod_produto, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS soma, CAST(MIN(valor) AS DOUBLE) AS menor,
  CAST(MAX(valor) AS DOUBLE) AS maior, CAST(SUM(valor) AS DOUBLE) / COUNT(*) AS media FROM lines GROUP BY ALL""")
def a1_group_stats(t: Tables) -> DataFrame:
    total = F.sum("valor").cast("double")
    return r.lines(t).groupBy("tipo", "cod_produto").agg(
        r.rows(),
        total.alias("soma"),
        F.min("valor").cast("double").alias("menor"),
        F.max("valor").cast("double").alias("maior"),
        (total / F.count("valor")).alias("media"),
    )


@query(f"WITH {r.LINES} SELECT COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS soma, CAST(SUM(quantidade) AS BIGINT) AS unidades FROM lines")
def a2_global(t: Tables) -> DataFrame:
    return r.lines(t).agg(r.rows(), F.sum("valor").cast("double").alias("soma"), F.sum("quantidade").alias("unidades"))


@query(f"""WITH {r.LINES} SELECT COUNT(*) FILTER (WHERE tipo = 'A') AS a, COUNT(*) FILTER (WHERE desconto > 0.05) AS descontadas,
  COUNT(*) FILTER (WHERE valor < 5000) AS pequenas FROM lines""")
def a3_conditional_count(t: Tables) -> DataFrame:
    conditions = {"a": F.col("tipo") == "A", "descontadas": F.col("desconto") > 0.05, "pequenas": F.col("valor") < 5000}
    return r.lines(t).agg(*[count_where(c).alias(n) for n, c in conditions.items()])


@query(f"""WITH {r.TRANSFERS} SELECT cod_empresa, strftime(mes_ref, '%Y%m') AS ano_mes, cod_produto,
  CAST(SUM(CASE WHEN direcao = 'ACEITA' THEN valor ELSE 0 END) AS DOUBLE) AS vl_portab_aceita,
  CAST(SUM(CASE WHEN direcao = 'CEDIDA' THEN valor ELSE 0 END) AS DOUBLE) AS vl_portab_cedida,
  bool_or(valor > 400000) AS fl_grande
FROM transfers WHERE cod_produto IS NOT NULL AND direcao IS NOT NULL GROUP BY cod_empresa, mes_ref, cod_produto""")
def a4_pivot_sum(t: Tables) -> DataFrame:
    moves = r.transfers(t).filter(F.col("cod_produto").isNotNull() & F.col("direcao").isNotNull())
    flagged = moves.withColumn("fl_grande", F.col("valor") > 400000).withColumn("ano_mes", F.date_format("mes_ref", "yyyyMM"))
    columns = {"ACEITA": "vl_portab_aceita", "CEDIDA": "vl_portab_cedida"}
    out = pivot_sum(flagged, ["cod_empresa", "ano_mes", "cod_produto"], "direcao", "valor", columns, ["fl_grande"])
    return r.doubles(out, *columns.values())


@query("""SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS clientes, COUNT(*) AS pedidos FROM orders GROUP BY ALL""")
def a5_distinct_count(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("clientes"), r.rows("pedidos"))


@query("SELECT COUNT(*) - COUNT(DISTINCT (o_custkey, o_orderdate)) AS duplicadas FROM orders")
def a5_duplicate_keys(t: Tables) -> DataFrame:
    return duplicate_keys(t.orders, ["o_custkey", "o_orderdate"])


@query("SELECT o_orderstatus, array_to_string(list(DISTINCT o_orderpriority ORDER BY o_orderpriority)[1:12], ',') AS prioridades FROM orders GROUP BY ALL")
def a6_distinct_set(t: Tables) -> DataFrame:
    """At most twelve values of each group, whatever the number of rows or values behind them."""
    found = first_values(t.orders, ["o_orderstatus"], "o_orderpriority", 12, "prioridades")
    return found.withColumn("prioridades", F.array_join("prioridades", ","))


@query("""SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS fl_urgente, bool_or(o_totalprice > 450000) AS fl_grande
FROM orders GROUP BY o_custkey""")
def a7_any_flag(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("fl_urgente"), F.bool_or(F.col("o_totalprice") > 450000).alias("fl_grande")
    )


@query(f"""WITH {r.FLOW}, m AS (SELECT cod_produto, mes_ref, SUM(vl_resgate) AS v FROM flow GROUP BY ALL),
c AS (SELECT cod_produto, abs(CAST(v AS DOUBLE) / CAST(LAG(v) OVER (PARTITION BY cod_produto ORDER BY mes_ref) AS DOUBLE) - 1) AS x FROM m)
SELECT cod_produto, quantile_disc(x, 0.9) AS p90 FROM c GROUP BY cod_produto""")
def a8_p90(t: Tables) -> DataFrame:
    changes = pct_change(an.monthly_totals(r.flow_rows(t), ["vl_resgate"]), ["cod_produto"], "mes_ref", "vl_resgate")
    return changes.groupBy("cod_produto").agg(F.percentile_approx(F.abs("var_pct"), 0.9).alias("p90"))


@query(f"""WITH {r.FLOW} SELECT cod_empresa, CAST(SUM(vl_resgate) AS DOUBLE) / NULLIF(CAST(SUM(vl_contribuicao) AS DOUBLE), 0) AS razao
FROM flow GROUP BY cod_empresa""")
def a9_ratio_of_sums(t: Tables) -> DataFrame:
    return r.flow_rows(t).groupBy("cod_empresa").agg(ratio_of_sums("vl_resgate", "vl_contribuicao").alias("razao"))


@query(f"""WITH {r.RAW} SELECT tipoProd AS produto, round(100 * AVG(CASE WHEN contains(contrib, ',') THEN 1 ELSE 0 END), 6) AS pct_virgula
FROM raw GROUP BY tipoProd""")
def a10_percent_true(t: Tables) -> DataFrame:
    comma = percent_where(F.col("contrib").contains(","))
    return r.raw_lines(t).groupBy(F.col("tipoProd").alias("produto")).agg(F.round(comma, 6).alias("pct_virgula"))


_GRAIN = f"""WITH {r.LINES}, k AS (SELECT cod_produto, cod_empresa, mes_ref, COUNT(*) AS n FROM lines GROUP BY ALL)"""


@query(f"""{_GRAIN} SELECT cod_produto, CAST(year(mes_ref) AS INTEGER) AS ano, round(AVG(n), 6) AS media_linhas_por_chave,
  MAX(n) AS max_linhas_por_chave FROM k GROUP BY ALL""")
def a11_two_level(t: Tables) -> DataFrame:
    by = {"cod_produto": F.col("cod_produto"), "ano": F.year("mes_ref")}
    out = grain_profile(r.lines(t), ["cod_produto", "cod_empresa", "mes_ref"], by)
    return out.withColumn("media_linhas_por_chave", F.round("media_linhas_por_chave", 6))


@query(f"{_GRAIN} SELECT CAST(MIN(mes_ref) AS VARCHAR) AS primeira_quebra FROM k WHERE n > 1")
def a12_filtered_groups(t: Tables) -> DataFrame:
    out = first_grain_break(r.lines(t), ["cod_produto", "cod_empresa", "mes_ref"], "mes_ref")
    return out.withColumn("primeira_quebra", F.col("primeira_quebra").cast("string"))


@query("SELECT o_orderstatus, o_orderpriority, COUNT(*) AS linhas, MAX(o_totalprice) AS maior FROM orders GROUP BY ALL")
def a13_group_by_all(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("tidemark_orders")
    return t.spark.sql("SELECT o_orderstatus, o_orderpriority, COUNT(*) AS linhas, MAX(o_totalprice) AS maior FROM tidemark_orders GROUP BY ALL")


@query(f"""WITH {r.LINES} SELECT cod_empresa, CAST(SUM(valor) AS DOUBLE) AS total FROM lines GROUP BY cod_empresa
HAVING SUM(valor) > 1000000 AND COUNT(*) > 500""")
def a14_having(t: Tables) -> DataFrame:
    sums = r.lines(t).groupBy("cod_empresa").agg(F.sum("valor").alias("total"), r.rows("n"))
    return r.doubles(sums.filter("total > 1000000 AND n > 500").drop("n"), "total")


@query("""SELECT l_orderkey, l_linenumber, CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,2))) AS DOUBLE) AS valor,
  CAST(SUM(CAST(l_quantity AS DECIMAL(20,2))) AS DOUBLE) AS quantidade, COUNT(*) AS qt_linhas_origem FROM lineitem GROUP BY ALL""")
def a15_consolidate(t: Tables) -> DataFrame:
    parts = {"valor": F.col("l_extendedprice").cast(r.AMOUNT), "quantidade": F.col("l_quantity").cast(r.AMOUNT)}
    return r.doubles(consolidate_subrows(t.lineitem, ["l_orderkey", "l_linenumber"], parts), *parts)


_YEARLY = f"""WITH {r.FLOW}, u AS (SELECT year(mes_ref) AS ano, cod_produto, cod_empresa, CAST(SUM(vl_contribuicao) AS DECIMAL(19,2)) AS v
  FROM flow GROUP BY ALL HAVING SUM(vl_contribuicao) > 0)"""


def _yearly(t: Tables) -> DataFrame:
    by = [F.year("mes_ref").alias("ano"), "cod_produto", "cod_empresa"]
    return r.flow_rows(t).groupBy(*by).agg(F.sum("vl_contribuicao").alias("v"))


@query(f"""{_YEARLY} SELECT CAST(ano AS INTEGER) AS ano, cod_produto, COUNT(*) AS n_unidades,
  round(CAST(SUM(v * v) AS DOUBLE) / (CAST(SUM(v) AS DOUBLE) * CAST(SUM(v) AS DOUBLE)) * 10000, 6) AS hhi FROM u GROUP BY ALL""")
def a16_hhi(t: Tables) -> DataFrame:
    return hhi(_yearly(t), ["ano", "cod_produto"], "v").withColumn("hhi", F.round("hhi", 6))


@query(f"""{_YEARLY}, s AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ano, cod_produto ORDER BY v DESC, cod_empresa) AS pos FROM u)
SELECT CAST(ano AS INTEGER) AS ano, cod_produto, round(CAST(SUM(v) FILTER (WHERE pos <= 5) AS DOUBLE) / CAST(SUM(v) AS DOUBLE), 9) AS top5
FROM s GROUP BY ALL""")
def a17_topk_share(t: Tables) -> DataFrame:
    return topk_share(_yearly(t), ["ano", "cod_produto"], "cod_empresa", "v", 5, "top5").withColumn("top5", F.round("top5", 9))


@query(f"""WITH {r.FLOW}, {r.STOCK}, f AS (SELECT mes_ref, cod_produto, SUM(vl_resgate) AS g FROM flow GROUP BY ALL)
SELECT CAST(quarter(mes_ref) AS INTEGER) AS trimestre, cod_produto, CAST(SUM(g) AS DOUBLE) AS fluxo,
  round(CAST(SUM(vl_pmbac) AS DOUBLE) / COUNT(*), 4) AS estoque_medio,
  round(100 * CAST(SUM(g) AS DOUBLE) / (CAST(SUM(vl_pmbac) AS DOUBLE) / COUNT(*)), 6) AS taxa_pct
FROM f JOIN stock USING (mes_ref, cod_produto) GROUP BY ALL""")
def a18_flow_stock(t: Tables) -> DataFrame:
    flow = r.flow_rows(t).withColumn("trimestre", F.quarter("mes_ref"))
    out = flow_to_stock_rate(flow, r.stock_rows(t), ["cod_produto"], "trimestre", "mes_ref", "vl_resgate", "vl_pmbac")
    return r.doubles(out, "fluxo").withColumns({"estoque_medio": F.round("estoque_medio", 4), "taxa_pct": F.round("taxa_pct", 6)})


def _profile_sql(table: str, ranged: dict[str, str], listed: list[str], order: list[str]) -> str:
    """Profile of a table's columns; ``ranged`` gives the text form of each range bound."""
    parts = []
    for c in order:
        low, high = (ranged[c].format(f"MIN({c})"), ranged[c].format(f"MAX({c})")) if c in ranged else ("NULL", "NULL")
        n = f"COUNT(DISTINCT {c})" if c in listed else "NULL"
        vals = f"(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {table} WHERE {c} IS NOT NULL ORDER BY v LIMIT 12))" if c in listed else "NULL"
        parts.append(
            f"SELECT '{c}' AS coluna, CAST({low} AS VARCHAR) AS minimo, CAST({high} AS VARCHAR) AS maximo, "
            f"round(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 2) AS pct_nulos, CAST({n} AS BIGINT) AS n_distintos, "
            f"CAST({vals} AS VARCHAR) AS valores FROM {table}"
        )
    return " UNION ALL ".join(parts)


_AS_IS, _AS_DAY = "CAST({} AS VARCHAR)", "strftime({}, '%Y-%m-%d')"
_ORDERS_PROFILE = _profile_sql(
    "(SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(20,2)) AS o_totalprice, o_orderdate, o_orderpriority FROM orders)",
    {"o_orderkey": _AS_IS, "o_custkey": _AS_IS, "o_totalprice": _AS_IS, "o_orderdate": _AS_DAY},
    ["o_orderstatus", "o_orderpriority"],
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
)


@query(_ORDERS_PROFILE)
def a19_profile(t: Tables) -> DataFrame:
    typed = t.orders.withColumns({"o_totalprice": F.col("o_totalprice").cast(r.AMOUNT), "o_orderdate": F.col("o_orderdate").cast("date")})
    shape = profile_columns(typed)
    return shape.select("coluna", "minimo", "maximo", "pct_nulos", "n_distintos", F.array_join("valores", ",").alias("valores"))


@query(f"""WITH {r.RAW} SELECT tipoProd, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS valor_total FROM clean GROUP BY tipoProd""")
def a20_distribution(t: Tables) -> DataFrame:
    from tidemark.functions import parse_decimal

    return r.doubles(value_distribution(r.raw_lines(t).withColumn("valor", parse_decimal("contrib")), "tipoProd", "valor"), "valor_total")


@query(f"""WITH {r.LINES} SELECT cod_produto, CAST(SUM(CASE WHEN tipo = 'A' THEN valor ELSE 0 END) AS DOUBLE) AS a,
  CAST(SUM(CASE WHEN tipo = 'R' THEN valor ELSE 0 END) AS DOUBLE) AS r FROM lines GROUP BY cod_produto""")
def a4_conditional_sum(t: Tables) -> DataFrame:
    kinds = {"a": "A", "r": "R"}
    sums = [sum_where("valor", F.col("tipo") == code).cast("double").alias(name) for name, code in kinds.items()]
    return r.lines(t).groupBy("cod_produto").agg(*sums)
