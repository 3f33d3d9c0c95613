"""J: joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import zero_fill
from tidemark.operators.combine import orphan_keys, spine_join
from tidemark.operators.temporal import asof_join
from tidemark.plans import analyses as an
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query
from tidemark.session import stage

KEYS = ["cod_empresa", "mes_ref", "cod_produto"]


def _month(df: DataFrame) -> DataFrame:
    return df.withColumn("ano_mes", F.date_format("mes_ref", "yyyyMM")).drop("mes_ref")


@query("""SELECT n_name, r_name, COUNT(*) AS pedidos, CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def j1_inner(t: Tables) -> DataFrame:
    # orders are totalled per customer before they meet anything
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        r.rows("n"), F.sum(F.col("o_totalprice").cast(r.AMOUNT)).alias("v")
    )
    per_nation = (
        spent.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey")
        .groupBy("n_nationkey")
        .agg(F.sum("n").alias("pedidos"), F.sum("v").cast("double").alias("total"))
    )
    regions = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return per_nation.join(t.nation, "n_nationkey").join(regions, "n_regionkey").select("n_name", "r_name", "pedidos", "total")


def _kinds(lines: DataFrame) -> dict[str, DataFrame]:
    named = {"A": "vl_contribuicao", "R": "vl_resgate", "N": "vl_portabilidade"}
    return {k: lines.filter(F.col("tipo") == k).groupBy(*KEYS).agg(F.sum("valor").cast(r.AMOUNT).alias(v)) for k, v in named.items()}


_CHAIN = f"""WITH {r.LINES} SELECT cod_empresa, strftime(mes_ref, '%Y%m') AS ano_mes, cod_produto,
  CAST(COALESCE(SUM(valor) FILTER (WHERE tipo = 'A'), 0) AS DOUBLE) AS vl_contribuicao,
  CAST(COALESCE(SUM(valor) FILTER (WHERE tipo = 'R'), 0) AS DOUBLE) AS vl_resgate,
  CAST(COALESCE(SUM(valor) FILTER (WHERE tipo = 'N'), 0) AS DOUBLE) AS vl_portabilidade
FROM lines GROUP BY cod_empresa, mes_ref, cod_produto"""


@query(_CHAIN)
def j2_left_chain(t: Tables) -> DataFrame:
    """The textbook form of the spine: keys of all, each source joined to them.

    Lines are totalled once and written; the keys and the three sources are read from there.
    """
    totals = stage(r.lines(t).groupBy(*KEYS, "tipo").agg(F.sum("valor").alias("valor")), "kinds")
    kinds = _kinds(totals)
    spine = totals.select(*KEYS).distinct()
    for source in kinds.values():
        spine = spine.join(source, KEYS, "left")
    amounts = ["vl_contribuicao", "vl_resgate", "vl_portabilidade"]
    return _month(spine.withColumns({a: zero_fill(a).cast("double") for a in amounts}))


@query("""WITH a AS (SELECT date_trunc('month', o_orderdate) AS m, COUNT(*) AS pedidos FROM orders WHERE year(o_orderdate) <= 2000 GROUP BY ALL),
b AS (SELECT date_trunc('month', l_shipdate) AS m, COUNT(*) AS linhas FROM lineitem WHERE year(l_shipdate) >= 1996 GROUP BY ALL)
SELECT strftime(m, '%Y%m') AS ano_mes, pedidos, linhas FROM a FULL OUTER JOIN b USING (m)""")
def j3_full_outer(t: Tables) -> DataFrame:
    ordered = t.orders.filter("o_orderdate < '2001-01-01'").groupBy(r.month_of("o_orderdate").alias("mes_ref")).agg(r.rows("pedidos"))
    shipped = t.lineitem.filter("l_shipdate >= '1996-01-01'").groupBy(r.month_of("l_shipdate").alias("mes_ref")).agg(r.rows("linhas"))
    return _month(ordered.join(shipped, "mes_ref", "full_outer"))


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN
(SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01' AND o_orderstatus = 'O')""")
def j4_orphans(t: Tables) -> DataFrame:
    recent = t.orders.filter("o_orderdate >= '2000-06-01' AND o_orderstatus = 'O'")
    return orphan_keys(t.customer, recent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""SELECT o_orderstatus, COUNT(*) AS pedidos FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY ALL""")
def j5_semi(t: Tables) -> DataFrame:
    debtors = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(debtors, "o_custkey", "left_semi").groupBy("o_orderstatus").agg(r.rows("pedidos"))


_BRIDGE = f"""WITH {r.BRIDGE} SELECT cod_empresa, strftime(mes_ref, '%Y%m') AS ano_mes, cod_grupo, tipo_atribuicao, meses_defasagem FROM bridge"""


@query(_BRIDGE)
def j6_asof_bridge(t: Tables) -> DataFrame:
    return _month(r.customer_bridge(t))


@query(_BRIDGE)
def j6_asof_bucketed(t: Tables) -> DataFrame:
    """The same, with each entity's time cut into years: for histories too long for one task."""
    asked = stage(r.customer_lines(t).select("cod_empresa", "mes_ref").distinct(), "asked")
    return _month(asof_join(asked, r.group_history(t), ["cod_empresa"], "mes_ref", "mes_ref", ["cod_grupo"], bucket="year"))


@query(f"""WITH {r.LINES}, m AS (SELECT mes_ref, cod_produto, SUM(valor) AS v FROM lines GROUP BY ALL),
lim AS (SELECT year(o_orderdate) AS ano, MAX(date_trunc('month', o_orderdate)) AS ultimo, COUNT(*) AS pedidos FROM orders
  WHERE o_orderpriority = '5-LOW' AND month(o_orderdate) <= 7 GROUP BY ALL)
SELECT strftime(m.mes_ref, '%Y%m') AS ano_mes, cod_produto, CAST(v AS DOUBLE) AS total, pedidos
FROM m LEFT JOIN lim ON lim.ano = year(m.mes_ref) AND m.mes_ref <= lim.ultimo""")
def j7_range_condition(t: Tables) -> DataFrame:
    """An inequality beside the equality of an outer join: months up to the last one with early orders."""
    monthly = an.monthly_totals(r.lines(t), ["valor"]).withColumn("ano", F.year("mes_ref"))
    early = t.orders.filter((F.col("o_orderpriority") == "5-LOW") & (F.month("o_orderdate") <= 7))
    limits = early.groupBy(F.year("o_orderdate").alias("ano_l")).agg(F.max(r.month_of("o_orderdate")).alias("ultimo"), r.rows("pedidos"))
    met = monthly.join(limits, (F.col("ano") == F.col("ano_l")) & (F.col("mes_ref") <= F.col("ultimo")), "left")
    return _month(met.select("mes_ref", "cod_produto", F.col("valor").cast("double").alias("total"), "pedidos"))


@query("""WITH x AS (SELECT CAST(o_custkey AS VARCHAR) AS cod_empresa, date_trunc('month', o_orderdate) AS m, o_orderstatus AS s,
  SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS v FROM orders GROUP BY ALL),
k AS (SELECT DISTINCT cod_empresa, m FROM x)
SELECT k.cod_empresa, strftime(k.m, '%Y%m') AS ano_mes, CAST(COALESCE(a.v, 0) AS DOUBLE) AS vl_f, CAST(COALESCE(b.v, 0) AS DOUBLE) AS vl_o,
  CAST(COALESCE(c.v, 0) AS DOUBLE) AS vl_p, a.v IS NOT NULL AS fl_tem_f, b.v IS NOT NULL AS fl_tem_o, c.v IS NOT NULL AS fl_tem_p
FROM k LEFT JOIN x a ON a.cod_empresa = k.cod_empresa AND a.m = k.m AND a.s = 'F'
LEFT JOIN x b ON b.cod_empresa = k.cod_empresa AND b.m = k.m AND b.s = 'O'
LEFT JOIN x c ON c.cod_empresa = k.cod_empresa AND c.m = k.m AND c.s = 'P'""")
def j8_spine_flow(t: Tables) -> DataFrame:
    def source(status: str) -> tuple[DataFrame, list[str]]:
        name = f"vl_{status.lower()}"
        keys = [F.col("o_custkey").cast("string").alias("cod_empresa"), r.month_of("o_orderdate").alias("mes_ref")]
        one = t.orders.filter(F.col("o_orderstatus") == status).groupBy(*keys)
        return one.agg(F.sum(F.col("o_totalprice").cast(r.AMOUNT)).cast(r.AMOUNT).alias(name)), [name]

    joined = spine_join({s.lower(): source(s) for s in "FOP"}, ["cod_empresa", "mes_ref"])
    return r.doubles(_month(joined), "vl_f", "vl_o", "vl_p")


@query(f"""WITH {r.FACT} SELECT year(mes_ref) AS ano, nome_grupo, nome_empresa, cod_produto, CAST(SUM(vl_captacao_liquida) AS DOUBLE) AS vl
FROM fact GROUP BY ALL""")
def j9_star(t: Tables) -> DataFrame:
    yearly = (
        r.supplier_fact(t)
        .join(r.calendar(t).select("mes_ref", "ano"), "mes_ref")
        .groupBy("ano", "cod_empresa", "cod_grupo", "cod_produto")
        .agg(F.sum("vl_captacao_liquida").cast("double").alias("vl"))
    )
    groups = t.nation.select(F.col("n_nationkey").cast("string").alias("cod_grupo"), F.col("n_name").alias("nome_grupo"))
    companies = t.supplier.select(F.col("s_suppkey").cast("string").alias("cod_empresa"), F.col("s_name").alias("nome_empresa"))
    named = yearly.join(groups, "cod_grupo").join(companies, "cod_empresa")
    return named.select("ano", "nome_grupo", "nome_empresa", "cod_produto", "vl")


@query(f"""WITH {r.FLOW}, {r.STOCK}, f AS (SELECT mes_ref, cod_produto, SUM(vl_resgate) AS g FROM flow GROUP BY ALL)
SELECT strftime(f.mes_ref, '%Y%m') AS ano_mes, f.cod_produto, CAST(g AS DOUBLE) AS vl_resgate, CAST(vl_pmbac AS DOUBLE) AS vl_pmbac
FROM f JOIN stock s ON s.mes_ref = f.mes_ref AND s.cod_produto = f.cod_produto""")
def j10_aligned_facts(t: Tables) -> DataFrame:
    flow = an.monthly_totals(r.flow_rows(t), ["vl_resgate"])
    return r.doubles(_month(flow.join(r.stock_rows(t), ["mes_ref", "cod_produto"])), "vl_resgate", "vl_pmbac")
