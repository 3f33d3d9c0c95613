"""M: dimensions, bridge, facts and the column catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.catalog import data_catalog, undocumented
from tidemark.operators.combine import conservation
from tidemark.operators.period import ALWAYS, Period
from tidemark.operators.star import calendar_attributes, dim_latest, flow_fact, stock_fact
from tidemark.operators.temporal import attribution_summary
from tidemark.plans import roles as r
from tidemark.plans.q_aggregates import _profile_sql
from tidemark.plans.registry import Tables, query
from tidemark.session import stage
from tidemark.sources import literal_table, months_between_bounds

KEYS = ["cod_empresa", "mes_ref", "cod_produto"]
PERIOD = Period.months("1996-01", "2001-07")


@query("""WITH b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS a, date_trunc('month', MAX(o_orderdate)) AS z FROM orders),
d AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS m FROM b)
SELECT CAST(m AS VARCHAR) AS mes_ref, strftime(m, '%Y%m') AS ano_mes, CAST(year(m) AS INTEGER) AS ano, CAST(month(m) AS INTEGER) AS mes,
  CAST(quarter(m) AS INTEGER) AS trimestre, year(m) <= 2000 AS fl_ano_completo, month(m) <= 7 AS fl_periodo_ytd FROM d""")
def m1_calendar(t: Tables) -> DataFrame:
    months = months_between_bounds(t.orders, r.month_of("o_orderdate"))
    return calendar_attributes(months, r.LAST_FULL_YEAR, r.YTD_MONTH).withColumn("mes_ref", F.col("mes_ref").cast("string"))


@query("""WITH p(cod, nome) AS (VALUES ('F', 'Fechado'), ('O', 'Aberto')) SELECT nome, COUNT(l_orderkey) AS linhas
FROM p LEFT JOIN lineitem ON l_linestatus = cod GROUP BY nome""")
def m2_static_dim(t: Tables) -> DataFrame:
    products = literal_table(t.spark, [("F", "Fechado"), ("O", "Aberto")], "cod string, nome string")
    counts = t.lineitem.groupBy(F.col("l_linestatus").alias("cod")).agg(r.rows())
    return products.join(counts, "cod", "left").select("nome", F.coalesce("linhas", F.lit(0)).alias("linhas"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS cod_empresa, s_name AS nome_empresa FROM supplier")
def m3_passthrough_dim(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("cod_empresa"), F.col("s_name").alias("nome_empresa"))


@query("""SELECT o_orderpriority AS cod_grupo, CAST(max(o_custkey) FILTER (ultimo) AS VARCHAR) AS nome_grupo, bool_and(o_orderstatus = 'P') FILTER (ultimo) AS fl_grupo_generico
FROM (SELECT *, (o_orderdate, o_orderkey) = max((o_orderdate, o_orderkey)) OVER (PARTITION BY o_orderpriority) AS ultimo FROM orders)
GROUP BY o_orderpriority UNION ALL VALUES ('NAO_INFORMADO', 'GRUPO NÃO INFORMADO', true)""")
def m4_dim_latest(t: Tables) -> DataFrame:
    history = t.orders.select(
        F.col("o_orderpriority").alias("cod_grupo"),
        F.col("o_custkey").cast("string").alias("nome_grupo"),
        (F.col("o_orderstatus") == "P").alias("fl_grupo_generico"),
        "o_orderdate",
        "o_orderkey",
    )
    unknown = {"cod_grupo": "NAO_INFORMADO", "nome_grupo": "GRUPO NÃO INFORMADO", "fl_grupo_generico": True}
    return dim_latest(history, "cod_grupo", ["nome_grupo", "fl_grupo_generico"], "o_orderdate", ["o_orderkey"], unknown)


@query(f"""WITH {r.WHOLE_BRIDGE} SELECT cod_grupo, tipo_atribuicao, year(mes_ref) AS ano, COUNT(*) AS linhas, CAST(SUM(meses_defasagem) AS BIGINT) AS meses
FROM bridge GROUP BY ALL""")
def m5_bridge(t: Tables) -> DataFrame:
    by = ["cod_grupo", "tipo_atribuicao", F.year("mes_ref").alias("ano")]
    sources = r.customer_sources(t)
    return _bridge_from(t, sources["movimento"], sources["portabilidade"]).groupBy(*by).agg(r.rows(), F.sum("meses_defasagem").alias("meses"))


_FACT = f"""WITH {r.WHOLE_BRIDGE}, {r.CLINES}, {r.TRANSFERS},
moved AS (SELECT cod_empresa, mes_ref, cod_produto, if(parcela < 7, tipo, if(tipo = 'A', 'A', 'P')) AS kind,
    if(tipo = 'A' AND parcela = 7, -valor, valor) AS valor, tipo = 'A' AND parcela = 7 AS marca FROM clines WHERE tipo IN ('A', 'R')
  UNION ALL SELECT cod_empresa, mes_ref, cod_produto, direcao, valor, suspeita FROM transfers WHERE cod_produto IS NOT NULL AND direcao IS NOT NULL),
summed AS (SELECT cod_empresa, mes_ref, cod_produto, SUM(if(kind = 'A', valor, 0)) AS vl_contribuicao, SUM(if(kind = 'R', valor, 0)) AS vl_resgate,
  SUM(if(kind = 'P', valor, 0)) AS vl_resgate_pag_programado,
  SUM(if(kind = 'ACEITA', valor, 0)) AS vl_portab_aceita, SUM(if(kind = 'CEDIDA', valor, 0)) AS vl_portab_cedida,
  bool_or(kind = 'A') AS fl_tem_contribuicao, bool_or(kind IN ('R', 'P')) AS fl_tem_resgate, bool_or(kind IN ('ACEITA', 'CEDIDA')) AS fl_tem_portabilidade,
  bool_or(kind = 'A' AND marca) AS fl_contribuicao_negativa, bool_or(kind <> 'A' AND marca) AS fl_qtd_portab_suspeita
  FROM moved WHERE mes_ref BETWEEN DATE '1996-01-01' AND DATE '2001-07-01' GROUP BY ALL),
fato AS (SELECT summed.*, cod_grupo FROM summed JOIN bridge USING (cod_empresa, mes_ref))"""


def _flow_fact(t: Tables, sources: dict[str, DataFrame]) -> DataFrame:
    """Eight amounts and five flags on the grain of company, month and product."""
    measures = {
        "contribuicao": ["vl_contribuicao", "fl_contribuicao_negativa"],
        "resgate": ["vl_resgate", "vl_resgate_pag_programado"],
        "portabilidade": ["vl_portab_aceita", "vl_portab_cedida", "fl_qtd_portab_suspeita"],
    }
    own = F.col("vl_contribuicao") - F.col("vl_resgate")
    net = F.col("vl_portab_aceita") - F.col("vl_portab_cedida")
    return flow_fact(
        {name: (sources[name], columns) for name, columns in measures.items()},
        KEYS,
        _bridge_from(t, sources["movimento"], sources["portabilidade"], period=PERIOD).select("cod_empresa", "mes_ref", "cod_grupo"),
        ["cod_empresa", "mes_ref"],
        {"vl_flcr": own, "vl_portab_liquida": net, "vl_captacao_liquida": own + net},
    )


@query(f"""{_FACT} SELECT cod_empresa, strftime(mes_ref, '%Y%m') AS ano_mes, cod_produto, cod_grupo, CAST(vl_contribuicao AS DOUBLE) AS vl_contribuicao,
  CAST(vl_resgate AS DOUBLE) AS vl_resgate, CAST(vl_resgate_pag_programado AS DOUBLE) AS vl_resgate_pag_programado,
  CAST(vl_portab_aceita AS DOUBLE) AS vl_portab_aceita, CAST(vl_portab_cedida AS DOUBLE) AS vl_portab_cedida,
  CAST(vl_contribuicao - vl_resgate AS DOUBLE) AS vl_flcr, CAST(vl_portab_aceita - vl_portab_cedida AS DOUBLE) AS vl_portab_liquida,
  CAST(vl_contribuicao - vl_resgate + vl_portab_aceita - vl_portab_cedida AS DOUBLE) AS vl_captacao_liquida,
  fl_tem_contribuicao, fl_tem_resgate, fl_tem_portabilidade, fl_contribuicao_negativa, fl_qtd_portab_suspeita FROM fato""")
def m6_flow_fact(t: Tables) -> DataFrame:
    fact = _flow_fact(t, r.customer_sources(t, PERIOD))
    amounts = [c for c in fact.columns if c.startswith("vl_")]
    return r.doubles(fact.withColumn("ano_mes", F.date_format("mes_ref", "yyyyMM")).drop("mes_ref"), *amounts)


_KEPT = {"vl_contribuicao": "'A'", "vl_resgate": "'R'", "vl_resgate_pag_programado": "'P'", "vl_portab_aceita": "'ACEITA'", "vl_portab_cedida": "'CEDIDA'"}


@query(f"{_FACT}, total AS (SELECT kind, SUM(valor) AS v FROM moved WHERE mes_ref BETWEEN DATE '1996-01-01' AND DATE '2001-07-01' GROUP BY kind) " + " UNION ALL ".join(
    f"""SELECT '{m}' AS metrica, (SELECT CAST(v AS DOUBLE) FROM total WHERE kind = {k}) AS antes, (SELECT CAST(SUM({m}) AS DOUBLE) FROM fato) AS depois,
  CAST((SELECT SUM({m}) FROM fato) - (SELECT v FROM total WHERE kind = {k}) AS DOUBLE) AS diferenca, 'OK' AS status""" for m, k in _KEPT.items()))
def m6_conservation(t: Tables) -> DataFrame:
    """What the sources hold of the period against what the fact holds, measure by measure: one scan of either."""
    sources = r.customer_sources(t, PERIOD)
    moved = [sources[s] for s in ("contribuicao", "resgate", "portabilidade")]
    before = moved[0].unionByName(moved[1], allowMissingColumns=True).unionByName(moved[2], allowMissingColumns=True)
    return r.doubles(conservation(before, _flow_fact(t, sources), {m: m for m in _KEPT}), "antes", "depois", "diferenca")


def _bridge_from(t: Tables, *sources: DataFrame, period: Period = ALWAYS) -> DataFrame:
    """Months of the period; the history reaches back without end, as an as-of needs."""
    from tidemark.operators.temporal import temporal_bridge

    asked = None if period.whole else period.covers("mes_ref")
    return temporal_bridge(sources, r.group_history(t, period.until()), "cod_empresa", "mes_ref", "cod_grupo", asked)


@query(f"""WITH {r.BRIDGE}, {r.CLINES}, s AS (SELECT cod_empresa, mes_ref, cod_produto, SUM(SUM(valor)) OVER (PARTITION BY cod_empresa, cod_produto
  ORDER BY mes_ref ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vl_pmbac FROM clines GROUP BY cod_empresa, mes_ref, cod_produto)
SELECT s.cod_empresa, strftime(s.mes_ref, '%Y%m') AS ano_mes, s.cod_produto, b.cod_grupo, CAST(vl_pmbac AS DOUBLE) AS vl_pmbac
FROM s JOIN bridge b ON b.cod_empresa = s.cod_empresa AND b.mes_ref = s.mes_ref WHERE s.mes_ref BETWEEN DATE '1996-01-01' AND DATE '2001-07-01'""")
def m7_stock_fact(t: Tables) -> DataFrame:
    """A balance counts all that was shipped so far, so only the upper end of the period bounds the scan."""
    from pyspark.sql import Window

    shipped = r.customer_lines(t, PERIOD.until()).groupBy(*KEYS).agg(F.sum("valor").cast(r.AMOUNT).alias("v"))
    so_far = Window.partitionBy("cod_empresa", "cod_produto").orderBy("mes_ref").rowsBetween(Window.unboundedPreceding, 0)
    stock = shipped.select(*KEYS, F.sum("v").over(so_far).alias("vl_pmbac")).filter(PERIOD.covers("mes_ref"))
    stock = stage(stock, "stock")  # balances of the period alone; the bridge asks for their months
    bridge = _bridge_from(t, stock, period=PERIOD).select("cod_empresa", "mes_ref", "cod_grupo")
    fact = stock_fact(stock, bridge, ["cod_empresa", "mes_ref"], [*KEYS, "cod_grupo", "vl_pmbac"])
    return r.doubles(fact.withColumn("ano_mes", F.date_format("mes_ref", "yyyyMM")).drop("mes_ref"), "vl_pmbac")


_RANGE, _DAY = "CAST({} AS VARCHAR)", "strftime({}, '%Y-%m-%d')"
_TABLES = {
    "silver.pedidos": (
        "(SELECT o_orderkey AS chave, o_orderstatus AS situacao, o_orderpriority AS prioridade, CAST(o_totalprice AS DECIMAL(20,2)) AS valor, o_orderdate AS dia FROM orders)",
        {"chave": _RANGE, "valor": _RANGE, "dia": _DAY},
        ["situacao", "prioridade"],
        ["chave", "situacao", "prioridade", "valor", "dia"],
    ),
    "gold.clientes": (
        "(SELECT c_custkey AS cliente, c_name AS nome, c_mktsegment AS segmento, c_nationkey AS nacao FROM customer)",
        {"cliente": _RANGE, "nacao": _RANGE},
        ["nome", "segmento"],
        ["cliente", "nome", "segmento", "nacao"],
    ),
}
_DOCS = {"chave": "Chave do pedido.", "situacao": "Situação.", "valor": "Valor.", "cliente": "Código do cliente.", "segmento": "Segmento."}
_ABOUT = {"silver.pedidos": ("Pedidos.", "orders"), "gold.clientes": ("Clientes.", "customer")}


def _catalog_frame(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.col("o_orderkey").alias("chave"),
        F.col("o_orderstatus").alias("situacao"),
        F.col("o_orderpriority").alias("prioridade"),
        F.col("o_totalprice").cast(r.AMOUNT).alias("valor"),
        F.col("o_orderdate").cast("date").alias("dia"),
    )
    owners = t.customer.select(
        F.col("c_custkey").alias("cliente"), F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("segmento"), F.col("c_nationkey").alias("nacao")
    )
    return data_catalog({"silver.pedidos": orders, "gold.clientes": owners}, _ABOUT, _DOCS)


_CASES = " ".join(f"WHEN '{c}' THEN '{d}'" for c, d in _DOCS.items())
_CATALOG = "WITH prof AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS tabela, '{_ABOUT[name][0]}' AS descricao_tabela, '{_ABOUT[name][1]}' AS linhagem, q.* FROM ({_profile_sql(*spec)}) q"
    for name, spec in _TABLES.items()
) + f"""), cat AS (SELECT upper(split_part(tabela, '.', 1)) AS camada, tabela, descricao_tabela, linhagem, coluna,
  CASE coluna {_CASES} ELSE '' END AS descricao_coluna,
  CASE WHEN minimo IS NOT NULL THEN '[' || minimo || ' ; ' || maximo || ']'
       WHEN n_distintos <= 12 THEN '{{' || replace(valores, ',', ', ') || '}}'
       ELSE n_distintos || ' valores distintos (ex.: ' || array_to_string(string_split(valores, ',')[1:3], ', ') || ' ...)' END AS dominio_observado,
  pct_nulos FROM prof)"""


@query(f"{_CATALOG} SELECT * FROM cat")
def m8_catalog(t: Tables) -> DataFrame:
    return _catalog_frame(t).drop("tipo")


@query(f"{_CATALOG} SELECT tabela, COUNT(*) AS sem_descricao FROM cat WHERE descricao_coluna = '' GROUP BY tabela")
def m9_undocumented(t: Tables) -> DataFrame:
    return undocumented(_catalog_frame(t)).groupBy("tabela").agg(r.rows("sem_descricao"))


@query(f"""{_FACT}, u AS (SELECT cod_empresa, mes_ref, cod_grupo FROM fato GROUP BY ALL)
SELECT b.tipo_atribuicao, COUNT(*) AS linhas, MAX(b.meses_defasagem) AS max_defasagem
FROM u JOIN bridge b ON b.cod_empresa = u.cod_empresa AND b.mes_ref = u.mes_ref GROUP BY ALL""")
def m10_attribution_summary(t: Tables) -> DataFrame:
    """How the group was found, for the months that reach the fact."""
    sources = r.customer_sources(t, PERIOD)
    used = [sources[s] for s in ("contribuicao", "resgate", "portabilidade")]
    return attribution_summary(_bridge_from(t, *used, period=PERIOD))
