"""Driver tables in the roles the operators expect, and the same roles as SQL fragments.

Suppliers stand in for companies and nations for groups; line status is the product. Lines
flagged A are contributions, R redemptions, N transfers whose direction follows the discount.
Where a group must change over time, customers are the companies and the group of a month is
the greatest priority among the customer's finished orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import recode, sum_where
from tidemark.operators.metrics import implausible_average
from tidemark.operators.period import ALWAYS, Period, month_of, with_month
from tidemark.operators.star import dim_calendar, unit_names
from tidemark.plans.analyses import Money
from tidemark.plans.registry import Tables

AMOUNT = "decimal(20,2)"
GENERIC = ("3", "7")
FIRST_MONTH, LAST_MONTH, LAST_FULL_YEAR, YTD_MONTH = "1995-01-01", "2001-12-01", 2000, 7
MILLIONS = Money(1e6, 8, "_mi")


def rows(name: str = "linhas"):
    return F.count(F.lit(1)).alias(name)


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals as doubles, the type both engines compare the same way."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def lines(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Lines of the period, all of them by default."""
    return with_month(t.lineitem, "l_shipdate", period).select(
        F.col("l_suppkey").cast("string").alias("cod_empresa"),
        "mes_ref",
        F.col("l_linestatus").alias("cod_produto"),
        F.col("l_returnflag").alias("tipo"),
        F.col("l_discount").cast("decimal(4,2)").alias("desconto"),
        F.col("l_quantity").cast("bigint").alias("quantidade"),
        F.col("l_extendedprice").cast(AMOUNT).alias("valor"),
    )


LINES = """lines AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS cod_empresa, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes_ref,
         l_linestatus AS cod_produto, l_returnflag AS tipo, CAST(l_discount AS DECIMAL(4,2)) AS desconto,
         CAST(l_quantity AS BIGINT) AS quantidade, CAST(l_extendedprice AS DECIMAL(20,2)) AS valor
  FROM lineitem)"""


def _measures(df: DataFrame) -> DataFrame:
    """Amount columns of one line: its value under what it is, 0 elsewhere."""
    zero = F.lit(0).cast(AMOUNT)
    kinds = {
        "vl_contribuicao": F.col("tipo") == "A",
        "vl_resgate": F.col("tipo") == "R",
        "vl_portab_aceita": (F.col("tipo") == "N") & (F.col("desconto") < 0.05),
        "vl_portab_cedida": (F.col("tipo") == "N") & (F.col("desconto") >= 0.05),
    }
    return df.withColumns({n: F.when(c, F.col("valor")).otherwise(zero) for n, c in kinds.items()})


def with_derived(df: DataFrame) -> DataFrame:
    own = F.col("vl_contribuicao") - F.col("vl_resgate")
    net = F.col("vl_portab_aceita") - F.col("vl_portab_cedida")
    return df.withColumns({"vl_flcr": own, "vl_portab_liquida": net, "vl_captacao_liquida": own + net})


def flow_rows(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Line-level flows, for questions that need no company."""
    return _measures(lines(t, period)).drop("tipo", "desconto", "quantidade", "valor")


FLOW = (
    LINES
    + """, flow AS (
  SELECT cod_empresa, mes_ref, cod_produto,
         CASE WHEN tipo = 'A' THEN valor ELSE 0 END AS vl_contribuicao,
         CASE WHEN tipo = 'R' THEN valor ELSE 0 END AS vl_resgate,
         CASE WHEN tipo = 'N' AND desconto < 0.05 THEN valor ELSE 0 END AS vl_portab_aceita,
         CASE WHEN tipo = 'N' AND desconto >= 0.05 THEN valor ELSE 0 END AS vl_portab_cedida
  FROM lines)"""
)


def supplier_fact(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Month x company x product fact with the group of each company.

    Lines are totalled before they meet the suppliers, so the join sees one row per grain.
    """
    totals = flow_rows(t, period).groupBy("mes_ref", "cod_empresa", "cod_produto").agg(
        *[F.sum(c).cast(AMOUNT).alias(c) for c in ("vl_contribuicao", "vl_resgate", "vl_portab_aceita", "vl_portab_cedida")]
    )
    groups = t.supplier.select(F.col("s_suppkey").cast("string").alias("cod_empresa"), F.col("s_nationkey").cast("string").alias("cod_grupo"))
    return with_derived(totals.join(groups, "cod_empresa"))


OWNER = """member AS (
  SELECT s_suppkey, list_contains(['3', '7'], CAST(s_nationkey AS VARCHAR)) AS sozinha, s_name, n_name, CAST(s_nationkey AS VARCHAR) AS grupo
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
owner AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS cod_empresa, if(sozinha, concat('EMP_', s_suppkey), grupo) AS unidade,
         if(sozinha, concat(s_name, ' (sem grupo)'), n_name) AS nome_unidade FROM member)"""

# every line under its unit, by what it is: paid in, drawn, transferred in or out
MOVES = (
    OWNER
    + """, moves AS (
  SELECT unidade, nome_unidade, l_linestatus AS produto, year(l_shipdate) AS y, CAST(l_extendedprice AS DECIMAL(20,2)) AS valor,
         CASE l_returnflag WHEN 'A' THEN 'pago' WHEN 'R' THEN 'sacado'
              ELSE if(CAST(l_discount AS DECIMAL(4,2)) < 0.05, 'entrou', 'saiu') END AS kind
  FROM lineitem JOIN owner ON cod_empresa = CAST(l_suppkey AS VARCHAR))"""
)

FACT = (
    FLOW
    + ", "
    + OWNER
    + """, totals AS (
  SELECT mes_ref, cod_empresa, cod_produto, SUM(vl_contribuicao) AS vl_contribuicao, SUM(vl_resgate) AS vl_resgate,
         SUM(vl_portab_aceita) AS vl_portab_aceita, SUM(vl_portab_cedida) AS vl_portab_cedida
  FROM flow GROUP BY ALL),
fact AS (
  SELECT x.*, CAST(s.s_nationkey AS VARCHAR) AS cod_grupo, s.s_name AS nome_empresa, n.n_name AS nome_grupo,
         vl_contribuicao - vl_resgate AS vl_flcr, vl_portab_aceita - vl_portab_cedida AS vl_portab_liquida,
         vl_contribuicao - vl_resgate + vl_portab_aceita - vl_portab_cedida AS vl_captacao_liquida
  FROM totals x JOIN supplier s ON x.cod_empresa = CAST(s.s_suppkey AS VARCHAR)
                JOIN nation n ON n.n_nationkey = s.s_nationkey),
units AS (
  SELECT if(y > 2000, NULL, CAST(y AS VARCHAR)) AS periodo_ano, if(m > 7, NULL, concat(y, '_JAN_JUL')) AS periodo_ytd,
         owner.unidade, owner.nome_unidade, f.*
  FROM (SELECT *, year(mes_ref) AS y, month(mes_ref) AS m FROM fact) f JOIN owner USING (cod_empresa))"""
)


def calendar(t: Tables) -> DataFrame:
    return dim_calendar(t.spark, FIRST_MONTH, LAST_MONTH, LAST_FULL_YEAR, YTD_MONTH)


def names(t: Tables) -> DataFrame:
    groups = t.nation.select(F.col("n_nationkey").cast("string").alias("g"), F.col("n_name").alias("gn"))
    own = t.supplier.select(F.col("s_suppkey").cast("string").alias("e"), F.col("s_name").alias("en"))
    return unit_names(groups, own, ("g", "gn"), ("e", "en"), GENERIC)


def stock_rows(t: Tables) -> DataFrame:
    """Month-end balance per product: running total of the value shipped so far."""
    monthly = lines(t).groupBy("mes_ref", "cod_produto").agg(F.sum("valor").cast(AMOUNT).alias("v"))
    running = Window.partitionBy("cod_produto").orderBy("mes_ref").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select("mes_ref", "cod_produto", F.sum("v").over(running).cast(AMOUNT).alias("vl_pmbac"))


STOCK = """stock AS (
  SELECT mes_ref, cod_produto, SUM(SUM(valor)) OVER (PARTITION BY cod_produto ORDER BY mes_ref
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vl_pmbac
  FROM lines GROUP BY mes_ref, cod_produto)"""


# --- customers as companies -------------------------------------------------------------------


def customer_lines(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Lines with the customer of their order. A key that dominates either side is split by adaptive execution.

    ``parcela`` is the line's number in its order: a last one (7) is a reversal among contributions and a scheduled
    payment among redemptions.
    """
    owner = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("cod_empresa"))
    shipped = with_month(t.lineitem, "l_shipdate", period).select(
        F.col("l_orderkey").alias("o_orderkey"),
        "mes_ref",
        F.col("l_linestatus").alias("cod_produto"),
        F.col("l_returnflag").alias("tipo"),
        F.col("l_linenumber").alias("parcela"),
        F.col("l_extendedprice").cast(AMOUNT).alias("valor"),
    )
    return shipped.join(owner, "o_orderkey").drop("o_orderkey")


CLINES = """clines AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS cod_empresa, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS mes_ref,
         l.l_linestatus AS cod_produto, l.l_returnflag AS tipo, l.l_linenumber AS parcela,
         CAST(l.l_extendedprice AS DECIMAL(20,2)) AS valor
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


def group_history(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Group of a customer in the months it has one.

    The role takes a customer's finished orders alone as the record of its group; open ones say nothing about it.
    """
    done = with_month(t.orders.filter("o_orderstatus = 'F'"), "o_orderdate", period)
    return done.groupBy(F.col("o_custkey").cast("string").alias("cod_empresa"), "mes_ref").agg(
        F.max("o_orderpriority").alias("cod_grupo")
    )


HIST = """hist AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cod_empresa, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_ref,
         MAX(o_orderpriority) AS cod_grupo
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)"""

# Transfers: orders of the two leading priorities, one per product; status F is accepted, O ceded.
PRODUCT_OF = {"1-URGENT": "O", "2-HIGH": "F"}
DIRECTION_OF = {"F": "ACEITA", "O": "CEDIDA"}
LOW_AVERAGE = 5000


def transfers(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Orders as transfers; the day of the month stands in for the number of transfers that a row adds up."""
    amount = F.col("o_totalprice").cast(AMOUNT)
    return with_month(t.orders, "o_orderdate", period).select(
        F.col("o_custkey").cast("string").alias("cod_empresa"),
        "mes_ref",
        recode("o_orderpriority", PRODUCT_OF).alias("cod_produto"),
        recode("o_orderstatus", DIRECTION_OF).alias("direcao"),
        implausible_average(F.dayofmonth("o_orderdate"), amount, LOW_AVERAGE).alias("fl_qtd_portab_suspeita"),
        amount.alias("valor"),
    )


TRANSFERS = """transfers AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cod_empresa, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_ref,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'O' WHEN '2-HIGH' THEN 'F' END AS cod_produto,
         CASE o_orderstatus WHEN 'F' THEN 'ACEITA' WHEN 'O' THEN 'CEDIDA' END AS direcao,
         CAST(o_totalprice AS DECIMAL(20,2)) AS valor,
         CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS DOUBLE) / day(o_orderdate) < 5000 AS suspeita
  FROM orders)"""

_SHIPPED = """SELECT CAST(o_custkey AS VARCHAR) AS cod_empresa, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes_ref
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
_TRANSFERRED = """SELECT CAST(o_custkey AS VARCHAR), CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')"""


def _bridge_sql(*months: str) -> str:
    return f"""{HIST}, asked AS ({" UNION ".join(months)}),
bridge AS (
  SELECT q.cod_empresa, q.mes_ref, ifnull(g.cod_grupo, 'NAO_INFORMADO') AS cod_grupo,
         CASE q.mes_ref - g.mes_ref WHEN 0 THEN 'EXATA' ELSE if(g.mes_ref IS NULL, 'NAO_INFORMADO', 'HERDADA') END AS tipo_atribuicao,
         CAST(datediff('month', g.mes_ref, q.mes_ref) AS INTEGER) AS meses_defasagem
  FROM (SELECT DISTINCT * FROM asked) q ASOF LEFT JOIN hist g ON q.cod_empresa = g.cod_empresa AND q.mes_ref >= g.mes_ref)"""


# months with lines, and months with lines or transfers
BRIDGE = _bridge_sql(_SHIPPED)
WHOLE_BRIDGE = _bridge_sql(_SHIPPED, _TRANSFERRED)


def customer_sources(t: Tables, period: Period = ALWAYS) -> dict[str, DataFrame]:
    """Contributions, redemptions and transfers on the customer grain, in a period that bounds the raw dates."""
    from tidemark.operators.dedup import pivot_sum
    from tidemark.session import stage

    keys = ["cod_empresa", "mes_ref", "cod_produto"]
    paid, drawn, last = F.col("tipo") == "A", F.col("tipo") == "R", F.col("parcela") == 7
    signed = F.when(last, -F.col("valor")).otherwise(F.col("valor"))
    # one pass over lines and orders, written once: each source below reads its own columns of it
    moved = stage(
        customer_lines(t, period).groupBy(*keys).agg(
            sum_where(signed, paid).cast(AMOUNT).alias("vl_contribuicao"),
            sum_where("valor", drawn & ~last).cast(AMOUNT).alias("vl_resgate"),
            sum_where("valor", drawn & last).cast(AMOUNT).alias("vl_resgate_pag_programado"),
            sum_where("valor", F.lit(True)).cast(AMOUNT).alias("vl_total"),
            F.bool_or(paid & last).alias("fl_contribuicao_negativa"),
            F.bool_or(paid).alias("tem_a"),
            F.bool_or(drawn).alias("tem_r"),
        ),
        "customer-moves",
    )
    moves = transfers(t, period).filter(F.col("cod_produto").isNotNull() & F.col("direcao").isNotNull())
    columns = {"ACEITA": "vl_portab_aceita", "CEDIDA": "vl_portab_cedida"}
    return {
        "contribuicao": moved.filter("tem_a").select(*keys, "vl_contribuicao", "fl_contribuicao_negativa"),
        "resgate": moved.filter("tem_r").select(*keys, "vl_resgate", "vl_resgate_pag_programado"),
        "portabilidade": pivot_sum(moves, keys, "direcao", "valor", columns, ["fl_qtd_portab_suspeita"]),
        "movimento": moved.select(*keys, "vl_total"),
    }


def customer_bridge(t: Tables) -> DataFrame:
    from tidemark.operators.temporal import temporal_bridge

    return temporal_bridge([customer_lines(t)], group_history(t), "cod_empresa", "mes_ref", "cod_grupo")


# --- raw text ---------------------------------------------------------------------------------


def raw_lines(t: Tables, period: Period = ALWAYS) -> DataFrame:
    """Line items shipped in the period as a text extract would bring them, with the defects such extracts have.

    Padded company codes, blank and impossible months, product codes that are missing or unknown,
    decimal commas with residue, thousands separators, words and blanks among the amounts.
    """
    amount = F.translate(F.col("l_extendedprice").cast(AMOUNT).cast("string"), ".", ",")
    code, n = F.col("l_suppkey").cast("string"), F.col("l_linenumber")
    transfer = F.col("l_returnflag") == "N"
    tax = F.col("l_tax").cast("decimal(4,2)")
    return with_month(t.lineitem, "l_shipdate", period).select(
        F.when(F.col("l_returnflag") == "R", F.concat(code, F.lit("   "))).otherwise(code).alias("coenti"),
        F.when(transfer & (n == 7), F.lit(""))
        .when(transfer & (n == 6), F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("13")))
        .otherwise(F.date_format("l_shipdate", "yyyyMM"))
        .alias("damesano"),
        F.when(tax == 0.08, F.lit(None)).when(tax == 0.07, F.lit("X")).otherwise(F.col("l_linestatus")).alias("tipoProd"),
        F.when(transfer & (n == 4), F.lit("abc"))
        .when(transfer & (n == 3), F.lit("1.234,56"))
        .when(transfer & (n == 2), F.lit(" "))
        .when(n == 5, F.concat(amount, F.lit("0002")))
        .otherwise(amount)
        .alias("contrib"),
        F.when(transfer & (n == 1), F.lit("n/d")).otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("QUANTIDADE"),
    )


RAW = """raw AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey AS VARCHAR) || '   ' ELSE CAST(l_suppkey AS VARCHAR) END AS coenti,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN ''
              WHEN l_returnflag = 'N' AND l_linenumber = 6 THEN strftime(l_shipdate, '%Y') || '13'
              ELSE strftime(l_shipdate, '%Y%m') END AS damesano,
         CASE WHEN CAST(l_tax AS DECIMAL(4,2)) = 0.08 THEN NULL WHEN CAST(l_tax AS DECIMAL(4,2)) = 0.07 THEN 'X'
              ELSE l_linestatus END AS tipoProd,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 4 THEN 'abc'
              WHEN l_returnflag = 'N' AND l_linenumber = 3 THEN '1.234,56'
              WHEN l_returnflag = 'N' AND l_linenumber = 2 THEN ' '
              WHEN l_linenumber = 5 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR), '.', ',') || '0002'
              ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR), '.', ',') END AS contrib,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'n/d'
              ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS QUANTIDADE
  FROM lineitem),
clean AS (
  SELECT *, trim(coenti) AS cod_empresa, TRY_CAST(replace(trim(contrib), ',', '.') AS DECIMAL(20,2)) AS valor,
         TRY_CAST(trim(QUANTIDADE) AS BIGINT) AS qt,
         CASE WHEN regexp_full_match(trim(damesano), '(19|20)[0-9]{2}(0[1-9]|1[0-2])')
              THEN CAST(strptime(trim(damesano) || '01', '%Y%m%d') AS DATE) END AS mes_ref
  FROM raw)"""
