"""P: projections, predicates and recodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    band,
    count_where,
    in_domain,
    is_blank,
    matches,
    not_numeric,
    outside_domain,
    parse_decimal,
    parse_integer,
    parse_month,
    recode,
    zero_fill,
)
from tidemark.operators.cleanse import canonical_names, scope_filter, standardize
from tidemark.operators.period import Period
from tidemark.operators.star import economic_unit
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query
from tidemark.sources import business_columns, with_provenance

# Source spellings (in lower case) of the two key columns.
STANDARD = {"coenti": "cod_empresa", "damesano": "ano_mes"}


@query(f"WITH {r.RAW} SELECT trim(coenti) AS cod_empresa, trim(damesano) AS ano_mes, COUNT(*) AS linhas FROM raw GROUP BY ALL")
def p1_standardize(t: Tables) -> DataFrame:
    return standardize(r.raw_lines(t), {"cod_empresa": "coenti", "ano_mes": "damesano"}).groupBy("cod_empresa", "ano_mes").agg(r.rows())


@query(f"WITH {r.RAW} SELECT coenti AS cod_empresa, COUNT(DISTINCT damesano) AS meses FROM raw GROUP BY coenti")
def p2_canonical_names(t: Tables) -> DataFrame:
    shouted = r.raw_lines(t).withColumnsRenamed({"coenti": "Coenti", "damesano": "DAMESANO"})
    return canonical_names(shouted, STANDARD).groupBy("cod_empresa").agg(F.count_distinct("ano_mes").alias("meses"))


@query("SELECT o_orderstatus, o_orderpriority, COUNT(*) AS linhas FROM orders GROUP BY ALL")
def p3_business_columns(t: Tables) -> DataFrame:
    tagged = with_provenance(t.orders.select("o_orderstatus", "o_orderpriority"), "2026-01-31", "202601")
    return tagged.groupBy(*business_columns(tagged)).agg(r.rows())


@query(f"""WITH {r.RAW} SELECT tipoProd AS produto, COUNT(*) AS linhas, COUNT(valor) AS lidas,
  COUNT(*) FILTER (WHERE trim(contrib) = '') AS vazias,
  COUNT(*) FILTER (WHERE trim(contrib) <> '' AND valor IS NULL) AS ilegiveis, CAST(SUM(valor) AS DOUBLE) AS total
FROM clean GROUP BY tipoProd""")
def p4_parse_decimal(t: Tables) -> DataFrame:
    value = parse_decimal("contrib")
    return r.raw_lines(t).groupBy(F.col("tipoProd").alias("produto")).agg(
        r.rows(),
        F.count(value).alias("lidas"),
        count_where(is_blank("contrib")).alias("vazias"),
        count_where(not_numeric("contrib")).alias("ilegiveis"),
        F.sum(value).cast("double").alias("total"),
    )


@query(f"WITH {r.RAW} SELECT CAST(mes_ref AS VARCHAR) AS mes, COUNT(*) AS linhas FROM clean GROUP BY mes_ref")
def p5_parse_month(t: Tables) -> DataFrame:
    return r.raw_lines(t).groupBy(parse_month("damesano").cast("string").alias("mes")).agg(r.rows())


@query(f"WITH {r.RAW} SELECT cod_empresa, COUNT(qt) AS lidas, CAST(SUM(qt) AS BIGINT) AS total FROM clean GROUP BY cod_empresa")
def p6_parse_integer(t: Tables) -> DataFrame:
    n = parse_integer("QUANTIDADE")
    return r.raw_lines(t).groupBy(F.trim("coenti").alias("cod_empresa")).agg(F.count(n).alias("lidas"), F.sum(n).alias("total"))


@query(f"""WITH {r.RAW} SELECT COUNT(*) FILTER (WHERE tipoProd IS NULL OR trim(tipoProd) = '') AS produto,
  COUNT(*) FILTER (WHERE damesano IS NULL OR trim(damesano) = '') AS mes,
  COUNT(*) FILTER (WHERE contrib IS NULL OR trim(contrib) = '') AS valor FROM raw""")
def p7_blank(t: Tables) -> DataFrame:
    columns = {"produto": "tipoProd", "mes": "damesano", "valor": "contrib"}
    return r.raw_lines(t).agg(*[count_where(is_blank(c)).alias(n) for n, c in columns.items()])


@query(f"""WITH {r.RAW} SELECT damesano, COUNT(*) FILTER (WHERE tipoProd IN ('O', 'F')) AS dentro,
  COUNT(*) FILTER (WHERE tipoProd IS NULL OR tipoProd NOT IN ('O', 'F')) AS fora FROM raw GROUP BY damesano""")
def p8_domain(t: Tables) -> DataFrame:
    return r.raw_lines(t).groupBy("damesano").agg(
        count_where(in_domain("tipoProd", ["O", "F"])).alias("dentro"), count_where(outside_domain("tipoProd", ["O", "F"])).alias("fora")
    )


@query(f"""WITH {r.RAW} SELECT tipoProd AS produto, COUNT(*) FILTER (WHERE regexp_full_match(coenti, '[0-9]+')) AS limpos,
  COUNT(*) FILTER (WHERE NOT regexp_full_match(coenti, '[0-9]+')) AS sujos FROM raw GROUP BY tipoProd""")
def p9_format(t: Tables) -> DataFrame:
    fits = matches("coenti", r"^\d+$")
    return r.raw_lines(t).groupBy(F.col("tipoProd").alias("produto")).agg(count_where(fits).alias("limpos"), count_where(~fits).alias("sujos"))


@query(f"""WITH {r.LINES} SELECT cod_produto, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS total FROM lines
WHERE mes_ref BETWEEN DATE '1996-03-01' AND DATE '1998-10-01' GROUP BY cod_produto""")
def p10_range(t: Tables) -> DataFrame:
    kept = r.lines(t, Period.months("1996-03", "1998-10"))
    return kept.groupBy("cod_produto").agg(r.rows(), F.sum("valor").cast("double").alias("total"))


@query("""SELECT c_mktsegment, c_acctbal < 0 AS negativo, CAST(c_acctbal AS DECIMAL(20,2)) = 0 AS zero,
  CAST(c_nationkey AS VARCHAR) IN ('3', '7') AS generico, COUNT(*) AS linhas FROM customer GROUP BY ALL""")
def p11_flags(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal").cast(r.AMOUNT)
    flagged = t.customer.select(
        "c_mktsegment",
        (balance < 0).alias("negativo"),
        (balance == 0).alias("zero"),
        in_domain(F.col("c_nationkey").cast("string"), r.GENERIC).alias("generico"),
    )
    return flagged.groupBy(*flagged.columns).agg(r.rows())


@query("""SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'ACEITA' WHEN 'O' THEN 'CEDIDA' END AS direcao,
  COUNT(*) AS linhas, CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL""")
def p12_recode(t: Tables) -> DataFrame:
    coded = t.orders.select(
        "o_orderpriority", recode("o_orderstatus", r.DIRECTION_OF).alias("direcao"), F.col("o_totalprice").cast(r.AMOUNT).alias("v")
    )
    return coded.groupBy("o_orderpriority", "direcao").agg(r.rows(), F.sum("v").cast("double").alias("total"))


@query("""SELECT l_returnflag, CASE WHEN l_discount <= 0.02 THEN 'ate 2%' WHEN l_discount <= 0.05 THEN 'ate 5%'
  ELSE 'acima' END AS faixa, COUNT(*) AS linhas FROM lineitem GROUP BY ALL""")
def p13_band(t: Tables) -> DataFrame:
    banded = t.lineitem.select("l_returnflag", band("l_discount", [0.02, 0.05], ["ate 2%", "ate 5%", "acima"]).alias("faixa"))
    return banded.groupBy("l_returnflag", "faixa").agg(r.rows())


@query("""SELECT CASE WHEN c_nationkey IN (3, 7) THEN 'EMP_' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_nationkey AS VARCHAR) END
  AS unidade, COUNT(*) AS linhas, CAST(SUM(CAST(c_acctbal AS DECIMAL(20,2))) AS DOUBLE) AS saldo FROM customer GROUP BY ALL""")
def p14_economic_unit(t: Tables) -> DataFrame:
    owners = t.customer.select(
        F.col("c_custkey").cast("string").alias("e"), F.col("c_nationkey").cast("string").alias("g"), F.col("c_acctbal").cast(r.AMOUNT).alias("v")
    )
    return economic_unit(owners, "g", "e", r.GENERIC).groupBy("unidade").agg(r.rows(), F.sum("v").cast("double").alias("saldo"))


@query(f"""WITH {r.RAW} SELECT cod_empresa, CAST(SUM(COALESCE(valor, 0)) AS DOUBLE) AS total,
  COUNT(COALESCE(valor, 0)) AS preenchidas FROM clean GROUP BY cod_empresa""")
def p15_zero_fill(t: Tables) -> DataFrame:
    filled = zero_fill(parse_decimal("contrib"))
    return r.raw_lines(t).groupBy(F.trim("coenti").alias("cod_empresa")).agg(
        F.sum(filled).cast("double").alias("total"), F.count(filled).alias("preenchidas")
    )


@query("""WITH done AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS v FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY o_custkey)
SELECT c_custkey, CAST(COALESCE(v, 0) AS DOUBLE) AS total, o_custkey IS NOT NULL AS fl_tem_pedido
FROM customer LEFT JOIN done ON o_custkey = c_custkey""")
def p16_presence(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    done = urgent.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(r.AMOUNT)).alias("v"))
    joined = t.customer.join(done, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        "c_custkey", zero_fill("v").cast("double").alias("total"), F.col("o_custkey").isNotNull().alias("fl_tem_pedido")
    )


@query("""SELECT CASE WHEN year(o_orderdate) <= 2000 THEN CAST(year(o_orderdate) AS VARCHAR) END AS periodo_ano,
  CASE WHEN month(o_orderdate) <= 7 THEN CAST(year(o_orderdate) AS VARCHAR) || '_JAN_JUL' END AS periodo_ytd,
  COUNT(*) AS linhas FROM orders GROUP BY ALL""")
def p17_labels(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    labelled = t.orders.select(
        F.when(year <= r.LAST_FULL_YEAR, year.cast("string")).alias("periodo_ano"),
        F.when(F.month("o_orderdate") <= r.YTD_MONTH, F.concat(year.cast("string"), F.lit("_JAN_JUL"))).alias("periodo_ytd"),
    )
    return labelled.groupBy("periodo_ano", "periodo_ytd").agg(r.rows())


@query(f"""WITH {r.LINES} SELECT s_nationkey, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS total
FROM lines JOIN supplier ON CAST(s_suppkey AS VARCHAR) = cod_empresa
WHERE mes_ref BETWEEN DATE '1999-01-01' AND DATE '1999-12-01' GROUP BY s_nationkey""")
def p18_period_scope(t: Tables) -> DataFrame:
    # cut and totalled before the join
    per_company = (
        r.lines(t, Period.years(1999)).groupBy("cod_empresa").agg(r.rows(), F.sum("valor").alias("total"))
    )
    groups = t.supplier.select(F.col("s_suppkey").cast("string").alias("cod_empresa"), "s_nationkey")
    out = per_company.join(groups, "cod_empresa").groupBy("s_nationkey")
    return r.doubles(out.agg(F.sum("linhas").alias("linhas"), F.sum("total").alias("total")), "total")


_SCOPE = f"""WITH {r.RAW}, v AS (SELECT tipoProd IN ('O', 'F') AND tipoProd IS NOT NULL AS dentro,
  tipoProd IS NULL OR trim(tipoProd) = '' AS vazio, valor FROM clean)
SELECT COUNT(*) FILTER (WHERE dentro) AS linhas_no_escopo, COUNT(*) FILTER (WHERE NOT dentro) AS linhas_fora,
  COUNT(*) FILTER (WHERE vazio) AS linhas_sem_codigo,
  CAST(SUM(valor) FILTER (WHERE dentro) AS DOUBLE) AS valor_no_escopo, CAST(SUM(valor) FILTER (WHERE NOT dentro) AS DOUBLE) AS valor_fora,
  CAST(SUM(valor) FILTER (WHERE vazio) AS DOUBLE) AS valor_sem_codigo,
  round(100 * CAST(SUM(valor) FILTER (WHERE dentro) AS DOUBLE) / CAST(SUM(valor) AS DOUBLE), 6) AS pct_valor_no_escopo FROM v"""


@query(_SCOPE)
def p19_scope(t: Tables) -> DataFrame:
    valued = r.raw_lines(t).withColumn("valor", parse_decimal("contrib"))
    report = scope_filter(valued, "tipoProd", ["O", "F"], "valor")[1]
    report = report.withColumn("pct_valor_no_escopo", F.round("pct_valor_no_escopo", 6))
    return r.doubles(report, "valor_no_escopo", "valor_fora", "valor_sem_codigo")


@query(_SCOPE.replace("FROM clean", "FROM clean WHERE prazo").replace("  FROM lineitem),", "  , l_shipdate >= DATE '1996-03-01' AND l_shipdate < DATE '1998-11-01' AS prazo FROM lineitem),"))
def p19_scope_period(t: Tables) -> DataFrame:
    """The same for the extracts of some months: neither side reads others."""
    valued = r.raw_lines(t, Period.months("1996-03", "1998-10")).withColumn("valor", parse_decimal("contrib"))
    report = scope_filter(valued, "tipoProd", ["O", "F"], "valor")[1]
    report = report.withColumn("pct_valor_no_escopo", F.round("pct_valor_no_escopo", 6))
    return r.doubles(report, "valor_no_escopo", "valor_fora", "valor_sem_codigo")


@query("""SELECT 'cliente' AS origem, c_nationkey AS nacao, COUNT(*) AS linhas FROM customer GROUP BY ALL
UNION ALL SELECT 'fornecedor', s_nationkey, COUNT(*) FROM supplier GROUP BY ALL""")
def p20_tag(t: Tables) -> DataFrame:
    buyers = t.customer.select(F.lit("cliente").alias("origem"), F.col("c_nationkey").alias("nacao"))
    sellers = t.supplier.select(F.lit("fornecedor").alias("origem"), F.col("s_nationkey").alias("nacao"))
    return buyers.unionByName(sellers).groupBy("origem", "nacao").agg(r.rows())
