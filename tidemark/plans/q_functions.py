"""F: the scalar functions the builds rely on, one query per family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import first_values
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query


@query("""SELECT p_partkey, trim('  ' || p_name || ' ') AS aparado, length(p_name) AS letras, contains(p_name, 'red') AS vermelho,
  substring(p_brand, 1, 5) AS prefixo, p_brand || '/' || p_type AS junto, concat_ws('-', p_brand, NULL, p_type) AS ligado,
  regexp_matches(p_brand, '^Brand#[0-9]$') AS um_digito, regexp_replace(p_type, '[AEIOU]', '_', 'g') AS sem_vogal, sha256(p_name) AS resumo
FROM part""")
def f1_string(t: Tables) -> DataFrame:
    brand, kind = F.col("p_brand"), F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("aparado"),
        F.length("p_name").alias("letras"),
        F.col("p_name").contains("red").alias("vermelho"),
        F.substring("p_brand", 1, 5).alias("prefixo"),
        F.concat(brand, F.lit("/"), kind).alias("junto"),
        F.concat_ws("-", brand, F.lit(None).cast("string"), kind).alias("ligado"),
        brand.rlike("^Brand#[0-9]$").alias("um_digito"),
        F.regexp_replace("p_type", "[AEIOU]", "_").alias("sem_vogal"),
        F.sha2("p_name", 256).alias("resumo"),
    )


@query(f"""WITH {r.RAW} SELECT COUNT(TRY_CAST(contrib AS DOUBLE)) AS numeros, COUNT(TRY_CAST(trim(QUANTIDADE) AS INTEGER)) AS inteiros,
  CAST(MAX(TRY_CAST(trim(QUANTIDADE) AS BIGINT)) AS VARCHAR) AS maior, CAST(MIN(mes_ref) AS VARCHAR) AS primeiro,
  CAST(SUM(CAST(valor AS DOUBLE) > 50000) AS BIGINT) AS grandes FROM clean""")
def f2_cast(t: Tables) -> DataFrame:
    from tidemark.functions import parse_decimal, parse_month

    number = F.trim("QUANTIDADE")
    return r.raw_lines(t).agg(
        F.count(F.col("contrib").try_cast("double")).alias("numeros"),
        F.count(number.try_cast("int")).alias("inteiros"),
        F.max(number.try_cast("bigint")).cast("string").alias("maior"),
        F.min(parse_month("damesano")).cast("string").alias("primeiro"),
        F.sum((parse_decimal("contrib").cast("double") > 50000).cast("int")).alias("grandes"),
    )


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, strftime(d, '%Y%m') AS ano_mes, CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes,
  CAST(quarter(d) AS INTEGER) AS trimestre, CAST(datediff('month', DATE '1995-01-01', date_trunc('month', d)) AS INTEGER) AS meses,
  CAST(strptime(strftime(d, '%Y%m') || '01', '%Y%m%d') AS DATE) = CAST(date_trunc('month', d) AS DATE) AS igual FROM o""")
def f3_date(t: Tables) -> DataFrame:
    day, first = F.col("o_orderdate").cast("date"), r.month_of("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_format(day, "yyyyMM").alias("ano_mes"),
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        F.quarter(day).alias("trimestre"),
        F.months_between(first, F.lit("1995-01-01").cast("date")).cast("int").alias("meses"),
        (F.to_date(F.concat(F.date_format(day, "yyyyMM"), F.lit("01")), "yyyyMMdd") == first).alias("igual"),
    )


@query("""WITH o AS (SELECT o_custkey, CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS a, CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) AS z FROM orders GROUP BY 1),
d AS (SELECT o_custkey, unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS m FROM o)
SELECT strftime(m, '%Y%m') AS ano_mes, COUNT(*) AS ativos FROM d GROUP BY 1""")
def f3_month_sequence(t: Tables) -> DataFrame:
    """Customers between their first and last order, per month."""
    month = r.month_of("o_orderdate")
    span = t.orders.groupBy("o_custkey").agg(F.min(month).alias("a"), F.max(month).alias("z"))
    months = span.select(F.explode(F.sequence("a", "z", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.groupBy(F.date_format("m", "yyyyMM").alias("ano_mes")).agg(r.rows("ativos"))


@query("""WITH c AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(20,2)) AS v FROM customer)
SELECT c_custkey, CAST(abs(v) AS DOUBLE) AS modulo, CAST(round(v, 0) AS DOUBLE) AS inteiro, CAST(greatest(abs(v), 1) AS DOUBLE) AS piso,
  pow(CAST(v AS DOUBLE), 2) AS quadrado, CAST(sign(v) AS INTEGER) AS sinal, 100 / NULLIF(CAST(v AS DOUBLE), 0) AS inverso,
  CAST(v + v * 2 - 1 AS DOUBLE) AS conta FROM c""")
def f4_math(t: Tables) -> DataFrame:
    v = F.col("v")
    return t.customer.select("c_custkey", F.col("c_acctbal").cast(r.AMOUNT).alias("v")).select(
        "c_custkey",
        F.abs(v).cast("double").alias("modulo"),
        F.round(v, 0).cast("double").alias("inteiro"),
        F.greatest(F.abs(v), F.lit(1)).cast("double").alias("piso"),
        F.pow(v.cast("double"), 2).alias("quadrado"),
        F.signum(v.cast("double")).cast("int").alias("sinal"),
        (100 / F.nullif(v.cast("double"), F.lit(0.0))).alias("inverso"),
        (v + v * 2 - 1).cast("double").alias("conta"),
    )


@query(f"""WITH {r.TRANSFERS} SELECT CASE WHEN valor > 400000 THEN 'alto' WHEN valor > 200000 THEN 'médio' ELSE 'baixo' END AS faixa,
  COALESCE(direcao, 'SEM') AS direcao, cod_produto IS NULL AS sem_produto, COUNT(*) AS linhas FROM transfers GROUP BY ALL""")
def f5_conditional(t: Tables) -> DataFrame:
    size = F.when(F.col("valor") > 400000, "alto").when(F.col("valor") > 200000, "médio").otherwise("baixo")
    by = [size.alias("faixa"), F.coalesce("direcao", F.lit("SEM")).alias("direcao"), F.col("cod_produto").isNull().alias("sem_produto")]
    return r.transfers(t).groupBy(*by).agg(r.rows())


@query("""SELECT o_orderstatus, array_to_string(list_sort(list_distinct(list(o_orderpriority)))[1:3], ',') AS primeiras,
  MAX(CASE o_orderstatus WHEN 'F' THEN 'fechado' WHEN 'O' THEN 'aberto' END) AS nome FROM orders GROUP BY o_orderstatus""")
def f6_collection(t: Tables) -> DataFrame:
    """Literal map and bounded set."""
    names = F.create_map(*[F.lit(x) for x in ("F", "fechado", "O", "aberto")])
    first = first_values(t.orders, ["o_orderstatus"], "o_orderpriority", 3, "primeiras")
    grouped = first.withColumn("primeiras", F.array_join("primeiras", ","))
    return grouped.withColumn("nome", F.try_element_at(names, F.col("o_orderstatus")))


@query("""SELECT c_custkey, '{"nome":"' || c_name || '","segmento":"' || c_mktsegment || '"}' AS sem_nulos,
  '{"nome":"' || c_name || '","grupo":null,"segmento":"' || c_mktsegment || '"}' AS com_nulos FROM customer""")
def f7_json(t: Tables) -> DataFrame:
    """Row as JSON, without and with its NULL fields."""
    row = F.struct(F.col("c_name").alias("nome"), F.lit(None).cast("string").alias("grupo"), F.col("c_mktsegment").alias("segmento"))
    return t.customer.select("c_custkey", F.to_json(row).alias("sem_nulos"), F.to_json(row, {"ignoreNullFields": "false"}).alias("com_nulos"))
