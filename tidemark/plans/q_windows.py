"""W, T and U: windows, top rows, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse_decimal
from tidemark.operators.cleanse import domain_difference, union_all
from tidemark.operators.dedup import collapse_duplicates
from tidemark.operators.metrics import share_of_total
from tidemark.operators.period import Period
from tidemark.operators.ranking import global_ranks, top_rows, topk_entities_history, topk_per_group
from tidemark.operators.star import dim_latest
from tidemark.operators.temporal import fill_months, latest_per_key, moving_mean, pct_change, trailing_mean
from tidemark.plans import analyses as an
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query
from tidemark.session import stage


def _month(df: DataFrame) -> DataFrame:
    return df.withColumn("ano_mes", F.date_format("mes_ref", "yyyyMM")).drop("mes_ref")


def _monthly(t: Tables, by: list[str]) -> DataFrame:
    return an.monthly_totals(r.lines(t), ["valor"], by)


_M = f"WITH {r.LINES}, m AS (SELECT cod_produto, mes_ref, SUM(valor) AS v FROM lines GROUP BY ALL)"
_CM = f"WITH {r.LINES}, m AS (SELECT cod_empresa, cod_produto, mes_ref, SUM(valor) AS v FROM lines GROUP BY ALL)"


@query(f"""{_M} SELECT cod_produto, strftime(mes_ref, '%Y%m') AS ano_mes, CAST(v AS DOUBLE) AS valor,
  CAST(v AS DOUBLE) / CAST(LAG(v) OVER (PARTITION BY cod_produto ORDER BY mes_ref) AS DOUBLE) - 1 AS var_pct FROM m""")
def w1_pct_change(t: Tables) -> DataFrame:
    return r.doubles(_month(pct_change(_monthly(t, ["cod_produto"]), ["cod_produto"], "mes_ref", "valor")), "valor")


@query(f"""{_CM} SELECT cod_empresa, cod_produto, strftime(mes_ref, '%Y%m') AS ano_mes, CAST(v AS DOUBLE) AS valor,
  CAST(SUM(v) OVER w AS DOUBLE) / NULLIF(COUNT(*) OVER w, 0) AS media_anterior FROM m
WINDOW w AS (PARTITION BY cod_empresa, cod_produto ORDER BY mes_ref ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""")
def w2_trailing_mean(t: Tables) -> DataFrame:
    by = ["cod_empresa", "cod_produto"]
    return r.doubles(_month(trailing_mean(_monthly(t, by), by, "mes_ref", "valor", 12)), "valor")


@query(f"""{_CM} SELECT cod_empresa, cod_produto, strftime(mes_ref, '%Y%m') AS ano_mes, CAST(v AS DOUBLE) AS valor,
  CAST(SUM(v) OVER w AS DOUBLE) / COUNT(*) OVER w AS media_movel FROM m WHERE mes_ref >= DATE '1998-01-01'
WINDOW w AS (PARTITION BY cod_empresa, cod_produto ORDER BY mes_ref ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def w3_moving_mean(t: Tables) -> DataFrame:
    by = ["cod_empresa", "cod_produto"]
    recent = an.monthly_totals(r.lines(t, Period.months("1998-01")), ["valor"], by)
    return r.doubles(_month(moving_mean(recent, by, "mes_ref", "valor", 3)), "valor")


@query(f"""{_CM}, b AS (SELECT cod_empresa, cod_produto, MIN(mes_ref) AS a, MAX(mes_ref) AS z FROM m GROUP BY ALL),
d AS (SELECT cod_empresa, cod_produto, CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS mes_ref FROM b)
SELECT d.cod_empresa, d.cod_produto, strftime(d.mes_ref, '%Y%m') AS ano_mes, CAST(v AS DOUBLE) AS valor
FROM d LEFT JOIN m k ON k.cod_empresa = d.cod_empresa AND k.cod_produto = d.cod_produto AND k.mes_ref = d.mes_ref""")
def w3_fill_months(t: Tables) -> DataFrame:
    """Calendar-dense series: the months a series skips, as rows."""
    by = ["cod_empresa", "cod_produto"]
    return r.doubles(_month(fill_months(_monthly(t, by), by, "mes_ref")), "valor")


@query("""SELECT o_custkey, o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS dia FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def w4_latest(t: Tables) -> DataFrame:
    slim = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    last = latest_per_key(slim, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return last.withColumn("dia", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


_YEARLY = f"WITH {r.LINES}, u AS (SELECT year(mes_ref) AS ano, cod_produto, cod_empresa, SUM(valor) AS v FROM lines GROUP BY ALL)"


def _yearly(t: Tables) -> DataFrame:
    return r.lines(t).groupBy(F.year("mes_ref").alias("ano"), "cod_produto", "cod_empresa").agg(F.sum("valor").alias("v"))


@query(f"""{_YEARLY} SELECT CAST(ano AS INTEGER) AS ano, cod_produto, cod_empresa, CAST(v AS DOUBLE) AS v,
  CAST(v AS DOUBLE) / CAST(SUM(v) OVER (PARTITION BY ano, cod_produto) AS DOUBLE) AS participacao FROM u""")
def w5_share(t: Tables) -> DataFrame:
    return r.doubles(share_of_total(_yearly(t), ["ano", "cod_produto"], "v"), "v")


_TOP5 = f"""{_YEARLY}, s AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ano, cod_produto ORDER BY v DESC, cod_empresa) AS pos FROM u)
SELECT CAST(ano AS INTEGER) AS ano, cod_produto, cod_empresa, CAST(v AS DOUBLE) AS v, CAST(pos AS INTEGER) AS pos FROM s WHERE pos <= 5"""


@query(_TOP5)
def w6_position(t: Tables) -> DataFrame:
    return r.doubles(topk_per_group(_yearly(t), ["ano", "cod_produto"], "v", 5, ["cod_empresa"]), "v")


@query("""SELECT c_custkey, RANK() OVER (ORDER BY CAST(c_acctbal AS DECIMAL(20,2)) DESC) AS por_saldo,
  RANK() OVER (ORDER BY c_nationkey DESC) AS por_nacao FROM customer""")
def w7_global_rank(t: Tables) -> DataFrame:
    owners = t.customer.select("c_custkey", F.col("c_acctbal").cast(r.AMOUNT).alias("a"), F.col("c_nationkey").cast(r.AMOUNT).alias("b"))
    return global_ranks(owners, ["c_custkey"], ["a", "b"], ["por_saldo", "por_nacao"]).drop("a", "b")


@query(f"""WITH {r.HIST}, {r.CLINES}, u AS (SELECT cod_empresa, MAX(mes_ref) AS ultimo FROM clines GROUP BY ALL),
c AS (SELECT u.cod_empresa, u.ultimo, h.mes_ref, h.cod_grupo, ROW_NUMBER() OVER (PARTITION BY u.cod_empresa ORDER BY h.mes_ref DESC) AS rn
  FROM u JOIN hist h ON h.cod_empresa = u.cod_empresa AND h.mes_ref <= u.ultimo)
SELECT cod_empresa, strftime(ultimo, '%Y%m') AS ultimo, strftime(mes_ref, '%Y%m') AS ano_mes, cod_grupo FROM c WHERE rn = 1""")
def w8_asof_candidates(t: Tables) -> DataFrame:
    """Ranked candidates: the group in force at each company's last month of activity."""
    last = r.customer_lines(t).groupBy("cod_empresa").agg(F.max("mes_ref").alias("ultimo"))
    earlier = r.group_history(t).join(last, "cod_empresa").filter(F.col("mes_ref") <= F.col("ultimo"))
    best = topk_per_group(earlier, ["cod_empresa"], "mes_ref", 1, ["cod_grupo"]).drop("pos")
    return _month(best.withColumn("ultimo", F.date_format("ultimo", "yyyyMM")))


# --- top rows ---------------------------------------------------------------------------------


@query("SELECT o_orderstatus, o_orderpriority, COUNT(*) AS linhas FROM orders GROUP BY ALL ORDER BY 1, 3 DESC")
def t1_sort(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(r.rows()).orderBy("o_orderstatus", F.desc("linhas"))


@query("SELECT COUNT(*) AS linhas FROM (SELECT * FROM orders LIMIT 5)")
def t2_limit(t: Tables) -> DataFrame:
    return t.orders.limit(5).agg(r.rows())


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def t3_top_n(t: Tables) -> DataFrame:
    return top_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS ano, SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS v FROM orders GROUP BY ALL),
lead AS (SELECT o_custkey FROM y WHERE ano BETWEEN 1998 AND 2000 GROUP BY 1 ORDER BY SUM(v) DESC, o_custkey LIMIT 8)
SELECT o_custkey, CAST(ano AS INTEGER) AS ano, CAST(v AS DOUBLE) AS v FROM y WHERE o_custkey IN (SELECT o_custkey FROM lead)""")
def t4_topk_entities(t: Tables) -> DataFrame:
    amount = F.sum(F.col("o_totalprice").cast(r.AMOUNT))
    yearly = stage(t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("ano")).agg(amount.alias("v")), "customer-year")
    return r.doubles(topk_entities_history(yearly, "o_custkey", F.col("v"), 8, F.col("ano").between(1998, 2000)), "v")


@query("""SELECT c_nationkey, c_custkey, c_acctbal, CAST(pos AS INTEGER) AS pos FROM (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS pos FROM customer) WHERE pos <= 5""")
def t5_top5_per_group(t: Tables) -> DataFrame:
    return topk_per_group(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "c_acctbal", 5, ["c_custkey"])


# --- set operations ---------------------------------------------------------------------------


@query("""SELECT papel, nacao, COUNT(*) AS n, CAST(SUM(saldo) AS DOUBLE) AS saldo FROM (
  SELECT 'c' AS papel, c_nationkey AS nacao, CAST(c_acctbal AS DECIMAL(20,2)) AS saldo FROM customer
  UNION ALL SELECT 's', s_nationkey, CAST(s_acctbal AS DECIMAL(20,2)) FROM supplier) GROUP BY ALL""")
def u1_union_by_name(t: Tables) -> DataFrame:
    buyers = t.customer.select(F.lit("c").alias("papel"), F.col("c_nationkey").alias("nacao"), F.col("c_acctbal").cast(r.AMOUNT).alias("saldo"))
    sellers = t.supplier.select(F.col("s_acctbal").cast(r.AMOUNT).alias("saldo"), F.col("s_nationkey").alias("nacao"), F.lit("s").alias("papel"))
    return buyers.unionByName(sellers).groupBy("papel", "nacao").agg(r.rows("n"), F.sum("saldo").cast("double").alias("saldo"))


@query("""SELECT ano, COUNT(*) AS linhas FROM (SELECT year(o_orderdate) AS ano FROM orders UNION ALL
  SELECT year(l_shipdate) FROM lineitem UNION ALL SELECT year(ts) FROM events) GROUP BY ano""")
def u2_fold(t: Tables) -> DataFrame:
    sources = [(t.orders, "o_orderdate"), (t.lineitem, "l_shipdate"), (t.events, "ts")]
    years = union_all([df.select(F.year(c).alias("ano")) for df, c in sources])
    return years.groupBy("ano").agg(r.rows())


@query("""SELECT o_custkey AS chave, strftime(o_orderdate, '%Y%m') AS ano_mes FROM orders WHERE o_orderstatus = 'F' UNION
SELECT o_custkey, strftime(o_orderdate, '%Y%m') FROM orders WHERE o_orderstatus = 'O'""")
def u3_union_distinct(t: Tables) -> DataFrame:
    keys = [F.col("o_custkey").alias("chave"), F.date_format("o_orderdate", "yyyyMM").alias("ano_mes")]
    parts = [t.orders.filter(F.col("o_orderstatus") == s).select(*keys) for s in ("F", "O")]
    return union_all(parts).distinct()


@query("SELECT n_name AS nome FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT s_name FROM supplier")
def u4_union_all(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_name").alias("nome")).unionAll(t.region.select("r_name")).unionAll(t.supplier.select("s_name"))


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def u5_distinct(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("""SELECT o_custkey, o_orderpriority, o_orderstatus, COUNT(*) AS copias FROM orders GROUP BY ALL""")
def u6_dedup(t: Tables) -> DataFrame:
    return collapse_duplicates(t.orders.select("o_custkey", "o_orderpriority", "o_orderstatus"), "copias")


@query(f"WITH {r.RAW} SELECT tipoProd AS codigo, COUNT(*) AS linhas FROM raw WHERE tipoProd IS NULL OR tipoProd NOT IN ('O', 'F') GROUP BY tipoProd")
def u7_domain_difference(t: Tables) -> DataFrame:
    return domain_difference(r.raw_lines(t), "tipoProd", ["O", "F"])


@query("""SELECT o_orderpriority AS cod_grupo, MAX(o_orderkey) AS ultimo FROM orders GROUP BY ALL
UNION ALL SELECT 'NAO_INFORMADO', -1""")
def u8_synthetic_member(t: Tables) -> DataFrame:
    history = t.orders.select(F.col("o_orderpriority").alias("cod_grupo"), F.col("o_orderkey").alias("ultimo"))
    return dim_latest(history, "cod_grupo", ["ultimo"], "ultimo", [], {"cod_grupo": "NAO_INFORMADO", "ultimo": -1})


@query(f"WITH {r.RAW} SELECT CAST(valor AS DOUBLE) AS valor, COUNT(*) AS n FROM clean GROUP BY valor ORDER BY n DESC, valor LIMIT 50")
def t3_frequent_values(t: Tables) -> DataFrame:
    values = r.raw_lines(t).select(parse_decimal("contrib").alias("valor")).groupBy("valor").agg(r.rows("n"))
    return r.doubles(top_rows(values, [F.desc("n"), F.asc_nulls_last("valor")], 50), "valor")
