"""D: data-quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    count_where,
    has_padding,
    has_replacement_char,
    in_domain,
    is_blank,
    matches,
    not_numeric,
    outside_domain,
    parse_decimal,
    parse_integer,
    parse_month,
    percent_where,
)
from tidemark.operators.cleanse import quarantine, scope_filter, split_rejects, undocumented_columns
from tidemark.operators.combine import (
    conservation,
    coverage_gap,
    orphan_keys,
    percent_reconciled,
    reconcile,
    reconcile_summary,
)
from tidemark.operators.dedup import (
    collapse_duplicates,
    dedup_conserving,
    dedup_report,
    duplicate_keys,
    first_grain_break,
    grain_profile,
    rows_per_key,
)
from tidemark.operators.metrics import (
    continuity_test,
    group_changes,
    implausible_average,
    outliers,
    symmetry_test,
    worst_asymmetry,
)
from tidemark.operators.period import Period
from tidemark.operators.quality import DQSuite, Rule, at_most, count_rule, domain_rule, info, offending_values, zero
from tidemark.operators.star import foreign_key_report, primary_key_report, table_audit
from tidemark.operators.temporal import attribution_summary
from tidemark.plans import analyses as an
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query
from tidemark.session import stage
from tidemark.sources import load_completeness, read_raw
from tidemark.plans.q_sources import COLUMNS, _extract, _written

SHOWN = ["tabela", "dimensao", "regra", "valor_num", "esperado", "status"]


def _row_rule(t: Tables, table: str, df: DataFrame, *rules: Rule) -> DataFrame:
    return DQSuite(t.spark, "SILVER").row(table, df, *rules).results().select(*SHOWN)


def _expect(table: str, dimension: str, rule: str, value: str, status: str, source: str, expected: str = "0") -> str:
    return (
        f"SELECT '{table}' AS tabela, '{dimension}' AS dimensao, '{rule}' AS regra, CAST({value} AS DOUBLE) AS valor_num, "
        f"'{expected}' AS esperado, {status} AS status FROM {source}"
    )


def _zero_status(value: str, otherwise: str) -> str:
    return f"CASE WHEN {value} = 0 THEN 'OK' ELSE '{otherwise}' END"


_BLANK = "COUNT(*) FILTER (WHERE contrib IS NULL OR trim(contrib) = '')"
_BADNUM = "COUNT(*) FILTER (WHERE trim(contrib) <> '' AND valor IS NULL)"
_BADMONTH = "COUNT(*) FILTER (WHERE mes_ref IS NULL)"
_PADDED = "COUNT(*) FILTER (WHERE coenti <> trim(coenti))"
_OUTSIDE = "COUNT(*) FILTER (WHERE tipoProd IS NULL OR tipoProd NOT IN ('O', 'F'))"
_DUPS = "(SELECT COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders)"
_ORPHANS = "(SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))"

_D1 = f"WITH {r.RAW} " + " UNION ALL ".join([
    _expect("raw", "Completude", "contrib informada", _BLANK, _zero_status(_BLANK, "ALERTA"), "clean"),
    _expect("raw", "Validade", "contrib em formato de número", _BADNUM, _zero_status(_BADNUM, "FALHA"), "clean"),
    _expect("raw", "Consistência", "mês interpretável", _BADMONTH, _zero_status(_BADMONTH, "FALHA"), "clean"),
    _expect("raw", "Consistência", "chave sem espaços nas pontas", _PADDED, _zero_status(_PADDED, "ALERTA"), "clean"),
    _expect("raw", "Escopo", "produto da análise", _OUTSIDE, "'INFO'", "clean", "-"),
    _expect("orders", "Unicidade", "uma linha por o_orderkey", _DUPS, _zero_status(_DUPS, "FALHA"), "(SELECT 1)"),
    _expect("orders", "Integridade referencial", "o_custkey consta em customer", _ORPHANS, _zero_status(_ORPHANS, "FALHA"), "(SELECT 1)"),
])


def _suite(t: Tables) -> DQSuite:
    raw = r.raw_lines(t)
    suite = DQSuite(t.spark, "SILVER").row(
        "raw",
        raw,
        count_rule("Completude", "contrib informada", "vazias", is_blank("contrib"), zero("ALERTA")),
        count_rule("Validade", "contrib em formato de número", "textos não convertidos", not_numeric("contrib"), zero()),
        count_rule("Consistência", "mês interpretável", "meses recusados", parse_month("damesano").isNull(), zero()),
        count_rule("Consistência", "chave sem espaços nas pontas", "valores com espaço", has_padding("coenti"), zero("ALERTA")),
        count_rule("Escopo", "produto da análise", "fora", outside_domain("tipoProd", ["O", "F"]), info(), "-"),
    )
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return suite.key("orders", t.orders, ["o_orderkey"]).foreign_key("orders", t.orders, customers, "o_custkey", "customer")


@query(_D1)
def d1_register(t: Tables) -> DataFrame:
    """Seven rules: five in one scan of the raw lines, one grouped count, one join."""
    return _suite(t).results().select(*SHOWN)


_REJECT = """CASE WHEN mes_ref IS NULL THEN 'mês inválido' WHEN tipoProd IS NULL OR tipoProd NOT IN ('O', 'F') THEN 'produto fora do domínio' END"""


@query(f"""WITH {r.RAW}, x AS (SELECT *, {_REJECT} AS motivo FROM clean)
SELECT 'lineitem' AS tabela_origem, motivo, '{{"coenti":"' || coenti || '","damesano":"' || damesano || '","tipoProd":' ||
  CASE WHEN tipoProd IS NULL THEN 'null' ELSE '"' || tipoProd || '"' END || ',"contrib":"' || contrib || '","QUANTIDADE":"' || QUANTIDADE || '"}}'
  AS registro_json FROM x WHERE motivo IS NOT NULL""")
def d2_quarantine(t: Tables) -> DataFrame:
    rules = [(parse_month("damesano").isNull(), "mês inválido"), (outside_domain("tipoProd", ["O", "F"]), "produto fora do domínio")]
    return split_rejects(r.raw_lines(t), rules, "lineitem")[1]


@query(f"""WITH {r.RAW}, x AS (SELECT *, {_REJECT} AS motivo FROM clean)
SELECT tipoProd, COUNT(*) AS linhas, CAST(SUM(valor) AS DOUBLE) AS total FROM x WHERE motivo IS NULL GROUP BY tipoProd""")
def d2_kept(t: Tables) -> DataFrame:
    rules = [(parse_month("damesano").isNull(), "mês inválido"), (outside_domain("tipoProd", ["O", "F"]), "produto fora do domínio")]
    good = split_rejects(r.raw_lines(t), rules, "lineitem")[0]
    return good.groupBy("tipoProd").agg(r.rows(), F.sum(parse_decimal("contrib")).cast("double").alias("total"))


@query("SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicadas FROM lineitem")
def d3_unique(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"""WITH {r.RAW} SELECT {_BADNUM} AS contrib, COUNT(*) FILTER (WHERE trim(QUANTIDADE) <> '' AND
  TRY_CAST(replace(trim(QUANTIDADE), ',', '.') AS DECIMAL(20,2)) IS NULL) AS quantidade FROM clean""")
def d4_non_numeric(t: Tables) -> DataFrame:
    checks = {"contrib": "contrib", "quantidade": "QUANTIDADE"}
    return r.raw_lines(t).agg(*[count_where(not_numeric(c)).alias(n) for n, c in checks.items()])


@query(f"WITH {r.RAW} SELECT {_PADDED} AS coenti, COUNT(*) FILTER (WHERE damesano <> trim(damesano)) AS damesano, COUNT(*) AS linhas FROM clean")
def d5_padding(t: Tables) -> DataFrame:
    return r.raw_lines(t).agg(*[count_where(has_padding(c)).alias(c) for c in ("coenti", "damesano")], r.rows())


@query(f"""WITH {r.RAW}, x AS (SELECT 100 * AVG(CASE WHEN tipoProd IS NULL OR trim(tipoProd) = '' THEN 1 ELSE 0 END) AS p,
  100 * AVG(CASE WHEN contrib IS NULL OR trim(contrib) = '' THEN 1 ELSE 0 END) AS c FROM raw)
SELECT 'raw' AS tabela, 'Completude' AS dimensao, 'tipoProd preenchido' AS regra, round(p, 6) AS valor_num, '-' AS esperado,
  CASE WHEN p < 100 THEN 'OK' ELSE 'ALERTA' END AS status FROM x
UNION ALL SELECT 'raw', 'Completude', 'contrib preenchido', round(c, 6), '-', CASE WHEN c < 100 THEN 'OK' ELSE 'ALERTA' END FROM x""")
def d6_null_pct(t: Tables) -> DataFrame:
    from tidemark.operators.quality import below

    rules = [
        Rule("Completude", f"{c} preenchido", "% nulo/vazio", F.round(percent_where(is_blank(c)), 6), below(100), "-")
        for c in ("tipoProd", "contrib")
    ]
    return _row_rule(t, "raw", r.raw_lines(t), *rules)


@query(_expect("customer", "Consistência", "nome no formato", "COUNT(*) FILTER (WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]{9}'))",
               _zero_status("COUNT(*) FILTER (WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]{9}'))", "FALHA"), "customer"))
def d7_format(t: Tables) -> DataFrame:
    rule = count_rule("Consistência", "nome no formato", "fora do padrão", ~matches("c_name", r"^Customer#\d{9}$"), zero())
    return _row_rule(t, "customer", t.customer, rule)


@query(f"WITH {r.RAW} " + _expect("raw", "Consistência", "mês interpretável", _BADMONTH, _zero_status(_BADMONTH, "ALERTA"), "clean"))
def d8_invalid_month(t: Tables) -> DataFrame:
    rule = count_rule("Consistência", "mês interpretável", "meses recusados", parse_month("damesano").isNull(), zero("ALERTA"))
    return _row_rule(t, "raw", r.raw_lines(t), rule)


@query(f"""WITH {r.RAW} SELECT cod_empresa, COUNT(*) AS sem_produto FROM clean WHERE tipoProd IS NULL OR trim(tipoProd) = '' GROUP BY cod_empresa""")
def d9_mandatory(t: Tables) -> DataFrame:
    bad = quarantine(r.raw_lines(t), is_blank("tipoProd"), "raw", "produto vazio")[1]
    company = F.trim(F.get_json_object("registro_json", "$.coenti"))
    return bad.groupBy(company.alias("cod_empresa")).agg(r.rows("sem_produto"))


@query("SELECT lang AS codigo, COUNT(*) AS linhas FROM documents WHERE lang IS NULL OR lang NOT IN ('en', 'de') GROUP BY lang")
def d10_domain(t: Tables) -> DataFrame:
    from tidemark.operators.cleanse import domain_difference

    return domain_difference(t.documents, "lang", ["en", "de"])


_EVIDENCE = """(SELECT array_to_string(list(v || ': ' || n ORDER BY n DESC, v)[1:{k}], ', ')
  FROM (SELECT COALESCE(CAST({code} AS VARCHAR), 'NULL') AS v, COUNT(*) AS n FROM {source} WHERE {cond} GROUP BY 1))"""


@query(f"""WITH {r.RAW}, bad AS (SELECT * FROM clean WHERE tipoProd IS NULL OR tipoProd NOT IN ('O', 'F')), odd AS (SELECT * FROM clean WHERE mes_ref IS NULL)
SELECT 'produto conhecido' AS regra, CAST(COUNT(*) AS DOUBLE) AS valor_num, {_EVIDENCE.format(k=3, code="tipoProd", source="bad", cond="true")} AS evidencia FROM bad
UNION ALL SELECT 'mês interpretável', CAST(COUNT(*) AS DOUBLE), {_EVIDENCE.format(k=3, code="damesano", source="odd", cond="true")} FROM odd""")
def d10_evidence(t: Tables) -> DataFrame:
    """What offends, by name and with counts, from the aggregate that counts it."""
    suite = DQSuite(t.spark, "SILVER").row(
        "raw",
        r.raw_lines(t),
        domain_rule("Consistência (domínio)", "produto conhecido", "códigos recusados", "tipoProd", outside_domain("tipoProd", ["O", "F"]), zero(), k=3),
        domain_rule("Consistência", "mês interpretável", "meses recusados", "damesano", parse_month("damesano").isNull(), zero(), k=3),
    )
    return suite.results().select("regra", "valor_num", "evidencia")


@query("""SELECT c_mktsegment, COUNT(*) FILTER (WHERE c_acctbal < 0) AS negativas,
  CAST(COALESCE(SUM(CAST(c_acctbal AS DECIMAL(20,2))) FILTER (WHERE c_acctbal < 0), 0) AS DOUBLE) AS soma FROM customer GROUP BY ALL""")
def d11_sign(t: Tables) -> DataFrame:
    v = F.col("c_acctbal").cast(r.AMOUNT)
    total = F.coalesce(F.sum(F.when(v < 0, v)), F.lit(0)).cast("double")
    return t.customer.groupBy("c_mktsegment").agg(count_where(v < 0).alias("negativas"), total.alias("soma"))


@query(_expect("lineitem", "Completude", "desconto > 0", "COUNT(*) FILTER (WHERE l_discount = 0)", "'INFO'", "lineitem", "-"))
def d12_zero(t: Tables) -> DataFrame:
    rule = count_rule("Completude", "desconto > 0", "zeros", F.col("l_discount") == 0, info(), "-")
    return _row_rule(t, "lineitem", t.lineitem, rule)


@query("""SELECT COUNT(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS fora,
  round(100 * CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE)
    / CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE), 6) AS pct_valor FROM orders""")
def d13_scope_report(t: Tables) -> DataFrame:
    valued = t.orders.withColumn("v", F.col("o_totalprice").cast(r.AMOUNT))
    report = scope_filter(valued, "o_orderpriority", ["1-URGENT", "2-HIGH"], "v")[1]
    return report.select(F.col("linhas_fora").alias("fora"), F.round("pct_valor_no_escopo", 6).alias("pct_valor"))


def _copies(t: Tables) -> DataFrame:
    """Lines where transfers lost their key and value: exact copies among them are worth nothing."""
    own = F.col("l_returnflag") != "N"
    text = lambda c: F.when(own, F.col(c).cast("string"))
    return t.lineitem.select(
        F.col("l_suppkey").cast("string").alias("cod_empresa"),
        F.date_format("l_shipdate", "yyyyMM").alias("ano_mes"),
        F.col("l_linestatus").alias("cod_produto"),
        text("l_orderkey").alias("pedido"),
        text("l_linenumber").alias("linha"),
        text("l_partkey").alias("peca"),
        F.when(own, F.translate(F.col("l_extendedprice").cast(r.AMOUNT).cast("string"), ".", ",")).otherwise("0").alias("valor"),
    )


_COPIES = """copies AS (SELECT l_suppkey, strftime(l_shipdate, '%Y%m') AS m, l_linestatus,
  CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS o, CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS n,
  CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS p,
  CASE WHEN l_returnflag <> 'N' THEN CAST(l_extendedprice AS DECIMAL(20,2)) ELSE 0 END AS v FROM lineitem),
d AS (SELECT *, COUNT(*) AS k FROM copies GROUP BY ALL)"""


@query(f"""SELECT COUNT(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS fora,
  {_EVIDENCE.format(k=2, code="o_orderpriority", source="orders", cond="o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")} AS quais FROM orders""")
def d13_outside_codes(t: Tables) -> DataFrame:
    """Rows left out, and the commonest codes among them, in one scan."""
    out = outside_domain("o_orderpriority", ["1-URGENT", "2-HIGH"])
    return t.orders.agg(count_where(out).alias("fora"), offending_values("o_orderpriority", out, 2).alias("quais"))


@query(f"""WITH {_COPIES} SELECT CAST(SUM(k) AS BIGINT) AS linhas_antes, COUNT(*) AS linhas_depois, CAST(SUM(k - 1) AS BIGINT) AS linhas_removidas,
  CAST(SUM(v * (k - 1)) AS DOUBLE) AS soma_removida, CAST(SUM(abs(v) * (k - 1)) AS DOUBLE) AS modulo_removido FROM d""")
def d14_dedup_report(t: Tables) -> DataFrame:
    out = dedup_report(collapse_duplicates(_copies(t)), parse_decimal("valor"))
    return r.doubles(out, "soma_removida", "modulo_removido")


@query(f"""WITH {_COPIES} SELECT l_linestatus AS cod_produto, COUNT(*) AS linhas, CAST(SUM(v) AS DOUBLE) AS total FROM d GROUP BY ALL""")
def d14_dedup_conserving(t: Tables) -> DataFrame:
    """Gate and result from one staged shuffle."""
    collapsed = stage(collapse_duplicates(_copies(t)), "collapsed")
    kept = dedup_conserving(collapsed, parse_decimal("valor"))
    return kept.groupBy("cod_produto").agg(r.rows(), F.sum(parse_decimal("valor")).cast("double").alias("total"))


@query("""WITH k AS (SELECT o_custkey, year(o_orderdate) AS ano, month(o_orderdate) AS mes, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT CAST(ano AS INTEGER) AS ano, round(AVG(n), 6) AS media_linhas_por_chave, MAX(n) AS max_linhas_por_chave FROM k GROUP BY ano""")
def d15_grain(t: Tables) -> DataFrame:
    keyed = t.orders.select("o_custkey", r.month_of("o_orderdate").alias("mes_ref"))
    out = grain_profile(keyed, ["o_custkey", "mes_ref"], {"ano": F.year("mes_ref")})
    return out.withColumn("media_linhas_por_chave", F.round("media_linhas_por_chave", 6))


@query("""WITH k AS (SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS m, COUNT(*) AS n FROM orders GROUP BY ALL)
SELECT MIN(m) AS primeira_quebra FROM k WHERE n > 1""")
def d15_first_break(t: Tables) -> DataFrame:
    keyed = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("m"))
    return first_grain_break(keyed, ["o_custkey", "m"], "m")


@query(f"""WITH {r.FLOW}, m AS (SELECT cod_produto, mes_ref, SUM(vl_resgate) AS v FROM flow GROUP BY ALL),
c AS (SELECT cod_produto, mes_ref, abs(CAST(v AS DOUBLE) / CAST(LAG(v) OVER (PARTITION BY cod_produto ORDER BY mes_ref) AS DOUBLE) - 1) AS x FROM m),
s AS (SELECT cod_produto, MAX(x) FILTER (WHERE mes_ref = DATE '1998-06-01') AS variacao_abs,
  quantile_disc(x, 0.9) FILTER (WHERE mes_ref BETWEEN DATE '1996-01-01' AND DATE '2000-12-01') AS limite FROM c GROUP BY cod_produto)
SELECT *, CASE WHEN variacao_abs <= limite THEN 'OK' ELSE 'ALERTA' END AS status FROM s""")
def d16_continuity(t: Tables) -> DataFrame:
    monthly = an.monthly_totals(r.flow_rows(t), ["vl_resgate"])
    return continuity_test(monthly, ["cod_produto"], "mes_ref", "vl_resgate", "1998-06-01", "1996-01-01", "2000-12-01")


_SYM = f"""WITH {r.FLOW}, s AS (SELECT CAST(year(mes_ref) AS INTEGER) AS ano, SUM(vl_portab_aceita) AS e, SUM(vl_portab_cedida) AS x FROM flow GROUP BY 1),
d AS (SELECT ano, CAST(e AS DOUBLE) AS entrada, CAST(x AS DOUBLE) AS saida, round(100 * CAST(e - x AS DOUBLE) / CAST(x AS DOUBLE), 2) AS dif_pct FROM s)"""


@query(f"{_SYM} SELECT * FROM d")
def d17_symmetry(t: Tables) -> DataFrame:
    return r.doubles(symmetry_test(r.flow_rows(t), F.year("mes_ref"), "vl_portab_aceita", "vl_portab_cedida"), "entrada", "saida")


@query(f"{_SYM} SELECT MAX(abs(dif_pct)) AS maior_dif_pct, CASE WHEN MAX(abs(dif_pct)) < 15 THEN 'OK' ELSE 'ALERTA' END AS status FROM d WHERE ano <= 2000")
def d17_worst_year(t: Tables) -> DataFrame:
    return worst_asymmetry(symmetry_test(r.flow_rows(t), F.year("mes_ref"), "vl_portab_aceita", "vl_portab_cedida"), F.col("ano") <= 2000)


@query(f"""WITH {r.CLINES}, f AS (SELECT cod_empresa, mes_ref, SUM(valor) AS v FROM clines WHERE tipo = 'R' GROUP BY ALL),
s AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS cod_empresa, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_ref FROM orders)
SELECT COUNT(*) AS sem_estoque, CAST(SUM(v) AS DOUBLE) AS valor_sem_estoque FROM f
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cod_empresa = f.cod_empresa AND s.mes_ref = f.mes_ref)""")
def d18_coverage(t: Tables) -> DataFrame:
    keys = ["cod_empresa", "mes_ref"]
    flow = r.customer_lines(t).filter("tipo = 'R'").groupBy(*keys).agg(F.sum("valor").alias("v"))
    stock = t.orders.select(F.col("o_custkey").cast("string").alias("cod_empresa"), r.month_of("o_orderdate").alias("mes_ref")).distinct()
    return r.doubles(coverage_gap(flow, stock, keys, "v"), "valor_sem_estoque")


_RECON = """WITH a AS (SELECT o_orderkey AS k, o_orderpriority AS p, CAST(o_totalprice AS DECIMAL(20,2)) AS a FROM orders),
b AS (SELECT l_orderkey AS k, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DECIMAL(20,2)) AS b
  FROM lineitem GROUP BY 1),
j AS (SELECT COALESCE(a.k, b.k) AS k, a, b, COALESCE(a, 0) - COALESCE(b, 0) AS d FROM a FULL OUTER JOIN b ON a.k = b.k),
x AS (SELECT *, round(CAST(abs(d) AS DOUBLE) / greatest(CAST(abs(COALESCE(a, 0)) AS DOUBLE), 1), 6) AS pc FROM j),
c AS (SELECT k, a, b, d, pc, CASE WHEN b IS NULL THEN 'SO_FONTE_A' WHEN a IS NULL THEN 'SO_FONTE_B' WHEN pc <= 0.001 THEN 'ATE_0,1%'
  WHEN pc <= 0.01 THEN 'ATE_1%' WHEN pc <= 0.05 THEN 'ATE_5%' ELSE 'ACIMA_5%' END AS classe FROM x)"""


def _reconciled(t: Tables) -> DataFrame:
    """Order totals against the sum of their lines with discount and tax."""
    rate = lambda c: F.col(c).cast("decimal(4,2)")
    one = F.lit(1).cast("decimal(4,2)")
    line = F.col("l_extendedprice").cast("decimal(12,2)") * (one - rate("l_discount")) * (one + rate("l_tax"))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("chave")).agg(F.sum(line).cast(r.AMOUNT).alias("v"))
    orders = t.orders.select(F.col("o_orderkey").alias("chave"), F.col("o_totalprice").cast(r.AMOUNT).alias("v"))
    return reconcile(orders, lines, ["chave"], "v")


@query(f"""{_RECON} SELECT k AS chave, CAST(a AS DOUBLE) AS vl_fonte_a, CAST(b AS DOUBLE) AS vl_fonte_b, CAST(d AS DOUBLE) AS vl_diferenca,
  pc AS pc_diferenca, classe AS classe_conciliacao FROM c""")
def d19_reconcile(t: Tables) -> DataFrame:
    return r.doubles(_reconciled(t), "vl_fonte_a", "vl_fonte_b", "vl_diferenca", "pc_diferenca")


@query(f"""{_RECON} SELECT classe AS classe_conciliacao, COUNT(*) AS linhas, round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS pct FROM c GROUP BY classe""")
def d20_reconcile_summary(t: Tables) -> DataFrame:
    return reconcile_summary(_reconciled(t))


@query(f"""{_RECON}, y AS (SELECT c.*, year(o_orderdate) AS ano FROM c JOIN orders ON o_orderkey = c.k),
s AS (SELECT ano, classe, round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY ano), 1) AS pct FROM y GROUP BY ano, classe)
SELECT CAST(ano AS INTEGER) AS ano, round(COALESCE(SUM(pct) FILTER (WHERE classe IN ('ATE_0,1%', 'ATE_1%', 'ATE_5%')), 0), 1) AS pct_conciliado,
  CASE WHEN COALESCE(SUM(pct) FILTER (WHERE classe IN ('ATE_0,1%', 'ATE_1%', 'ATE_5%')), 0) >= 4 THEN 'OK' ELSE 'ALERTA' END AS status FROM s GROUP BY ano""")
def d20_percent_reconciled(t: Tables) -> DataFrame:
    dated = t.orders.select(F.col("o_orderkey").alias("chave"), F.year("o_orderdate").alias("ano"))
    out = percent_reconciled(_reconciled(t).join(dated, "chave"), ["ano"], ("ATE_0,1%", "ATE_1%", "ATE_5%"), 4)
    return out.withColumn("pct_conciliado", F.round("pct_conciliado", 1))


@query("SELECT DISTINCT user_id AS c_custkey FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def d21_orphans(t: Tables) -> DataFrame:
    known = t.customer.filter("c_acctbal > 0")
    return orphan_keys(t.events.select(F.col("user_id").alias("c_custkey")), known, "c_custkey")


@query(f"""WITH {r.LINES}, m AS (SELECT cod_empresa, cod_produto, mes_ref, SUM(valor) AS v FROM lines WHERE mes_ref >= DATE '1996-01-01' GROUP BY ALL),
s AS (SELECT *, CAST(SUM(v) OVER w AS DOUBLE) / NULLIF(COUNT(*) OVER w, 0) AS media FROM m
  WINDOW w AS (PARTITION BY cod_empresa, cod_produto ORDER BY mes_ref ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
SELECT cod_empresa, cod_produto, strftime(mes_ref, '%Y%m') AS ano_mes, CAST(v AS DOUBLE) AS valor, media AS media_anterior,
  CAST(v AS DOUBLE) / media AS multiplo FROM s WHERE media > 0 AND CAST(v AS DOUBLE) > 2.5 * media AND v > 100000""")
def d22_outlier(t: Tables) -> DataFrame:
    by = ["cod_empresa", "cod_produto"]
    monthly = an.monthly_totals(r.lines(t, Period.months("1996-01")), ["valor"], by)
    out = outliers(monthly, by, "mes_ref", "valor", 12, 2.5, 100000)
    return r.doubles(out.withColumn("ano_mes", F.date_format("mes_ref", "yyyyMM")).drop("mes_ref"), "valor")


@query(f"""WITH {r.RAW}, f AS (SELECT tipoProd, CASE WHEN qt IS NULL THEN NULL WHEN qt > 0 THEN CAST(valor AS DOUBLE) / qt < 1500 ELSE FALSE END AS fl FROM clean)
SELECT tipoProd, fl AS fl_suspeita, COUNT(*) AS linhas FROM f GROUP BY ALL""")
def d23_unit_average(t: Tables) -> DataFrame:
    flag = implausible_average(parse_integer("QUANTIDADE"), parse_decimal("contrib"), 1500)
    return r.raw_lines(t).groupBy("tipoProd", flag.alias("fl_suspeita")).agg(r.rows())


@query("""SELECT lang, COUNT(*) AS textos, COUNT(*) FILTER (WHERE contains(text, chr(65533))) AS corrompidos,
  COUNT(*) FILTER (WHERE trim(text) = '') AS vazios FROM documents GROUP BY lang""")
def d24_encoding(t: Tables) -> DataFrame:
    return t.documents.groupBy("lang").agg(
        r.rows("textos"), count_where(has_replacement_char("text")).alias("corrompidos"), count_where(is_blank("text")).alias("vazios")
    )


@query("""SELECT 'l_tax' AS coluna, COUNT(l_tax) AS preenchidas FROM lineitem UNION ALL SELECT 'l_linestatus', COUNT(l_linestatus) FROM lineitem""")
def d25_schema_drift(t: Tables) -> DataFrame:
    documented = ["L_ORDERKEY", "L_PARTKEY", "L_SUPPKEY", "L_LINENUMBER", "L_QUANTITY", "L_EXTENDEDPRICE", "L_DISCOUNT", "L_RETURNFLAG", "L_SHIPDATE"]
    return undocumented_columns(t.lineitem, documented)


@query("""SELECT 'lineitem' AS tabela, 'l_suppkey' AS nome_original, COUNT(DISTINCT l_suppkey) AS chaves FROM lineitem
UNION ALL SELECT 'supplier', 's_suppkey', COUNT(DISTINCT s_suppkey) FROM supplier""")
def d26_name_variants(t: Tables) -> DataFrame:
    """Spellings of one concept, with the keys each of them brings."""
    from tidemark.operators.cleanse import name_variants, union_all

    tables = {"lineitem": t.lineitem, "supplier": t.supplier, "nation": t.nation}
    found = name_variants(tables, {"l_suppkey": "cod_empresa", "s_suppkey": "cod_empresa"})
    counted = [
        tables[table].select(c).distinct().agg(r.rows("chaves")).select(F.lit(table).alias("tabela"), F.lit(c).alias("nome_original"), "chaves")
        for table, c, _ in found
    ]
    return union_all(counted)


@query(f"WITH {r.RAW} SELECT round(100 * AVG(CASE WHEN contains(contrib, ',') THEN 1 ELSE 0 END), 6) AS pct_virgula FROM raw")
def d27_decimal_comma(t: Tables) -> DataFrame:
    return r.raw_lines(t).agg(F.round(percent_where(F.col("contrib").contains(",")), 6).alias("pct_virgula"))


@query(f"""WITH {r.HIST} SELECT cod_empresa, COUNT(DISTINCT cod_grupo) AS n_grupos, string_agg(DISTINCT cod_grupo, ',' ORDER BY cod_grupo) AS grupos
FROM hist GROUP BY cod_empresa HAVING COUNT(DISTINCT cod_grupo) > 1""")
def d28_changes(t: Tables) -> DataFrame:
    return group_changes(r.group_history(t), "cod_empresa", "cod_grupo").withColumn("grupos", F.array_join("grupos", ","))


@query("""SELECT COUNT(*) AS linhas_no_arquivo, COUNT(*) AS linhas_na_tabela, 'OK' AS status FROM lineitem""")
def d29_load_completeness(t: Tables) -> DataFrame:
    extract = r.raw_lines(t)
    path = _written(extract, "lines")
    counted = load_completeness(t.spark, path, read_raw(t.spark, path, expected=extract.columns))
    return counted.groupBy("status").agg(F.sum("linhas_no_arquivo").alias("linhas_no_arquivo"), F.sum("linhas_na_tabela").alias("linhas_na_tabela"))


_PKS = {"customer": ["c_custkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "nation": ["n_nationkey"], "region": ["r_regionkey"], "lineitem": ["l_orderkey", "l_linenumber"]}


@query(" UNION ALL ".join(f"SELECT '{t}' AS tabela, COUNT(*) - COUNT(DISTINCT ({', '.join(k)})) AS duplicadas FROM {t}" for t, k in _PKS.items()))
def d30_pk(t: Tables) -> DataFrame:
    return primary_key_report({name: (getattr(t, name), keys) for name, keys in _PKS.items()})


_FKS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("events", "user_id", "supplier", "s_suppkey"),
]


@query(" UNION ALL ".join(
    f"SELECT '{c}.{k}' AS referencia, (SELECT COUNT(*) FROM {c} WHERE {k} NOT IN (SELECT {pk} FROM {p})) AS orfaos" for c, k, p, pk in _FKS))
def d31_fk(t: Tables) -> DataFrame:
    return foreign_key_report({f"{c}.{k}": (getattr(t, c), k, getattr(t, p), pk) for c, k, p, pk in _FKS})


@query("""SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicadas,
  COUNT(*) FILTER (l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) AS orfaos_l_suppkey,
  COUNT(*) FILTER (pedido_conhecido IS NULL) AS orfaos_l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,2))) AS DOUBLE) AS total_valor
FROM (SELECT l.*, o_orderkey AS pedido_conhecido FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey)""")
def d31_audit(t: Tables) -> DataFrame:
    """Key, two references and a total of the lines from one scan of them."""
    lines = t.lineitem.withColumn("valor", F.col("l_extendedprice").cast(r.AMOUNT))
    known = {"l_suppkey": (t.supplier.filter("s_acctbal > 0"), "s_suppkey"), "l_orderkey": (t.orders.filter("o_orderstatus <> 'P'"), "o_orderkey")}
    return r.doubles(table_audit(lines, ["l_orderkey", "l_linenumber"], known, ["valor"]), "total_valor")


@query(f"""WITH {r.FACT} SELECT m AS metrica, CAST(antes AS DOUBLE) AS antes, CAST(depois AS DOUBLE) AS depois, CAST(depois - antes AS DOUBLE) AS diferenca,
  CASE WHEN antes = depois THEN 'OK' ELSE 'FALHA' END AS status FROM (
SELECT 'vl_contribuicao' AS m, (SELECT SUM(vl_contribuicao) FROM flow) AS antes, (SELECT SUM(vl_contribuicao) FROM fact) AS depois
UNION ALL SELECT 'vl_resgate', (SELECT SUM(vl_resgate) FROM flow), (SELECT SUM(vl_resgate) FROM fact)
UNION ALL SELECT 'vl_portab_aceita', (SELECT SUM(vl_portab_aceita) FROM flow), (SELECT SUM(vl_portab_aceita) FROM fact)
UNION ALL SELECT 'vl_portab_cedida', (SELECT SUM(vl_portab_cedida) FROM flow), (SELECT SUM(vl_portab_cedida) FROM fact))""")
def d32_conservation(t: Tables) -> DataFrame:
    measures = ["vl_contribuicao", "vl_resgate", "vl_portab_aceita", "vl_portab_cedida"]
    out = conservation(r.flow_rows(t), r.supplier_fact(t), {m: m for m in measures})
    return r.doubles(out, "antes", "depois", "diferenca")


@query(f"WITH {r.BRIDGE} SELECT tipo_atribuicao, COUNT(*) AS linhas, MAX(meses_defasagem) AS max_defasagem FROM bridge GROUP BY tipo_atribuicao")
def d33_attribution(t: Tables) -> DataFrame:
    return attribution_summary(r.customer_bridge(t))


@query("""SELECT 'orders' AS tabela, 'status no domínio' AS regra, CAST(COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) AS DOUBLE) AS valor_num, 'OK' AS status FROM orders
UNION ALL SELECT 'orders', 'valor >= 0', CAST(COUNT(*) FILTER (WHERE o_totalprice < 0) AS DOUBLE), 'OK' FROM orders
UNION ALL SELECT 'orders', 'uma linha por o_orderkey', 0, 'OK'""")
def d34_gate(t: Tables) -> DataFrame:
    """Results that pass the gate; a FALHA among them would raise."""
    suite = DQSuite(t.spark, "GOLD").row(
        "orders",
        t.orders,
        count_rule("Validade", "status no domínio", "fora", ~in_domain("o_orderstatus", ["F", "O", "P"]), zero()),
        count_rule("Validade", "valor >= 0", "negativos", F.col("o_totalprice") < 0, at_most(0)),
    )
    results = stage(suite.key("orders", t.orders, ["o_orderkey"]).results(), "results")
    DQSuite.enforce(results)
    return results.select("tabela", "regra", "valor_num", "status")


@query("""WITH k AS (SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS m, COUNT(*) AS n FROM orders GROUP BY ALL) SELECT n AS linhas, COUNT(*) AS chaves FROM k GROUP BY n""")
def d15_rows_per_key(t: Tables) -> DataFrame:
    keyed = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("m"))
    return rows_per_key(keyed, ["o_custkey", "m"]).groupBy("linhas").agg(r.rows("chaves"))
