"""S: scans and sinks. Files and tables written on the way go to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse_decimal, row_hash
from tidemark.operators.cleanse import union_all
from tidemark.operators.dedup import DuplicateKey, require_unique
from tidemark.operators.period import YEAR, by_year
from tidemark.plans import analyses as an
from tidemark.plans import roles as r
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch_path, stage
from tidemark.sources import (
    calendar_months,
    encoding_report,
    literal_table,
    load_completeness,
    missing_files,
    months_between_bounds,
    read_raw,
    temporary_store,
)

COLUMNS = ["COENTI", "DAMESANO", "TIPOTRANSF", "VALOR"]


def _extract(t: Tables) -> DataFrame:
    """Orders as a text extract: padded keys, decimal commas."""
    amount = F.col("o_totalprice").cast(r.AMOUNT).cast("string")
    return t.orders.select(
        F.rpad(F.col("o_custkey").cast("string"), 12, " ").alias("COENTI"),
        F.date_format("o_orderdate", "yyyyMM").alias("DAMESANO"),
        F.col("o_orderstatus").alias("TIPOTRANSF"),
        F.translate(amount, ".", ",").alias("VALOR"),
    )


def _written(df: DataFrame, label: str, encoding: str = "ISO-8859-1") -> str:
    path = scratch_path(df.sparkSession, label)
    options = {"sep": ";", "header": True, "encoding": encoding, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)
    return path


def _raw(t: Tables) -> DataFrame:
    path = _written(_extract(t), "extract")
    return read_raw(t.spark, path, expected=COLUMNS, snapshot_date="2026-01-31", max_month="202601")


_EXTRACT = """extract AS (SELECT rpad(CAST(o_custkey AS VARCHAR), 12, ' ') AS coenti, strftime(o_orderdate, '%Y%m') AS damesano,
  o_orderstatus AS cod, replace(CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR), '.', ',') AS valor,
  CAST(o_totalprice AS DECIMAL(20,2)) AS v FROM orders)"""


@query(f"""WITH {_EXTRACT} SELECT cod, COUNT(*) AS linhas, CAST(SUM(length(coenti)) AS BIGINT) AS letras,
  COUNT(DISTINCT valor) AS textos, CAST(SUM(v) AS DOUBLE) AS total FROM extract GROUP BY cod""")
def s1_text_scan(t: Tables) -> DataFrame:
    return _raw(t).groupBy(F.col("TIPOTRANSF").alias("cod")).agg(
        r.rows(),
        F.sum(F.length("COENTI")).alias("letras"),
        F.count_distinct("VALOR").alias("textos"),
        F.sum(parse_decimal("VALOR")).cast("double").alias("total"),
    )


@query("SELECT o_orderstatus AS cod, COUNT(*) AS linhas, COUNT(*) AS com_arquivo FROM orders GROUP BY ALL")
def s2_source_file(t: Tables) -> DataFrame:
    named = F.col("_arquivo_origem").rlike(r"/extract-[0-9a-f]+/part-.*\.csv$")
    return _raw(t).groupBy(F.col("TIPOTRANSF").alias("cod")).agg(r.rows(), F.count(F.when(named, 1)).alias("com_arquivo"))


@query("""SELECT '2026-01-31' AS snapshot, '202601' AS ultimo_mes, COUNT(*) AS linhas, COUNT(*) AS com_hora FROM orders""")
def s3_snapshot_metadata(t: Tables) -> DataFrame:
    stamp = [F.col("_data_geracao_base").cast("string").alias("snapshot"), F.col("_mes_referencia_max").alias("ultimo_mes")]
    return _raw(t).groupBy(*stamp).agg(r.rows(), F.count("_ts_ingestao").alias("com_hora"))


@query(f"""WITH {_EXTRACT} SELECT sha256(coenti || '|' || damesano || '|' || cod || '|' || valor) AS hash, COUNT(*) AS linhas
FROM extract GROUP BY 1""")
def s4_row_hash(t: Tables) -> DataFrame:
    return _raw(t).groupBy(F.col("_hash_linha").alias("hash")).agg(r.rows())


@query("""SELECT o_orderkey, sha256('{"k":"' || o_orderkey || '","s":"' || o_orderstatus || '","p":"' || o_orderpriority || '"}') AS hash
FROM orders""")
def s4_row_hash_json(t: Tables) -> DataFrame:
    keyed = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    return keyed.select("o_orderkey", row_hash(["k", "s", "p"], "json").alias("hash"))


_STATUS = "SELECT o_orderstatus, COUNT(*) AS linhas, CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL"


@query(_STATUS)
def s5_overwrite_table(t: Tables) -> DataFrame:
    """Written twice with different columns: the second write replaces the first."""
    with temporary_store(t.spark, "overwrite", ["silver"]) as store:
        store.overwrite(t.orders.select("o_orderkey"), "silver", "pedidos")
        amount = F.col("o_totalprice").cast(r.AMOUNT).alias("v")
        stored = store.overwrite(t.orders.select("o_orderstatus", amount), "silver", "pedidos")
        return stage(stored.groupBy("o_orderstatus").agg(r.rows(), F.sum("v").cast("double").alias("total")), "result")


@query(_STATUS)
def s6_append_slice(t: Tables) -> DataFrame:
    """Each slice appended, one of them again: the rerun replaces its slice."""
    with temporary_store(t.spark, "append", ["silver"]) as store:
        slim = t.orders.select(F.col("o_totalprice").cast(r.AMOUNT).alias("v"), "o_orderstatus")
        for status in ("F", "O", "P", "O"):
            stored = store.append_slice(slim.filter(F.col("o_orderstatus") == status), "silver", "pedidos", "o_orderstatus")
        return stage(stored.groupBy("o_orderstatus").agg(r.rows(), F.sum("v").cast("double").alias("total")), "result")


@query("SELECT n_regionkey, COUNT(*) AS linhas FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def s7_table_scan(t: Tables) -> DataFrame:
    with temporary_store(t.spark, "scan", ["silver"]) as store:
        store.overwrite(t.customer.select("c_custkey", "c_nationkey"), "silver", "clientes")
        per_nation = store.read("silver", "clientes").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(r.rows())
        return stage(per_nation.join(t.nation, "n_nationkey").groupBy("n_regionkey").agg(F.sum("linhas").alias("linhas")), "result")


@query("SELECT COUNT(*) AS linhas_no_arquivo, COUNT(*) AS linhas_na_tabela, CAST(0 AS BIGINT) AS divergentes FROM orders")
def s8_line_completeness(t: Tables) -> DataFrame:
    path = _written(_extract(t), "extract")
    counted = load_completeness(t.spark, path, read_raw(t.spark, path, expected=COLUMNS))
    sides = ["linhas_no_arquivo", "linhas_na_tabela"]
    return counted.agg(*[F.sum(s).alias(s) for s in sides], F.count(F.when(F.col("status") != "OK", 1)).alias("divergentes"))


@query("""WITH p(cod, nome) AS (VALUES ('F', 'Fechado'), ('O', 'Aberto'))
SELECT nome, COUNT(*) AS linhas FROM lineitem JOIN p ON cod = l_linestatus GROUP BY nome""")
def s9_literal_table(t: Tables) -> DataFrame:
    products = literal_table(t.spark, [("F", "Fechado"), ("O", "Aberto")], "cod string, nome string")
    counts = t.lineitem.groupBy(F.col("l_linestatus").alias("cod")).agg(r.rows())
    return counts.join(products, "cod").select("nome", "linhas")


@query("""WITH b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS a, date_trunc('month', MAX(o_orderdate)) AS z FROM orders),
d AS (SELECT unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS m FROM b)
SELECT strftime(m, '%Y%m') AS ano_mes, (SELECT COUNT(*) FROM orders WHERE date_trunc('month', o_orderdate) = m) AS pedidos FROM d""")
def s10_calendar(t: Tables) -> DataFrame:
    """Every month between the first and the last order, those without orders included."""
    months = months_between_bounds(t.orders, r.month_of("o_orderdate"))
    hits = t.orders.groupBy(r.month_of("o_orderdate").alias("mes_ref")).agg(r.rows("pedidos"))
    return months.join(hits, "mes_ref", "left").select(F.date_format("mes_ref", "yyyyMM").alias("ano_mes"), F.coalesce("pedidos", F.lit(0)).alias("pedidos"))


@query("""SELECT 'documents' AS tabela, COUNT(*) AS linhas, SUM(CASE WHEN ascii_only THEN 0 ELSE 1 END)::BIGINT AS corrompidos_utf8,
  CAST(0 AS BIGINT) AS corrompidos_1252 FROM (SELECT NOT regexp_matches(text, '[\\x{80}-\\x{FF}]') AS ascii_only FROM documents)""")
def s17_encoding(t: Tables) -> DataFrame:
    """Whole texts written in a single-byte charset and read under two."""
    text = F.regexp_replace("text", r"[\r\n]", " ")
    # characters that the charset lacks are written as references, so none is lost
    referred = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(F.ascii(c) > 255, F.concat(F.lit("&#"), F.ascii(c), F.lit(";"))).otherwise(c)), "")
    wide = text.rlike(r"[^\x{00}-\x{FF}]")
    plain = t.documents.select(F.col("doc_id").cast("string").alias("Coenti"), F.when(wide, referred).otherwise(text).alias("Noenti"))
    path = _written(plain, "texts")
    counts = encoding_report(t.spark, path, "Coenti", "Noenti")[0]
    total = read_raw(t.spark, path, ["Coenti", "Noenti"]).agg(r.rows("corrompidos")).withColumn("encoding", F.lit("rows"))
    columns = {"linhas": "rows", "corrompidos_utf8": "UTF-8", "corrompidos_1252": "windows-1252"}
    return counts.unionByName(total).agg(
        F.first(F.lit("documents")).alias("tabela"),
        *[F.sum(F.when(F.col("encoding") == e, F.col("corrompidos"))).alias(n) for n, e in columns.items()],
    )


@query("""SELECT strftime(m, '%Y%m') AS ano_mes FROM (SELECT unnest(generate_series(DATE '1994-11-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)
WHERE m NOT IN (SELECT date_trunc('month', o_orderdate) FROM orders)""")
def s12_missing_months(t: Tables) -> DataFrame:
    """Expected periods that the data does not bring."""
    expected = calendar_months(t.spark, "1994-11-01", "2001-12-01")
    present = t.orders.select(r.month_of("o_orderdate").alias("mes_ref")).distinct()
    return expected.join(present, "mes_ref", "left_anti").select(F.date_format("mes_ref", "yyyyMM").alias("ano_mes"))


@query("""WITH esperado AS (SELECT 'PEDIDOS_' || y || '.csv' AS arquivo, y FROM generate_series(1990, 2005) g(y))
SELECT arquivo FROM esperado WHERE y NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_orderstatus = 'F')""")
def s12_manifest(t: Tables) -> DataFrame:
    """Extracts of each year written as files of their own, and the expected names that are not among them, whatever their case."""
    done = t.orders.filter("o_orderstatus = 'F'").withColumn("arquivo", F.format_string("pedidos_%d.csv", F.year("o_orderdate")))
    folder = scratch_path(t.spark, "manifest")
    done.repartition("arquivo").select(F.col("o_orderkey").cast("string"), "arquivo").write.partitionBy("arquivo").csv(folder)
    return missing_files(t.spark, folder, [f"PEDIDOS_{year}.csv" for year in range(1990, 2006)])


@query("""SELECT o_orderstatus, COUNT(*) AS linhas, round(100 * CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE)
  / (SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) FROM orders), 6) AS pct_total FROM orders GROUP BY ALL""")
def s16_scalar_fetch(t: Tables) -> DataFrame:
    """A scalar brought to the driver and used in a second plan: the share of each status in the whole."""
    amount = F.col("o_totalprice").cast(r.AMOUNT)
    whole = t.orders.agg(F.sum(amount).alias("v")).first()["v"]
    share = 100 * F.sum(amount).cast("double") / F.lit(float(whole))
    return t.orders.groupBy("o_orderstatus").agg(r.rows(), F.round(share, 6).alias("pct_total"))


@query("SELECT 'clientes' AS tabela, COUNT(*) AS linhas FROM customer UNION ALL SELECT 'pedidos', COUNT(*) FROM orders")
def s13_layers(t: Tables) -> DataFrame:
    """One schema per layer; what each holds is found by listing it."""
    with temporary_store(t.spark, "layers", ["silver", "gold"]) as store:
        store.overwrite(t.customer.select("c_custkey"), "silver", "clientes")
        store.overwrite(t.orders.select("o_orderkey"), "gold", "pedidos")
        counts = []
        for layer in ("silver", "gold"):
            for row in store.list_tables(layer).collect():
                counts.append(store.read(layer, row["tableName"]).agg(r.rows()).select(F.lit(row["tableName"]).alias("tabela"), "linhas"))
        return stage(union_all(counts), "result")


@query("SELECT c_mktsegment, COUNT(*) AS linhas FROM customer GROUP BY ALL")
def s14_rebuild(t: Tables) -> DataFrame:
    """Built twice from scratch: dropping first makes the second build as good as the first."""
    with temporary_store(t.spark, "rebuild", ["silver"]) as store:
        for _ in range(2):
            store.drop("silver", ["clientes"])
            stored = store.overwrite(t.customer.select("c_mktsegment"), "silver", "clientes")
        return stage(stored.groupBy("c_mktsegment").agg(r.rows()), "result")


_TYPES = {"o_orderkey": "bigint", "o_orderpriority": "string", "o_orderstatus": "string"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS coluna, '{k}' AS tipo, COUNT(DISTINCT {c}) AS distintos FROM orders" for c, k in _TYPES.items()))
def s15_describe(t: Tables) -> DataFrame:
    """The stored schema, with the distinct values behind each column."""
    with temporary_store(t.spark, "describe", ["silver"]) as store:
        stored = store.overwrite(t.orders.select(*_TYPES), "silver", "pedidos")
        listed = store.describe("silver", "pedidos").filter(F.col("col_name").isin(list(_TYPES)))
        cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("v")) for c in _TYPES])
        found = stored.select(F.inline(cells)).distinct().groupBy("coluna").agg(r.rows("distintos"))
        return stage(listed.select(F.col("col_name").alias("coluna"), F.col("data_type").alias("tipo")).join(found, "coluna"), "result")


@query("SELECT 'Pedidos. Origem: orders' AS comentario, COUNT(*) AS linhas FROM orders")
def s18_table_comment(t: Tables) -> DataFrame:
    with temporary_store(t.spark, "comment", ["silver"]) as store:
        stored = store.overwrite(t.orders.select("o_orderkey"), "silver", "pedidos")
        store.comment_table("silver", "pedidos", "Pedidos. Origem: orders")
        text = store.describe("silver", "pedidos").filter("col_name = 'Comment'").select("data_type").first()[0]
        return stage(stored.agg(r.rows()).withColumn("comentario", F.lit(text)), "result")


_TEXTS = {"o_orderkey": "Chave do pedido.", "o_orderstatus": "Situação: 'F', 'O' ou 'P'."}


@query(" UNION ALL ".join(
    "SELECT '{}' AS coluna, '{}' AS comentario, COUNT({}) AS preenchidas FROM orders".format(c, x.replace("'", "''"), c) for c, x in _TEXTS.items()))
def s19_column_comment(t: Tables) -> DataFrame:
    with temporary_store(t.spark, "comments", ["silver"]) as store:
        stored = store.overwrite(t.orders.select(*_TEXTS), "silver", "pedidos")
        store.comment_columns("silver", "pedidos", _TEXTS)
        listed = store.describe("silver", "pedidos").filter(F.col("col_name").isin(list(_TEXTS)))
        filled = stored.agg(*[F.count(c).alias(c) for c in _TEXTS])
        cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("preenchidas")) for c in _TEXTS])
        return stage(listed.select(F.col("col_name").alias("coluna"), F.col("comment").alias("comentario")).join(filled.select(F.inline(cells)), "coluna"), "result")

@query(f"""WITH {r.FLOW}
SELECT CAST(year(mes_ref) AS INTEGER) AS ano, cod_produto, round(CAST(SUM(vl_contribuicao) AS DOUBLE) / 1e6, 8) AS contribuicoes_jan_jul_mi,
  round(CAST(SUM(vl_resgate) AS DOUBLE) / 1e6, 8) AS resgates_jan_jul_mi, round(CAST(SUM(vl_contribuicao) - SUM(vl_resgate) AS DOUBLE) / 1e6, 8) AS flcr_jan_jul_mi
FROM flow WHERE month(mes_ref) < 8 AND year(mes_ref) > 1998 GROUP BY ALL""")
def s5_stored_by_year(t: Tables) -> DataFrame:
    """A fact published by year and asked for some years: the other years' partitions are not read."""
    with temporary_store(t.spark, "by_year", ["gold"]) as store:
        stored = store.publish(by_year(r.supplier_fact(t)), "gold", "fato", partition_by=[YEAR])
        return stage(an.ytd_flow(stored, r.calendar(t), 1999, r.MILLIONS), "result")


@query("SELECT o_orderstatus, COUNT(*) AS linhas FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL")
def s5_publish(t: Tables) -> DataFrame:
    """Rows that fail their test leave the stored table as it was."""
    with temporary_store(t.spark, "publish", ["silver"]) as store:
        unique = lambda df: require_unique(df, ["o_orderkey"], "pedidos")
        kept = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus")
        store.publish(kept, "silver", "pedidos", unique)
        try:
            store.publish(kept.unionByName(kept), "silver", "pedidos", unique)
        except DuplicateKey:
            pass
        return stage(store.read("silver", "pedidos").groupBy("o_orderstatus").agg(r.rows()), "result")
