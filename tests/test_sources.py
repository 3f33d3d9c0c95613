"""Raw scans, completeness, manifest and table sinks."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path, shared_folder, stage
from tidemark.sources import (
    PROVENANCE,
    TableStore,
    business_columns,
    calendar_months,
    encoding_report,
    file_listing,
    line_counts,
    literal_table,
    load_completeness,
    missing_files,
    months_between_bounds,
    read_raw,
    require_files,
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "Names.CSV").write_bytes("Cod;Nome\n001  ;AÇÃO “boa”\n002;plain\n\n".encode("windows-1252"))
    (tmp_path / "other.csv").write_text("a;b\n1;2\n")
    return str(tmp_path)


def test_read_raw(spark, folder):
    df = read_raw(spark, f"{folder}/Names.CSV", snapshot_date="2026-01-31", max_month="202601")
    assert business_columns(df) == ["Cod", "Nome"] and df.columns[2:] == list(PROVENANCE)
    rows = {r["Cod"]: r for r in df.collect()}
    assert rows["001  "]["Nome"] == "AÇÃO “boa”"
    assert str(rows["002"]["_data_geracao_base"]) == "2026-01-31" and rows["002"]["_mes_referencia_max"] == "202601"
    given = read_raw(spark, f"{folder}/Names.CSV", ["k", "v"], hash_mode="json")
    assert given.columns[:2] == ["k", "v"] and given.count() == 2


def test_completeness(spark, folder):
    path = f"{folder}/Names.CSV"
    whole = read_raw(spark, path)
    assert load_completeness(spark, path, whole).first()["status"] == "OK"
    assert load_completeness(spark, path, whole.limit(1)).first()["status"] == "DIVERGENTE"
    assert line_counts(spark, [path, f"{folder}/other.csv"]).agg(F.sum("linhas_no_arquivo")).first()[0] == 3


def test_manifest(spark, folder):
    assert {r["arquivo"] for r in file_listing(spark, folder).collect()} == {"Names.CSV", "other.csv"}
    assert [r[0] for r in missing_files(spark, folder, ["names.csv", "gone.csv"]).collect()] == ["gone.csv"]
    assert require_files(spark, folder, ["names.csv"])["names.csv"].endswith("Names.CSV")
    with pytest.raises(FileNotFoundError, match="gone"):
        require_files(spark, folder, ["gone.csv"])


def test_encoding_report(spark, folder):
    counts, examples = encoding_report(spark, f"{folder}/Names.CSV", "Cod", "Nome")
    assert {r["encoding"]: r["corrompidos"] for r in counts.collect()} == {"UTF-8": 1, "windows-1252": 0}
    assert [(r["chave"], r["lido_certo"]) for r in examples.collect()] == [("001", "AÇÃO “boa”")]


def test_generated(spark):
    assert calendar_months(spark, "2014-11-01", "2015-02-01").count() == 4
    df = literal_table(spark, [("2014-03-05",), ("2014-06-01",)], "x string").select(F.trunc(F.col("x").cast("date"), "MM").alias("m"))
    assert months_between_bounds(df, F.col("m")).count() == 4
    assert months_between_bounds(df.limit(0), F.col("m")).count() == 0


def test_table_store(spark, tmp_path):
    store = TableStore(spark, prefix="sink_", root=str(tmp_path / "w"))
    store.create_layers(["silver"])
    df = spark.createDataFrame([("A", 1), ("B", 2)], "s string, n int")
    store.overwrite(df, "silver", "t")
    assert store.overwrite(df.select("n"), "silver", "t").columns == ["n"]
    for _ in range(2):
        store.append_slice(df.filter("s = 'A'"), "silver", "u", "s")
        out = store.append_slice(df.filter("s = 'B'"), "silver", "u", "s")
    assert sorted((r["s"], r["n"]) for r in out.collect()) == [("A", 1), ("B", 2)]
    store.comment_table("silver", "u", "it's a table")
    store.comment_columns("silver", "u", {"n": "a \\ 'number'", "s": "slice"})
    described = {r["col_name"]: r for r in store.describe("silver", "u").collect()}
    assert described["n"]["comment"] == "a \\ 'number'" and described["Comment"]["data_type"] == "it's a table"
    assert {r["tableName"] for r in store.list_tables("silver").collect()} == {"t", "u"}
    store.drop("silver", ["t", "missing"])
    assert {r["tableName"] for r in store.list_tables("silver").collect()} == {"u"}


def test_bucketed_tables_are_grouped_and_windowed_without_a_shuffle(spark, tmp_path):
    from tidemark.operators.dedup import rows_per_key
    from tidemark.operators.temporal import trailing_mean

    store = TableStore(spark, prefix="bucket_", root=str(tmp_path / "w"))
    store.create_layers(["silver"])
    base = spark.range(200).select((F.col("id") % 20).cast("string").alias("e"), F.col("id").alias("m"), F.col("id").cast("decimal(20,2)").alias("v"))
    stored = store.overwrite(base, "silver", "a", bucket_by=(4, ["e"]))
    for df in (rows_per_key(stored, ["e", "m"]), trailing_mean(stored, ["e"], "m", "v")):
        assert df.count() == 200
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_stage_reads_back_what_it_wrote(spark):
    staged = stage(spark.range(5).withColumn("d", F.lit("1.50").cast("decimal(20,2)")), "x")
    assert staged.count() == 5 and dict(staged.dtypes)["d"] == "decimal(20,2)"
    assert scratch_path(spark, "y").startswith(shared_folder(spark))


def test_stage_uses_the_folder_the_session_names(tmp_path):
    """The setting is fixed when a session starts, so this takes a session of its own."""
    code = f"""
from pyspark.sql import SparkSession
from tidemark.session import shared_folder, stage
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
assert shared_folder(spark) == "{tmp_path}", shared_folder(spark)
assert stage(spark.range(1)).inputFiles()[0].startswith("file://{tmp_path}/run-")
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    # what the run staged goes with its JVM, which ends a little after Python does
    until = time.monotonic() + 30
    while (left := [d for d in os.listdir(tmp_path) if d.startswith("run-")]) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left


def test_read_raw_goes_by_the_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("damesano;coenti;NEWCOL;tipoProd;contrib\n202601;00001;zz;VGBL;1,5\n", encoding="cp1252")
    df = read_raw(spark, str(tmp_path / "x.csv"), expected=["Coenti", "TipoProd", "Damesano", "Contrib"])
    row = df.first()
    assert (row["coenti"], row["damesano"], row["tipoProd"], row["contrib"], row["NEWCOL"]) == ("00001", "202601", "VGBL", "1,5", "zz")
    with pytest.raises(ValueError, match="Benef"):
        read_raw(spark, str(tmp_path / "x.csv"), expected=["Coenti", "Benef"])
    (tmp_path / "y.csv").write_text("coenti;damesano;NEWCOL;tipoProd;contrib\n00002;202601;zz;VGBL;2\n", encoding="cp1252")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")]).collect()
