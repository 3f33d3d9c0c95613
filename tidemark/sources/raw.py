"""Lossless ingestion of delimited text: every business column stays a string."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import count_where, decode_cp1252, has_replacement_char, row_hash

# The provenance columns every raw table carries.
PROVENANCE = ("_arquivo_origem", "_data_geracao_base", "_mes_referencia_max", "_ts_ingestao", "_hash_linha")

_CP1252_NAMES = {"windows-1252", "cp1252", "windows1252"}


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in PROVENANCE]


def _scan_text_table(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None, sep: str, encoding: str, multiline: bool, expected: Sequence[str] = ()
) -> DataFrame:
    cp1252 = encoding.lower() in _CP1252_NAMES
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("encoding", "ISO-8859-1" if cp1252 else encoding)
    )
    if columns is None:
        header = reader.csv(path).columns
        present = {c.strip().lower() for c in header}
        absent = [c for c in expected if c.lower() not in present]
        if absent:
            raise ValueError(f"{path} lacks columns {absent}; its header has {header}")
        # names come from the header, and every further file must have the same one: nothing is read by position
        reader, columns = reader.option("enforceSchema", False), header
    raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path)
    names = raw.columns
    shown = [(decode_cp1252(F.col(f"`{c}`")) if cp1252 else F.col(f"`{c}`")).alias(c) for c in names]
    # the file path is only known right above the scan
    return raw.select(*shown, F.col("_metadata.file_path").alias(PROVENANCE[0]))


def with_provenance(df: DataFrame, snapshot_date: Any, max_month: str, hash_mode: str = "concat") -> DataFrame:
    """Add snapshot date, last month, load time and row fingerprint next to the source path."""
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.lit(snapshot_date).cast("date").alias(PROVENANCE[1]),
        F.lit(max_month).cast("string").alias(PROVENANCE[2]),
        F.current_timestamp().alias(PROVENANCE[3]),
        row_hash(business_columns(df), hash_mode).alias(PROVENANCE[4]),
    )


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    encoding: str = "windows-1252",
    snapshot_date: Any = None,
    max_month: str | None = None,
    multiline: bool = False,
    hash_mode: str = "concat",
    expected: Sequence[str] = (),
) -> DataFrame:
    """Delimited files to an all-string table with the five provenance columns.

    Names come from the header, which must hold the ``expected`` ones in any order and case: a missing one raises, a
    further one is kept, and files read together must have one header. ``columns`` instead renames by position,
    for files whose own names are of no use.

    Leave ``multiline`` off unless records span lines: only then must a file be read by one task.
    """
    scanned = _scan_text_table(spark, path, columns, sep, encoding, multiline, expected)
    return with_provenance(scanned, snapshot_date, max_month, hash_mode)


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Name, size and path of each file under a folder; contents are not read.

    A file that lies in a folder ``column=name``, as Spark writes an extract of several parts, goes by that name.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    parent = F.element_at(F.split("path", "/"), -2)
    return listing.select(
        F.when(parent.rlike("^[^=]+="), F.regexp_replace(parent, "^[^=]+=", "")).otherwise(F.element_at(F.split("path", "/"), -1)).alias("arquivo"),
        F.round(F.col("length") / 1024 / 1024, 2).alias("tamanho_mb"),
        F.col("path").alias("caminho"),
    )


def missing_files(spark: SparkSession, folder: str, expected: Iterable[str]) -> DataFrame:
    """Expected file names that the folder does not hold, whatever their case."""
    wanted = spark.createDataFrame([(e,) for e in expected], "arquivo string").withColumn("_k", F.lower("arquivo"))
    present = file_listing(spark, folder).select(F.lower("arquivo").alias("_k"))
    return wanted.join(present, "_k", "left_anti").drop("_k")


def require_files(spark: SparkSession, folder: str, expected: Iterable[str]) -> dict[str, str]:
    """Path of each expected file, whatever its case; raises when one is missing or two files go by one name."""
    names = list(expected)
    wanted = {n.lower(): n for n in names}
    rows = file_listing(spark, folder).filter(F.lower("arquivo").isin(list(wanted))).collect()
    found: dict[str, str] = {}
    for r in rows:
        name = wanted[r["arquivo"].lower()]
        if name in found:
            raise ValueError(f"two files for {name}: {found[name]} and {r['caminho']}")
        found[name] = r["caminho"]
    absent = [n for n in names if n not in found]
    if absent:
        raise FileNotFoundError(f"missing in {folder}: {absent}")
    return found


def line_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Data lines per file: lines with any text, less the header."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("arquivo"))
    filled = lines.filter(F.length(F.trim("value")) > 0)
    return filled.groupBy("arquivo").agg((F.count(F.lit(1)) - 1).alias("linhas_no_arquivo"))


def load_completeness(spark: SparkSession, path: str | list[str], table: DataFrame) -> DataFrame:
    """Lines of each file against rows of the table that came from it."""
    loaded = table.groupBy(F.col(PROVENANCE[0]).alias("arquivo")).agg(F.count(F.lit(1)).alias("linhas_na_tabela"))
    both = line_counts(spark, path).join(loaded, "arquivo", "full_outer")
    same = F.coalesce(F.col("linhas_no_arquivo"), F.lit(0)) == F.coalesce(F.col("linhas_na_tabela"), F.lit(0))
    return both.withColumn("status", F.when(same, "OK").otherwise("DIVERGENTE"))


def encoding_report(
    spark: SparkSession, path: str, key: str, text: str, encodings: Sequence[str] = ("UTF-8", "windows-1252"), sep: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """One file under two charsets: counts of damaged values, and the damaged rows side by side."""

    def under(encoding: str, alias: str) -> DataFrame:
        scanned = _scan_text_table(spark, path, None, sep, encoding, False)
        return scanned.select(F.trim(F.col(key)).alias("chave"), F.col(text).alias(alias))

    wrong, right = under(encodings[0], "lido_errado"), under(encodings[1], "lido_certo")

    def damaged(df: DataFrame, alias: str, encoding: str) -> DataFrame:
        hits: Column = count_where(has_replacement_char(alias))
        return df.agg(hits.alias("corrompidos")).select(F.lit(encoding).alias("encoding"), "corrompidos")

    counts = damaged(wrong, "lido_errado", encodings[0]).unionByName(damaged(right, "lido_certo", encodings[1]))
    examples = wrong.filter(has_replacement_char("lido_errado")).join(right, "chave")
    return counts, examples
