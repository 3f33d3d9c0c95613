"""From raw documents to packed training sequences: language, near-duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir), and its rows are written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import queries
from tidemark.llm.packing import pack
from tidemark.llm.secrets import redact_secrets
from tidemark.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.keep_known_language(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.keep_one_of_each_group(spark, docs, sf_dir)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.drop_contaminated(spark, docs, sf_dir)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, queries.tokenizer_path(), capacity=4096, end_id=1)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Minhash groups, fitted models and best-fit packing have no SQL form; tests compare the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
