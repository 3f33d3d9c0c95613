"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, quality_model, toxicity
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.pii import replace_personal_data
from tidemark.llm.quality_rules import apply_rules
from tidemark.llm.secrets import find_secrets
from tidemark.llm.whitening import whiten
from tidemark.session import stage

#: The vocabulary that op5 packs by, as its public package names it.
TOKENIZER = "word_bpe_49k.json"
#: The key of the pseudonyms; a deployment passes its own.
PSEUDONYM_KEY = "an example key"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components over four-word shingles at similarity 0.8."""
    return near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)


def op2_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_model.score_quality(docs, quality_model.train(docs, table(spark, folder, "labels")), threshold=0.3)


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it leaks."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, folder, "labels")), threshold=0.5)


def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path(), capacity=4096, end_id=1)


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with pseudonyms, for the documents that hold personal data; the other texts are as they were."""
    return replace_personal_data(table(spark, folder, "documents"), PSEUDONYM_KEY)


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, folder, "embeddings"), anchors=lambda vec_id: vec_id % 100 == 0, label=moved)


def op12_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), weights=(5, 2, 1), most=3)


def op13_whiten(spark: SparkSession, folder: str) -> DataFrame:
    """A deviation beyond a long is null; the operator's own is a decimal."""
    white = whiten(table(spark, folder, "embeddings"), scale=1024.0, shift=100_000, components=8)
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


_OPERATORS = (
    op1_near_dedup,
    op2_quality_model,
    op3_decontaminate,
    op4_toxicity,
    op5_pack,
    op6_language,
    op7_licenses,
    op8_pii,
    op9_secrets,
    op10_quality_rules,
    op11_hard_negatives,
    op12_mix_sources,
    op13_whiten,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _OPERATORS}

#: Where SQL can express the whole result; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op11_hard_negatives": """
        WITH entries AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM entries a JOIN entries b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 100 = 0
        ),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
               n.id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
        QUALIFY rank <= 5
    """,
}


# Stages of corpus_pipeline.py: documents in, documents out, but for the last.


def keep_known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is known: more than half of their letters carry one language.

    Null texts and texts without letters go. Repeated rows are decided alike; all columns stay as they are; an empty table gives no rows.
    """
    return language_id.keep_language(docs, language_id.train(docs), 0.5)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id.

    Rows that repeat an id are one document: the row that is least in order of text and then of the other columns stays. Rows without
    an id and documents without words stay. All columns stay as they are; an empty table gives no rows.
    """
    groups = near_duplicates(docs, shingle=5, percent=80)
    gone = stage(groups.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    again = stage(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated_ids")
    if again.isEmpty():
        return kept
    order = ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    once = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*order)).alias("_least"))
    once = once.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_least.{c}").alias(c) for c in docs.columns])
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that leak no benchmark item.

    Rows without an id are looked at under numbers of their own. Repeated rows go or stay together; null and empty texts leak
    nothing and stay. All columns stay as they are; an empty table, or an empty benchmark, drops nothing.
    """
    bench = table(spark, folder, "benchmark")
    # written before the texts are dealt out: its size is known, and few ids need no shuffle of texts
    leaks = stage(contaminated(docs.where("doc_id is not null"), bench).select("doc_id").distinct(), "leaks")
    kept = docs.join(leaks, "doc_id", "left_anti").select(docs.columns)
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return kept
    numbered = stage(nameless.withColumn("doc_id", F.monotonically_increasing_id()), "nameless")
    found = stage(contaminated(numbered, bench).select("doc_id").distinct(), "leaks")
    clean = numbered.join(found, "doc_id", "left_anti").withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    return kept.where("doc_id is not null").unionByName(clean.select(docs.columns))
