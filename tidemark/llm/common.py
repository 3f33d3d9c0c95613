"""Small helpers that several of these operators use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows whose texts are Python strings at a time, where an operator needs them as such.
TEXT_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def held_out(doc_id: str) -> Column:
    """False for a row without an id."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def sample_of(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by the hash of ``key``: the same ones whatever the partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(17)), F.col(key)).limit(rows)


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str, columns: dict[str, Column], rows: int) -> DataFrame:
    """Training rows (y and ``columns`` of ``docs``) outside the held-out fold.

    The sample is drawn from the labels' ids alone, so that no text is sorted: at most ``rows`` ids. A row
    whose id or label is null is no example; an id with several labels counts with its largest.
    """
    marks = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isNotNull() & F.col("_id").isNotNull() & (fold("_id") != 0))
        .groupBy("_id")
        .agg(F.max("y").alias("y"))
    )
    marks = sample_of(marks, "_id", rows)
    texts = docs.select(F.col(id_col).alias("_id"), *[c.alias(k) for k, c in columns.items()])
    return texts.join(F.broadcast(marks), "_id").select("y", *columns)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str, rows: int | None = None) -> DataFrame:
    """Apply ``fn`` to each Arrow batch, in slices of at most ``rows`` rows; it returns one batch or several."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = rows or max(1, len(batch))
            for at in range(0, max(1, len(batch)), size):
                out = fn(batch.slice(at, size))
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return df.mapInArrow(over, schema)
