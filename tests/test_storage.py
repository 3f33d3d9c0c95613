"""Write-test-swap, slices, scratch areas and the file manifest."""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedup import DuplicateKey, require_unique
from tidemark.operators.period import YEAR
from tidemark.session import scratch, scratch_path, shared_folder, stage
from tidemark.sources import TableStore, missing_files, require_files, temporary_store


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, prefix=f"p{uuid.uuid4().hex[:8]}_", root=str(tmp_path))
    made.create_layers(["silver"])
    yield made
    spark.sql(f"DROP SCHEMA IF EXISTS `{made.prefix}silver` CASCADE")


def unique(df):
    require_unique(df, ["id"], "t")


@pytest.mark.parametrize("layout", [{}, {"partition_by": [YEAR]}, {"bucket_by": (3, ["id"])}])
def test_publish_swaps_in_what_passed(spark, store, layout):
    first = spark.range(90).withColumn(YEAR, (F.col("id") % 3).cast("int"))
    store.publish(first, "silver", "t", unique, **layout)
    more = spark.range(200).withColumn(YEAR, (F.col("id") % 4).cast("int")).withColumn("novo", F.lit(1))
    assert store.publish(more, "silver", "t", unique, **layout).count() == 200
    assert store.read("silver", "t").filter(F.col(YEAR) == 3).count() == 50
    with pytest.raises(DuplicateKey):
        store.publish(first.unionByName(first), "silver", "t", unique, **layout)
    kept = store.read("silver", "t")
    assert kept.count() == 200 and "novo" in kept.columns
    assert [r["tableName"] for r in store.list_tables("silver").collect()] == ["t"]


def test_publish_writes_once_and_tests_once(spark, store):
    written = spark.sparkContext.accumulator(0)
    tested = []

    def count(df):
        tested.append(df.count())

    # a side effect in the rows' own plan counts how often it runs
    rows = spark.range(1000, numPartitions=4).rdd.map(lambda r: (written.add(1), r[0])[1:]).toDF("id long")
    store.publish(rows, "silver", "t", count)
    assert tested == [1000] and written.value == 1000


def test_a_swap_that_was_cut_off_is_put_right(spark, store):
    store.publish(spark.range(5), "silver", "t")
    # what a run leaves that ends between the two renames
    store._rename("silver", "t", "t__former")
    store.write_fresh(spark.range(7), "silver", "t")
    assert store.read("silver", "t").count() == 5
    assert store.swap("silver", "t").count() == 7


def test_two_writers_keep_both_slices(spark, store):
    rows = spark.range(40).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k"))
    store.append_slice(rows.filter("id < 4"), "silver", "t", "k")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def write(k):
        store.append_slice(rows.filter(F.col("k") == k), "silver", "t", "k")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, ["a", "b"]))
    write("a")
    assert {r["k"]: r["count"] for r in store.read("silver", "t").groupBy("k").count().collect()} == {"a": 20, "b": 20}
    store.append_slice(rows.limit(1).withColumn("k", F.lit("novo")), "silver", "t", "k")
    assert store.read("silver", "t").count() == 41
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def _local(path):
    return path.removeprefix("file:").replace("//", "/")


def test_a_block_leaves_nothing(spark):
    with scratch(spark) as area:
        inner = stage(spark.range(10), "x")
        assert inner.count() == 10 and inner.inputFiles()[0].replace("file://", "file:").startswith("file:" + _local(area))
        with scratch(spark) as nested:
            assert scratch_path(spark, "y").startswith(nested)
        assert scratch_path(spark, "y").startswith(area)
    assert not os.path.exists(_local(area))
    with pytest.raises(RuntimeError, match="stop"), scratch(spark) as area:
        stage(spark.range(1))
        raise RuntimeError("stop")
    assert not os.path.exists(_local(area))


def test_staged_data_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "z").startswith(shared_folder(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_a_temporary_store_drops_its_schemas(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    with temporary_store(spark, "tmp", ["silver", "gold"]) as store:
        store.overwrite(spark.range(3), "silver", "t")
        assert len({d.name for d in spark.catalog.listDatabases()} - before) == 2
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_manifest_takes_files_and_written_extracts(spark, tmp_path):
    (tmp_path / "A.csv").write_text("x")
    spark.range(10).select(F.lit("b.csv").alias("arquivo"), "id").write.partitionBy("arquivo").csv(str(tmp_path / "out"))
    wanted = ["a.CSV", "B.csv", "c.csv"]
    assert [r["arquivo"] for r in missing_files(spark, str(tmp_path), wanted).collect()] == ["c.csv"]


def test_two_files_of_one_name_are_refused(spark, tmp_path):
    for name in ("A.csv", "a.csv"):
        (tmp_path / name).write_text("x")
    with pytest.raises(ValueError, match="two files for a.csv"):
        require_files(spark, str(tmp_path), ["a.csv"])
