"""Session defaults and materialisation in the cluster's shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None, checkpoint_dir: str | None = None
) -> SparkSession:
    """A session with adaptive execution on and dates in UTC. On a cluster leave ``master`` to spark-submit.

    ``checkpoint_dir``: a folder that all executors reach, for staged data; without it the cluster's setting or the warehouse serves.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


#: Scratch areas of the blocks that are open, innermost last, and the area of each Spark application.
_open_areas: ContextVar[tuple[str, ...]] = ContextVar("open_areas", default=())
_run_areas: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, one in the warehouse, which all executors reach too."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidemark-scratch"


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """Hadoop's file system for a path, and the path: the store may be one that only Spark's readers know."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove_folder(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


def _run_area(spark: SparkSession) -> str:
    """One area for everything an application stages outside a block; it goes when the application's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _run_areas:
        path = f"{shared_folder(spark)}/run-{app}-{uuid.uuid4().hex[:8]}"
        files, at = _file_system(spark, path)
        files.mkdirs(at)
        files.deleteOnExit(at)
        _run_areas[app] = path
    return _run_areas[app]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """An area that holds what is staged inside the block and is removed when the block ends, whether or not it fails.

    Read or store every result that rests on staged data before the end of the block.
    """
    path = f"{shared_folder(spark)}/block-{uuid.uuid4().hex}"
    token = _open_areas.set((*_open_areas.get(), path))
    try:
        yield path
    finally:
        _open_areas.reset(token)
        remove_folder(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table, in the innermost open block's area or else the run's."""
    areas = _open_areas.get()
    return f"{areas[-1] if areas else _run_area(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    For a frame that several branches of a plan use: the scan behind it runs once, the
    lineage ends at files that outlive any executor, and each branch reads only its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
