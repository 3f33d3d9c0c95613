"""Catalog tables, one schema per layer."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


#: Names of a table's rows that are not yet tested, and of those that are being replaced.
_FRESH, _FORMER = "{}__fresh", "{}__former"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TableStore:
    """Writes and reads ``<prefix><layer>.<table>`` in the session catalog.

    ``root`` places each layer in a folder of its own; without it the warehouse folder is used.
    """

    def __init__(self, spark: SparkSession, prefix: str = "", root: str | None = None, format: str = "parquet") -> None:
        self.spark = spark
        self.prefix = prefix
        self.root = root.rstrip("/") if root else None
        self.format = format

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def create_layers(self, layers: Iterable[str] = ("bronze", "silver", "gold")) -> None:
        for layer in layers:
            place = f" LOCATION {_quoted(f'{self.root}/{layer}')}" if self.root else ""
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.prefix}{layer}`{place}")

    def drop(self, layer: str, tables: Iterable[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def overwrite(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        bucket_by: tuple[int, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Replace the table, schema included, and return it as stored.

        Partitioned writes are rebalanced on the partition columns first: adaptive execution then
        splits a partition that outgrows a file and merges the ones that stay small. A bucketed table is
        later grouped and windowed by its bucket columns without a shuffle; bucket only by keys whose
        rows are bounded, since a bucket is read by one task.
        """
        if bucket_by:
            df = df.repartition(bucket_by[0], *bucket_by[1])
        elif partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.format(self.format).mode("overwrite").option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
        writer.saveAsTable(self.name(layer, table))
        return self.read(layer, table)

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table).replace("`", ""))

    def _rename(self, layer: str, table: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} RENAME TO {self.name(layer, to)}")
        name = self.name(layer, to)
        if any(c.isPartition for c in self.spark.catalog.listColumns(name.replace("`", ""))):
            # some catalogs keep the partitions' former places, which are to be gone before another table takes them
            self.spark.sql(f"MSCK REPAIR TABLE {name} DROP PARTITIONS")
            self.spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")

    def write_fresh(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None
    ) -> DataFrame:
        """Write ``df`` beside the table, to be tested and then swapped in or dropped."""
        fresh, former = _FRESH.format(table), _FORMER.format(table)
        if self.exists(layer, former) and not self.exists(layer, table):
            self._rename(layer, former, table)  # a run ended between the two renames
        self.drop(layer, [fresh, former])
        return self.overwrite(df, layer, fresh, partition_by, bucket_by)

    def drop_fresh(self, layer: str, tables: Iterable[str]) -> None:
        self.drop(layer, [_FRESH.format(t) for t in tables])

    def swap(self, layer: str, table: str) -> DataFrame:
        """Put the fresh table in the place of the stored one: two renames in the catalog."""
        former = _FORMER.format(table)
        if self.exists(layer, table):
            self._rename(layer, table, former)
        self._rename(layer, _FRESH.format(table), table)
        self.drop(layer, [former])
        return self.read(layer, table)

    def publish(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        test: Callable[[DataFrame], None] | None = None,
        partition_by: Sequence[str] = (),
        bucket_by: tuple[int, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Write, test, swap: ``df`` is written once, tested as stored, and only then takes the table's place.

        ``test`` raises to refuse the new rows; these are dropped, and the table stays as it was.
        """
        try:
            stored = self.write_fresh(df, layer, table, partition_by, bucket_by)
            if test is not None:
                test(stored)
        except BaseException:
            self.drop_fresh(layer, [table])
            raise
        return self.swap(layer, table)

    def append_slice(self, df: DataFrame, layer: str, table: str, slice_column: str) -> DataFrame:
        """Add rows under their value of ``slice_column``; a rerun replaces its slice instead of doubling it.

        Which partitions a write replaces is said to the writer, not the session, so writers of several slices can run at once.
        """
        name = self.name(layer, table)
        if not self.exists(layer, table):
            return self.overwrite(df, layer, table, partition_by=[slice_column])
        stored = self.read(layer, table).columns
        place = self.describe(layer, table).filter("col_name = 'Location'").first()["data_type"]
        writer = df.select(*stored).write.format(self.format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(slice_column).save(place)
        self.spark.sql(f"MSCK REPAIR TABLE {name}")
        self.spark.catalog.refreshTable(name.replace("`", ""))
        return self.read(layer, table)

    def comment_table(self, layer: str, table: str, text: str) -> None:
        self.spark.sql(f"COMMENT ON TABLE {self.name(layer, table)} IS {_quoted(text)}")

    def comment_columns(self, layer: str, table: str, texts: Mapping[str, str]) -> None:
        """Document the columns ``texts`` covers, but for partition columns, which take no comment."""
        name = self.name(layer, table)
        for column in self.spark.catalog.listColumns(name.replace("`", "")):
            if texts.get(column.name) and not column.isPartition:
                self.spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column.name}` COMMENT {_quoted(texts[column.name])}")

    def list_tables(self, layer: str) -> DataFrame:
        listed = self.spark.sql(f"SHOW TABLES IN `{self.prefix}{layer}`")
        return listed.filter(~F.col("isTemporary")).select("namespace", "tableName")

    def describe(self, layer: str, table: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")


@contextmanager
def temporary_store(spark: SparkSession, label: str, layers: Iterable[str] = ("bronze", "silver", "gold")) -> Iterator[TableStore]:
    """A store in the scratch area with schemas of its own, all of which are gone when the block ends."""
    root = scratch_path(spark, label)
    store = TableStore(spark, prefix=root.rsplit("/", 1)[1].replace("-", "_") + "_", root=root)
    names = list(layers)
    store.create_layers(names)
    try:
        yield store
    finally:
        for layer in names:
            spark.sql(f"DROP SCHEMA IF EXISTS `{store.prefix}{layer}` CASCADE")
