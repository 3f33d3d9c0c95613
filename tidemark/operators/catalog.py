"""Column catalogue with domains worked out from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleanse import union_all

CATALOG_SCHEMA = (
    "camada string, tabela string, descricao_tabela string, linhagem string, coluna string, "
    "descricao_coluna string, tipo string, dominio_observado string, pct_nulos double"
)

_RANGED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def is_ranged(dtype: T.DataType) -> bool:
    """Has a smallest and a greatest value worth showing; decided by class, not by type name."""
    return isinstance(dtype, _RANGED)


def profile_columns(df: DataFrame, max_values: int = 12, skip: Sequence[str] = ()) -> DataFrame:
    """One row per column: range or distinct values, and percentage of NULLs.

    Ranges and NULL counts take one aggregate. Distinct values are counted by unpivoting the
    categorical columns and grouping by column and value, so no task ever holds all the values
    of a column; only the first ``max_values`` of each are brought together.
    """
    ranged = [f.name for f in df.schema.fields if is_ranged(f.dataType) and f.name not in skip]
    listed = [f.name for f in df.schema.fields if f.name not in ranged and f.name not in skip]
    order = {c: i for i, c in enumerate(df.columns)}
    text = T.StringType()

    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n{order[c]}") for c in [*ranged, *listed]],
        *[f(F.col(f"`{c}`")).cast(text).alias(f"{tag}{order[c]}") for c in ranged for tag, f in (("a", F.min), ("b", F.max))],
    )
    nulls = lambda c: F.try_divide(100.0 * (F.col("rows") - F.col(f"n{order[c]}")), F.col("rows"))
    missing = F.lit(None).cast(text)
    records = []
    for c in df.columns:
        low, high = (F.col(f"a{order[c]}"), F.col(f"b{order[c]}")) if c in ranged else (missing, missing)
        pct = F.round(nulls(c), 2) if c not in skip else F.lit(None).cast("double")
        records.append(
            F.struct(
                F.lit(c).alias("coluna"),
                F.lit(order[c]).alias("ordem"),
                F.lit(df.schema[c].dataType.simpleString()).alias("tipo"),
                F.lit("json" if c in skip else "faixa" if c in ranged else "lista").alias("especie"),
                low.alias("minimo"),
                high.alias("maximo"),
                pct.alias("pct_nulos"),
            )
        )
    shape = wide.select(F.inline(F.array(*records)))
    if not listed:
        return shape.withColumn("n_distintos", F.lit(None).cast("bigint")).withColumn("valores", F.array().cast("array<string>"))

    cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"`{c}`").cast(text).alias("valor")) for c in listed])
    seen = df.select(F.inline(cells)).filter(F.col("valor").isNotNull()).groupBy("coluna", "valor").count()
    distinct = seen.groupBy("coluna").agg(F.count(F.lit(1)).alias("n_distintos"))
    first = seen.select("coluna", "valor").withColumn("__i", F.row_number().over(Window.partitionBy("coluna").orderBy("valor")))
    first = first.filter(F.col("__i") <= max_values)
    values = first.groupBy("coluna").agg(F.sort_array(F.collect_list("valor")).alias("valores"))
    return shape.join(distinct, "coluna", "left").join(values, "coluna", "left")


def observed_domain(max_values: int = 12, shown: int = 3):
    """Domain text of a profiled column."""
    join = lambda values: F.array_join(values, ", ")
    listed = F.coalesce("valores", F.array().cast("array<string>"))
    count = F.coalesce("n_distintos", F.lit(0))
    few = F.concat(F.lit("{"), join(listed), F.lit("}"))
    many = F.concat(count.cast("string"), F.lit(" valores distintos (ex.: "), join(F.slice(listed, 1, shown)), F.lit(" ...)"))
    bounds = [F.coalesce(c, F.lit("None")) for c in ("minimo", "maximo")]
    spread = F.concat(F.lit("["), bounds[0], F.lit(" ; "), bounds[1], F.lit("]"))
    return (
        F.when(F.col("especie") == "json", "JSON")
        .when(F.col("especie") == "faixa", spread)
        .when(count <= max_values, few)
        .otherwise(many)
    )


def data_catalog(
    tables: Mapping[str, DataFrame],
    table_docs: Mapping[str, tuple[str, str]],
    column_docs: Mapping[str, str],
    max_values: int = 12,
    json_columns: Sequence[str] = ("registro_json",),
) -> DataFrame:
    """One row per column of every ``layer.table``: documentation, type, observed domain, NULLs."""
    parts = []
    for table, df in tables.items():
        about, lineage = table_docs.get(table, ("", ""))
        profile = profile_columns(df, max_values, [c for c in json_columns if c in df.columns])
        pairs = [F.lit(x) for c in df.columns for x in (c, column_docs.get(c, ""))]
        parts.append(
            profile.select(
                F.lit(table.split(".")[0].upper()).alias("camada"),
                F.lit(table).alias("tabela"),
                F.lit(about).alias("descricao_tabela"),
                F.lit(lineage).alias("linhagem"),
                "coluna",
                F.try_element_at(F.create_map(*pairs), F.col("coluna")).alias("descricao_coluna"),
                "tipo",
                observed_domain(max_values).alias("dominio_observado"),
                "pct_nulos",
            )
        )
    return union_all(parts)


def undocumented(catalog: DataFrame) -> DataFrame:
    """Catalogue rows without a description."""
    return catalog.filter(F.coalesce(F.col("descricao_coluna"), F.lit("")) == "")
