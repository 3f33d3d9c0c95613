"""Names, projections, scope and quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import count_where, in_domain, is_blank, outside_domain

QUARANTINE_SCHEMA = "tabela_origem string, motivo string, registro_json string"


def canonical_names(df: DataFrame, standard: Mapping[str, str]) -> DataFrame:
    """Rename columns by a map of lower-case source names; the others keep their name."""
    return df.select(*[F.col(f"`{c}`").alias(standard.get(c.lower(), c)) for c in df.columns])


def name_variants(tables: Mapping[str, DataFrame], standard: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """(table, spelling, standard name) for each column the map covers. Reads schemas only."""
    return [
        (table, column, standard[column.lower()])
        for table, df in tables.items()
        for column in df.columns
        if column.lower() in standard
    ]


def standardize(df: DataFrame, mapping: Mapping[str, str], trim: bool = True) -> DataFrame:
    """Select ``{new name: source column}``, trimmed."""
    source = {new: F.col(f"`{old}`") for new, old in mapping.items()}
    return df.select(*[(F.trim(c) if trim else c).alias(new) for new, c in source.items()])


def undocumented_columns(df: DataFrame, documented: Iterable[str]) -> DataFrame:
    """Columns the documentation does not list, with how many rows fill them; one pass over those columns."""
    known = {d.lower() for d in documented}
    extra = [c for c in df.columns if c.lower() not in known]
    if not extra:
        return df.sparkSession.createDataFrame([], "coluna string, preenchidas long")
    counted = df.agg(*[count_where(~is_blank(F.col(f"`{c}`").cast("string"))).alias(f"n{i}") for i, c in enumerate(extra)])
    rows = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"n{i}").alias("preenchidas")) for i, c in enumerate(extra)])
    return counted.select(F.inline(rows))


def quarantine_record(df: DataFrame, table: str, reason: Column | str) -> DataFrame:
    """Each row as JSON, NULL fields kept, with its table and reason."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    payload = [c for c in df.columns if not c.startswith("__")]
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in payload]), {"ignoreNullFields": "false"})
    return df.select(F.lit(table).alias("tabela_origem"), why.alias("motivo"), record.alias("registro_json"))


def tag_rejects(df: DataFrame, rules: Sequence[tuple[Column, str]], tag: str = "__motivo") -> DataFrame:
    """Add the reason of the first rule a row breaks; NULL for a good row. One pass for any number of rules."""
    reasons = [F.when(F.coalesce(broken, F.lit(False)), F.lit(reason)) for broken, reason in rules]
    return df.withColumn(tag, F.coalesce(*reasons, F.lit(None).cast("string")))


def quarantine(df: DataFrame, broken: Column, table: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """Split into rows to keep and rows to set aside; a condition that is NULL keeps the row, so none is lost."""
    return split_rejects(df, [(broken, reason)], table)


def split_rejects(df: DataFrame, rules: Sequence[tuple[Column, str]], table: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`quarantine`, for an ordered list of (condition, reason)."""
    tagged = tag_rejects(df, rules)
    good = tagged.filter(F.col("__motivo").isNull()).drop("__motivo")
    bad = quarantine_record(tagged.filter(F.col("__motivo").isNotNull()), table, F.col("__motivo"))
    return good, bad


def union_all(frames: Sequence[DataFrame], spark: SparkSession | None = None, schema: str = QUARANTINE_SCHEMA) -> DataFrame:
    """Stack by column name; an empty table of ``schema`` when there is nothing to stack.

    Neighbours are joined pairwise, so a plan over many frames is analysed at logarithmic depth.
    """
    layer = list(frames)
    if not layer:
        if spark is None:
            raise ValueError("an empty union needs a session")
        return spark.createDataFrame([], schema)
    while len(layer) > 1:
        odd = layer[len(layer) // 2 * 2 :]
        layer = [a.unionByName(b) for a, b in zip(layer[::2], layer[1::2], strict=False)] + odd
    return layer[0]


def scope_filter(df: DataFrame, code: str, allowed: Iterable[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Rows in scope, and one row that counts and values what is inside, outside and without a code."""
    codes = list(allowed)
    inside, outside, blank = in_domain(code, codes), outside_domain(code, codes), is_blank(code)
    amount = lambda cond: F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0))
    report = df.agg(
        count_where(inside).alias("linhas_no_escopo"),
        count_where(outside).alias("linhas_fora"),
        count_where(blank).alias("linhas_sem_codigo"),
        amount(inside).alias("valor_no_escopo"),
        amount(outside).alias("valor_fora"),
        amount(blank).alias("valor_sem_codigo"),
    )
    pct = F.try_divide(100 * F.col("valor_no_escopo").cast("double"), (F.col("valor_no_escopo") + F.col("valor_fora")).cast("double"))
    return df.filter(inside), report.withColumn("pct_valor_no_escopo", pct)


def domain_difference(df: DataFrame, code: str, allowed: Iterable[str]) -> DataFrame:
    """Codes seen in the data that the domain does not list, with their rows; NULL is one of them."""
    return df.filter(outside_domain(code, allowed)).groupBy(F.col(code).alias("codigo")).agg(F.count(F.lit(1)).alias("linhas"))
