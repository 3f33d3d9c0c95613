"""Recodes, bands, fingerprints and aggregate shorthands."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.parsing import _col
from tidemark.functions.predicates import in_domain


def recode(col: Column | str, mapping: Mapping[str, Any]) -> Column:
    """Look the code up in a literal map; NULL when it is not there. For big maps join a table instead."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _col(col))


def band(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose upper edge (included) holds the value, else the last label; NULL stays NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs one label more than edges")
    c = _col(col)
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels, strict=False):
        chain = chain.when(c <= F.lit(edge), label)
    return chain.otherwise(labels[-1])


def zero_fill(col: Column | str, dtype: str = "decimal(20,2)") -> Column:
    return F.coalesce(_col(col), F.lit(0)).cast(dtype)


def row_hash(columns: Iterable[str], mode: str = "concat") -> Column:
    """SHA-256 of a row.

    ``concat`` joins the values with '|' and reads NULL as '': two different rows can share a
    hash. ``json`` keeps NULLs and quotes values, so only equal rows do.
    """
    names = list(columns)
    if mode == "concat":
        parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names]
        text = F.concat_ws("|", *parts)
    elif mode == "json":
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
    else:
        raise ValueError(f"unknown hash mode {mode!r}")
    return F.sha2(text, 256)


def unit_code(group: Column | str, entity: Column | str, generic_codes: Iterable[str], prefix: str = "EMP_") -> Column:
    """Group code, or the entity itself when the group is a generic one."""
    return F.when(in_domain(group, generic_codes), F.concat(F.lit(prefix), _col(entity))).otherwise(_col(group))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in doubles; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_of_sums(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(F.sum(_col(numerator)), F.sum(_col(denominator)))


def count_where(condition: Column) -> Column:
    """Rows that meet the condition; 0 on an empty table."""
    return F.count(F.when(condition, F.lit(1)))


def sum_where(value: Column | str, condition: Column, dtype: str = "decimal(20,2)") -> Column:
    """Total over the rows that meet the condition, 0 (not NULL) when none does."""
    return F.sum(F.when(condition, _col(value)).otherwise(F.lit(0).cast(dtype)))


def percent_where(condition: Column) -> Column:
    """Share of rows that meet the condition, in percent; rows where it is NULL do not count."""
    return 100 * F.avg(condition.cast("int"))
