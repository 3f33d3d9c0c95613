"""Null-safe boolean columns: each of these is TRUE or FALSE, never NULL.

A predicate and its negation therefore split a table without losing rows. Those on a value say "not NULL and ..."
rather than hide the condition in a coalesce, so that as filters they reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.parsing import _col, parse_decimal


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_blank(col: Column | str) -> Column:
    """NULL, empty or only spaces."""
    c = _col(col)
    return c.isNull() | (F.trim(c) == "")


def in_domain(col: Column | str, allowed: Iterable[Any]) -> Column:
    """Value is one of ``allowed``; a NULL is not."""
    c = _col(col)
    return c.isNotNull() & c.isin([a for a in allowed if a is not None])


def outside_domain(col: Column | str, allowed: Iterable[Any]) -> Column:
    """Exact complement of :func:`in_domain`: NULL codes are outside."""
    return ~in_domain(col, allowed)


def matches(col: Column | str, pattern: str) -> Column:
    c = _col(col)
    return c.isNotNull() & c.rlike(pattern)


def in_period(col: Column | str, start: Any, end: Any) -> Column:
    """Both ends included."""
    c = _col(col)
    return c.isNotNull() & c.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def has_padding(col: Column | str) -> Column:
    c = _col(col)
    return _sure(c != F.trim(c))


def has_replacement_char(col: Column | str) -> Column:
    """Contains U+FFFD, the mark of bytes read under the wrong charset."""
    return _sure(_col(col).contains("�"))


def not_numeric(col: Column | str, decimal_sep: str = ",") -> Column:
    """Not blank, yet not readable as a number."""
    return ~is_blank(col) & parse_decimal(col, decimal_sep=decimal_sep).isNull()

