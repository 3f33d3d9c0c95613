"""Months asked for, as bounds that a scan can use.

A month that is worked out from a raw date hides that date from the scan: a filter on ``trunc(date)`` is
evaluated row by row and no file is skipped. A :class:`Period` therefore knows two conditions, one on the month and one on the
raw date, which say the same; a frame made by :func:`with_month` is cut by the latter before anything else sees it. Facts
that are stored by year carry :data:`YEAR`; :func:`during` and :func:`on_calendar` use it to leave whole partitions unread.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parsing import _col

#: Partition column of facts that are stored by year.
YEAR = "ano_ref"

Bound = dt.date | str | None


def _first_day(bound: Bound) -> dt.date | None:
    if bound is None:
        return None
    day = bound if isinstance(bound, dt.date) else dt.date.fromisoformat(bound if len(bound) > 7 else f"{bound}-01")
    return day.replace(day=1)


def _moved(month: dt.date, by: int) -> dt.date:
    at = month.year * 12 + month.month - 1 + by
    return dt.date(at // 12, at % 12 + 1, 1)


@dataclass(frozen=True)
class Period:
    """Ranges of months, both ends included; None is an open end. Build one with the class methods."""

    ranges: tuple[tuple[dt.date | None, dt.date | None], ...]

    @classmethod
    def months(cls, first: Bound = None, last: Bound = None) -> Period:
        """From the month of one date to the month of another."""
        return cls(((_first_day(first), _first_day(last)),))

    @classmethod
    def years(cls, *years: int) -> Period:
        """Whole years; neighbouring ones become one range."""
        ranges: list[tuple[dt.date, dt.date]] = []
        for year in sorted(set(years)):
            first, last = dt.date(year, 1, 1), dt.date(year, 12, 1)
            if ranges and ranges[-1][1] == dt.date(year - 1, 12, 1):
                ranges[-1] = (ranges[-1][0], last)
            else:
                ranges.append((first, last))
        return cls(tuple(ranges))

    @property
    def whole(self) -> bool:
        return any(r == (None, None) for r in self.ranges)

    def until(self) -> Period:
        """The same without a lower end, for balances and for what is looked up as of a month."""
        lasts = [last for _, last in self.ranges]
        return Period.months(None, None if None in lasts else max(lasts, default=None))

    def reaching_back(self, months: int) -> Period:
        """Each range extended at its start, for a trailing window of so many months."""
        return Period(tuple((first and _moved(first, -months), last) for first, last in self.ranges))

    def _any(self, one: Sequence[Column]) -> Column:
        if self.whole:
            return F.lit(True)
        met = F.lit(False) if not one else one[0]
        for c in one[1:]:
            met = met | c
        return met

    def covers(self, month: Column | str) -> Column:
        """The month, given as its first day, is asked for. Never NULL unless everything is asked for."""
        m = _col(month)
        each = []
        for first, last in self.ranges:
            parts = [m.isNotNull()]
            parts += [m >= F.lit(first)] if first else []
            parts += [m <= F.lit(last)] if last else []
            each.append(_and(parts))
        return self._any(each)

    def bounds(self, raw: Column | str) -> Column:
        """The same for a raw date or timestamp, as comparisons of the bare column: these reach the scan."""
        d = _col(raw)
        each = []
        for first, last in self.ranges:
            parts = [d.isNotNull()]
            parts += [d >= F.lit(first)] if first else []
            parts += [d < F.lit(_moved(last, 1))] if last else []
            each.append(_and(parts))
        return self._any(each)

    def in_years(self, year: Column | str) -> Column:
        """The year holds some month that is asked for: a condition on a partition column."""
        y = _col(year)
        each = []
        for first, last in self.ranges:
            parts = [y.isNotNull()]
            parts += [y >= first.year] if first else []
            parts += [y <= last.year] if last else []
            each.append(_and(parts))
        return self._any(each)


def _and(parts: Sequence[Column]) -> Column:
    met = parts[0]
    for c in parts[1:]:
        met = met & c
    return met


ALWAYS = Period.months()


def month_of(raw: Column | str) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(_col(raw).cast("date"), "MM")


def with_month(df: DataFrame, raw: str, period: Period = ALWAYS, month: str = "mes_ref") -> DataFrame:
    """Rows of the period with their month; the period bounds the raw date. Without a bound a NULL date stays, with a NULL month."""
    kept = df if period.whole else df.filter(period.bounds(raw))
    return kept.withColumn(month, month_of(raw))


def during(fact: DataFrame, period: Period, month: str = "mes_ref") -> DataFrame:
    """Rows of a monthly frame in the period; if it is stored by year, other years are not read."""
    if period.whole:
        return fact
    kept = fact.filter(period.covers(month))
    return kept.filter(period.in_years(YEAR)) if YEAR in fact.columns else kept


def by_year(fact: DataFrame, month: str = "mes_ref") -> DataFrame:
    """Adds the partition column that facts are stored by."""
    return fact.withColumn(YEAR, F.year(month))


def on_calendar(fact: DataFrame, months: DataFrame, month: str = "mes_ref") -> DataFrame:
    """Joins calendar months. Of a fact stored by year only the partitions of the calendar's years are read.

    The years are looked up beforehand: a calendar has as many rows as there are months, and the optimizer does not take a filter on
    one of its flags for one that is worth pruning by.
    """
    if YEAR not in fact.columns:
        return fact.join(months, month)
    years = [r["y"] for r in months.select(F.year(month).alias("y")).distinct().collect()]
    return fact.filter(F.col(YEAR).isin(years)).join(months, month)
