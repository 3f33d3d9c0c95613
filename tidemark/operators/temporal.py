"""As-of attribution, latest rows and row-frame windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import ratio
from tidemark.operators.cleanse import union_all

EXACT, INHERITED, MISSING = "EXATA", "HERDADA", "NAO_INFORMADO"


def asof_join(
    left: DataFrame,
    hist: DataFrame,
    by: Sequence[str],
    left_time: str,
    hist_time: str,
    values: Sequence[str],
    default: str = MISSING,
    bucket: str | None = None,
    match_type: str = "tipo_atribuicao",
    lag_months: str = "meses_defasagem",
) -> DataFrame:
    """Latest history row at or before each left row, per entity.

    ``hist`` is unique on entity and time; ``left`` has one row per entity and time too (see
    :func:`temporal_bridge` for rows at a finer grain). History and left rows are stacked and
    a running ``last`` carries history forward: one shuffle and linear work, where a range join
    would pair every left row with the whole past of its entity.

    An entity's rows are one window partition, bounded by its number of distinct times. That is
    little for months. For finer times give ``bucket`` (a ``date_trunc`` unit such as 'year'):
    the window then runs per entity and bucket, and only each bucket's last history row is
    carried over to later buckets. Both inputs are then read twice: stage one that is costly to make.
    """
    by = list(by)
    payload = [c for c in left.columns if c not in by]
    none = F.lit(None)
    found = F.struct(F.col(hist_time).alias("__t"), *[F.col(v) for v in values])
    known = hist.filter(F.col(hist_time).isNotNull())
    for key in by:
        known = known.filter(F.col(key).isNotNull())
    known = known.select(*by, F.col(hist_time).alias("__t"), found.alias("__h"))
    asked = left.select(
        *by, F.col(left_time).alias("__t"), none.cast(known.schema["__h"].dataType).alias("__h"), F.struct(*payload).alias("__l")
    )
    stacked = known.withColumn("__l", none.cast(asked.schema["__l"].dataType)).unionByName(asked)
    running = [F.col("__t"), F.col("__l").isNotNull()]  # history before left rows of the same time

    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*running).rowsBetween(Window.unboundedPreceding, 0)
        carried = stacked.withColumn("__h", F.last("__h", ignorenulls=True).over(w)).filter(F.col("__l").isNotNull())
    else:
        cut = stacked.withColumn("__b", F.date_trunc(bucket, F.col("__t").cast("timestamp")))
        part = [*by, "__b"]
        last_of = cut.groupBy(*part).agg(F.max("__h").alias("__h"))  # structs order by time first
        before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        carry = last_of.select(*part, F.last("__h", ignorenulls=True).over(before).alias("__c"))
        w = Window.partitionBy(*part).orderBy(*running).rowsBetween(Window.unboundedPreceding, 0)
        inside = cut.withColumn("__h", F.last("__h", ignorenulls=True).over(w)).filter(F.col("__l").isNotNull())
        # rows without entity or time meet no carry, as they should: they have no history
        carried = inside.join(carry, part, "left").withColumn("__h", F.coalesce("__h", "__c"))

    at, seen = F.col(f"__l.{left_time}"), F.col("__h.__t")
    kind = F.when(seen == at, EXACT).when(seen.isNotNull(), INHERITED).otherwise(MISSING)
    return carried.select(
        *by,
        *[F.col(f"__l.{c}").alias(c) for c in payload],
        *[F.coalesce(F.col(f"__h.{v}"), F.lit(default)).alias(v) if i == 0 else F.col(f"__h.{v}").alias(v) for i, v in enumerate(values)],
        kind.alias(match_type),
        F.months_between(at, seen).cast("int").alias(lag_months),
    )


def temporal_bridge(
    sources: Sequence[DataFrame],
    hist: DataFrame,
    entity: str,
    time: str,
    group: str,
    period: Column | None = None,
    default: str = MISSING,
) -> DataFrame:
    """One row per entity and month that any source mentions, with the group in force at that month."""
    keys = union_all([s.select(entity, time) for s in sources])
    if period is not None:
        keys = keys.filter(period)
    return asof_join(keys.distinct(), hist, [entity], time, time, [group], default)


def attribution_summary(bridge: DataFrame, match_type: str = "tipo_atribuicao", lag_months: str = "meses_defasagem") -> DataFrame:
    return bridge.groupBy(match_type).agg(F.count(F.lit(1)).alias("linhas"), F.max(lag_months).alias("max_defasagem"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The last row of each key; ties go to the greatest tie-breakers.

    An aggregate rather than a ranking window: candidates are compared before the shuffle, so
    a key with very many rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(order, *[t for t in tie_breakers if t != order]))
    return df.groupBy(*keys).agg(newest.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def pct_change(df: DataFrame, series: Sequence[str], time: str, value: str, out: str = "var_pct") -> DataFrame:
    """Change against the previous row of the series, as a fraction. One row per series and time."""
    previous = F.lag(value).over(Window.partitionBy(*series).orderBy(time))
    return df.withColumn(out, ratio(F.col(value), previous) - 1)


def frame_mean(df: DataFrame, by: Sequence[str], order: str, value: str, first: int, last: int, out: str) -> DataFrame:
    """Mean over a frame of rows; a missing month widens the time it covers (see :func:`fill_months`).

    The total is exact before it is divided, so the result does not hang on the order of addition.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(first, last)
    return df.withColumn(out, F.sum(value).over(w).cast("double") / F.count(value).over(w))


def trailing_mean(df: DataFrame, by: Sequence[str], order: str, value: str, n: int = 12, out: str = "media_anterior") -> DataFrame:
    """Mean of the ``n`` rows before this one, this one excluded; NULL on the first row."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-n, -1)
    return df.withColumn(out, ratio(F.sum(value).over(w), F.count(value).over(w)))


def moving_mean(df: DataFrame, by: Sequence[str], order: str, value: str, n: int = 3, out: str = "media_movel") -> DataFrame:
    """Mean of this row and the ``n - 1`` before it; shorter frames at the start of a series."""
    return frame_mean(df, by, order, value, 1 - n, 0, out)


def fill_months(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """Add the missing months of each series between its first and last one, other columns NULL."""
    span = df.groupBy(*by).agg(F.min(time).alias("__a"), F.max(time).alias("__b"))
    months = span.select(*by, F.explode(F.sequence("__a", "__b", F.expr("INTERVAL 1 MONTH"))).alias(time))
    return months.join(df, [*by, time], "left")
