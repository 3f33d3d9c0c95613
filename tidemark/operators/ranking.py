"""Top rows, positions and ranks that do not gather a table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage


def _descending(order: str, tie_breakers: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(order), *[F.asc_nulls_last(t) for t in tie_breakers]]


def topk_per_group(
    df: DataFrame, by: Sequence[str], order: str, k: int, tie_breakers: Sequence[str], position: str = "pos"
) -> DataFrame:
    """The ``k`` greatest rows of each group with their position.

    The filter on the row number lets Spark cut each map task's rows to ``k`` per group before
    the shuffle, so a group with very many rows never meets in one task.
    """
    w = Window.partitionBy(*by).orderBy(*_descending(order, tie_breakers))
    return df.withColumn(position, F.row_number().over(w)).filter(F.col(position) <= k)


def first_values(df: DataFrame, by: Sequence[str], value: str, k: int, out: str) -> DataFrame:
    """The first ``k`` distinct values of each group, rising, as an array; NULL is no value.

    Pairs are made distinct before anything is gathered, and each map task then keeps ``k`` values of a group before the
    shuffle, so no array ever holds more.
    """
    pairs = df.select(*by, value).filter(F.col(value).isNotNull()).distinct()
    first = Window.partitionBy(*by).orderBy(F.asc(value))
    kept = pairs.withColumn("__pos", F.row_number().over(first)).filter(F.col("__pos") <= k)
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias(out))


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def topk_by_magnitude(df: DataFrame, value: str, k: int, tie_breakers: Sequence[str]) -> DataFrame:
    """The ``k`` rows of greatest absolute value, listed from the lowest to the highest signed value."""
    kept = top_rows(df, [F.desc_nulls_last(F.abs(value)), *[F.asc(t) for t in tie_breakers]], k)
    return kept.orderBy(value, *tie_breakers)


def topk_entities_history(
    df: DataFrame, entity: str, volume: Column, k: int, chosen_in: Column, history: Column | None = None
) -> DataFrame:
    """All rows of the ``k`` entities with the greatest volume over the rows that meet ``chosen_in``."""
    leaders = df.filter(chosen_in).groupBy(entity).agg(F.sum(volume).alias("__volume"))
    leaders = top_rows(leaders, _descending("__volume", [entity]), k).select(entity)
    rows = df if history is None else df.filter(history)
    return rows.join(leaders, entity, "left_semi")


def split_by_range(df: DataFrame, order: Sequence[Column], salt: Sequence[str]) -> DataFrame:
    """``df`` cut into ranges of ``order`` of about equal size, numbered upwards in ``__range``.

    The boundaries are drawn from the data, and rows that tie are told apart by a hash of ``salt``, so neither
    values that lie close together nor one value that most rows share makes a large range. Write the result
    before it is read twice: another run may draw other boundaries.
    """
    dealt = df.withColumn("__salt", F.xxhash64(*salt)).repartitionByRange(*order, F.col("__salt"))
    return dealt.withColumn("__range", F.spark_partition_id())


def _above(sizes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``__before``, the rows of earlier ranges, to ``sizes``, which has one row for each range."""
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))


def number_rows(df: DataFrame, order: Sequence[Column], key: Sequence[str], name: str = "numero") -> DataFrame:
    """Numbers the rows from 1 in ``order``, ties by a hash of ``key``, without one task seeing them all."""
    inside = Window.partitionBy("__range").orderBy(*order, "__salt", *key)
    placed = stage(split_by_range(df, order, key).withColumn("__inside", F.row_number().over(inside)), "numbered")
    sizes = _above(placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))).select("__range", "__before")
    # as many rows as there are ranges, which is the number of shuffle partitions at most
    numbered = placed.join(F.broadcast(sizes), "__range")
    return numbered.withColumn(name, F.col("__before") + F.col("__inside")).drop("__range", "__salt", "__inside", "__before")


def global_ranks(df: DataFrame, entity: Sequence[str], metrics: Sequence[str], names: Sequence[str]) -> DataFrame:
    """SQL RANK, highest first, of each metric over the whole table, without one task seeing it all.

    The values of all metrics are cut into ranges of about equal size. A row's rank is the count of rows in higher
    ranges plus its rank in its own; a value that goes over the end of a range takes the rank of the range where it starts.
    ``entity`` is the key of ``df``; a NULL metric gets a NULL rank.
    """
    rest = [c for c in df.columns if c not in entity]
    n = len(metrics)
    cells = [
        F.struct(
            F.lit(i).alias("__m"),
            F.col(m).alias("__v"),
            (F.struct(*rest) if i == 0 else F.lit(None)).alias("__row"),
        )
        for i, m in enumerate(metrics)
    ]
    melted = df.select(*entity, F.inline(F.array(*cells)))
    highest = F.desc_nulls_last("__v")
    own = Window.partitionBy("__m", "__range").orderBy(highest)
    ranges = split_by_range(melted, [F.col("__m"), highest], entity).withColumn("__own", F.rank().over(own))
    placed = stage(ranges.drop("__salt"), "ranks")
    valued = placed.filter(F.col("__v").isNotNull()).groupBy("__m", "__range")
    sizes = valued.agg(F.count(F.lit(1)).alias("__n"), F.max("__v").alias("__hi"), F.min("__v").alias("__lo"), F.max("__own").alias("__last"))
    ends = _above(sizes, ["__m"])
    # only the greatest and the least value of a range can also stand in another one; the least has the last rank
    values = [F.struct(F.col(v).alias("__v"), (F.col("__before") + at).alias("__start")) for v, at in (("__hi", F.lit(1)), ("__lo", F.col("__last")))]
    starts = ends.select("__m", F.inline(F.array(*values))).groupBy("__m", "__v").agg(F.min("__start").alias("__start"))
    # one row for each range and two, and no more ranges than shuffle partitions
    before = F.broadcast(ends.select("__m", "__range", "__before"))
    ranked = placed.join(before, ["__m", "__range"], "left").join(F.broadcast(starts), ["__m", "__v"], "left")
    rank = F.coalesce("__start", F.when(F.col("__v").isNotNull(), F.col("__before") + F.col("__own")))
    back = ranked.withColumn("__rank", rank).groupBy(*entity).agg(
        F.first("__row", ignorenulls=True).alias("__row"),
        *[F.max(F.when(F.col("__m") == i, F.col("__rank"))).alias(names[i]) for i in range(n)],
    )
    return back.select(*entity, *[F.col(f"__row.{c}").alias(c) for c in rest], *names)


def rank_shift(
    df: DataFrame,
    entity: Sequence[str],
    metric_a: str,
    metric_b: str,
    rank_a: str = "posicao_a",
    rank_b: str = "posicao_b",
    shift: str = "variacao_posicao",
    sign_flip: str = "muda_de_sinal",
) -> DataFrame:
    """Position by two metrics. A positive shift climbs from A to B; a zero is no change of sign."""
    ranked = global_ranks(df, entity, [metric_a, metric_b], [rank_a, rank_b])
    flips = F.signum(F.col(metric_a).cast("double")) * F.signum(F.col(metric_b).cast("double")) < 0
    return ranked.withColumn(shift, F.col(rank_a) - F.col(rank_b)).withColumn(sign_flip, flips)


def rank_shift_summary(shifted: DataFrame, shift: str = "variacao_posicao", sign_flip: str = "muda_de_sinal") -> DataFrame:
    moved = F.count(F.when(F.col(shift) != 0, F.lit(1)))
    flipped = F.count(F.when(F.col(sign_flip), F.lit(1)))
    return shifted.agg(
        F.count(F.lit(1)).alias("unidades"), moved.alias("mudam_de_posicao"), flipped.alias("mudam_de_sinal")
    )
