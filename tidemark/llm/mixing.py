"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Method
------
Sources get targets by water-filling: weights share out all words, no source beyond a number of times its size, the excess going to
the others. Entropy balancing then finds the rates of documents that meet the targets and are closest, in relative entropy, to taking each
document once. With a bound on the rate of one document the solution is ``min(most, exp(l * c))``: an exponential tilt by the
document's size ``c``, cut at the bound, with one multiplier ``l`` for each source's word constraint. The multipliers minimise a convex
dual; Newton steps on the logarithm of the constraint solve it for all sources at once, held inside brackets by bisection.
The rate depends on source and size alone, so an iteration is one aggregate over the table of
(source, size, number of documents), which is made once.

Rates become copies without chance: copies of a source are cumulated over its sizes, largest first, and rounded
cumulatively, so at each size the copies so far are within one half of the rates so far. What a source is then off its target,
less than its largest document, is settled by a few documents not larger than that, again largest first. Within a size, the
documents that get one copy more are chosen by a hash of their id; a size with very many documents is dealt to buckets for that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import number_rows
from tidemark.session import stage

#: Documents of one source and size that are ordered together, about; and the most buckets that such a class is dealt to.
BUCKET, BUCKETS = 512, 4096
_WORD = r"[^\x20\x09-\x0D]+"


def _total(value: Column) -> Column:
    return F.sum(value.cast("decimal(28,8)")).cast("double")


def _scaled(size: Column, mean: Column) -> Column:
    return size / F.greatest(mean, F.lit(1.0))


def source_targets(totals: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Adds ``weight`` and ``target`` to (source, source_size): sources by code point, null last, weigh ``weights``, repeating."""
    numbered = number_rows(totals, [F.asc_nulls_last("source")], ["source"], "place")
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    open_ = stage(numbered.select("source", "source_size", "n", "place", given.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("cap")), "sources")
    total = open_.agg(F.sum("source_size")).head()[0] or 0
    level, held = None, -1
    while True:
        # the level at which sources that are not at their cap share what those at their cap leave
        full = F.lit(False) if level is None else F.col("cap") < F.col("weight") * F.lit(level)
        r = open_.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("kept"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"), F.count_if(full).alias("full")).head()
        if r["full"] == held or not r["open"]:
            break
        held, level = r["full"], (total - r["kept"]) / r["open"]
    return open_.withColumn("target", F.least("cap", F.col("weight") * F.lit(level or 0.0)))


def tilts(classes: DataFrame, sources: DataFrame, most: float, tolerance: float = 1e-9, turns: int = 100) -> DataFrame:
    """(place, tilt): the multiplier of each source, for rates ``least(most, exp(tilt * size / mean size))``.

    ``classes``: place, size, n. ``sources``: place, source_size, n, target. The tilt is null where a source has no
    words or all its documents are taken ``most`` times.
    """
    inner = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * F.lit(most) * (1 - 1e-12)) & (F.col("target") > 0)
    state = sources.where(inner).select("place", "target", (F.col("source_size") / F.col("n")).alias("mean"))
    state = stage(state.withColumns({"tilt": F.lit(0.0), "lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"), "off": F.lit(1.0)}), "tilts")
    sized = classes.where("size > 0")
    for _ in range(turns):
        if state.where(F.col("off") > tolerance).isEmpty():
            break
        c = _scaled(F.col("size"), F.col("mean"))
        rate, words = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * c, F.lit(50.0)))), F.col("n") * F.col("size")
        # decimals, whose sums don't depend on the order of rows: a rerun takes the same steps
        met = sized.join(state.select("place", "tilt", "mean"), "place").groupBy("place").agg(
            _total(words * rate).alias("got"), _total(F.when(rate < most, words * c * rate).otherwise(0.0)).alias("slope")
        )
        now = state.join(met, "place").withColumn("off", F.abs(F.col("got") - F.col("target")) / F.col("target"))
        short = F.col("got") < F.col("target")
        now = now.withColumn("lo", F.when(short, F.col("tilt")).otherwise(F.col("lo"))).withColumn("hi", F.when(short, F.col("hi")).otherwise(F.col("tilt")))
        newton = F.col("tilt") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi"))) & (F.abs(newton - F.col("tilt")) < 1e3)
        halfway = F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        # rates so small that nothing is left of the sum
        step = F.when((F.col("got") > 0) & F.coalesce(inside, F.lit(False)), newton).otherwise(halfway)
        now = now.withColumn("tilt", F.when(F.col("off") > tolerance, step).otherwise(F.col("tilt")))
        state = stage(now.select(state.columns), "tilts")
    return state.select("place", "tilt", "mean")


def _settled(classes: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``copies`` of classes moved so that each source's words come closer to its target, by the largest documents that fit."""
    taken = classes.groupBy("place").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    off = sources.select("place", "target").join(taken, "place").select("place", (F.col("target") - F.col("got")).alias("off"))
    open_ = classes.join(off, "place")
    room = F.when(F.col("off") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
    fits = (F.col("size") > 0) & (F.col("size") <= F.abs("off"))
    largest = Window.partitionBy("place").orderBy(F.desc("size"))
    open_ = open_.withColumn("room", F.when(fits, room).otherwise(0))
    upto = F.sum(F.col("room") * F.col("size")).over(largest.rowsBetween(Window.unboundedPreceding, -1))
    left = F.greatest(F.abs("off") - F.coalesce(F.col("upto"), F.lit(0)), F.lit(0.0))
    moved = F.when(F.col("room") > 0, F.least(F.col("room"), F.floor(left / F.col("size")))).otherwise(0)
    moved = F.when(F.col("off") > 0, moved).otherwise(-moved)
    return open_.withColumn("upto", upto).withColumn("copies", F.col("copies") + moved).select(classes.columns)


def _class_copies(classes: DataFrame, sources: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """(place, size, n, rate, copies): whole copies of all documents of a source and size."""
    rated = classes.join(found, "place", "left").join(sources.select("place", "source_size", "target"), "place")
    rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * _scaled(F.col("size"), F.col("mean")), F.lit(50.0))))
    rate = F.when(F.col("tilt").isNotNull(), rate).when(F.col("target") > 0, F.lit(float(most))).otherwise(F.lit(1.0))
    rated = rated.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate))
    wanted = F.col("n") * F.col("rate")
    rated = rated.withColumn("whole", F.floor(wanted)).withColumn("part", wanted - F.col("whole"))
    largest = Window.partitionBy("place").orderBy(F.desc("size"))
    upto = F.sum("part").over(largest.rowsBetween(Window.unboundedPreceding, 0))
    rated = rated.withColumn("upto", upto)
    more = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("part") + 0.5)
    copies = F.least(F.col("whole") + more, F.col("n") * most).cast("long")
    return rated.select("place", "size", "n", "rate", copies.alias("copies"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    settle: int = 3,
) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, and ``rate`` and ``copies`` behind it.

    ``size``: runs of anything but ASCII white space. ``taken`` is ``size * copies``, at most ``most`` times the size. A null or
    empty text has size 0 and takes nothing; its rate is 1. A null source is a source of its own, the last in order. A source
    without words has target 0. A null id keeps its row. Rows that repeat an id count each; which of several equal rows gets a
    copy more is open, the rows of the result as a whole are not. Further columns of ``docs`` are ignored; an empty table gives no rows.
    A source's distinct sizes, which are no more than the words of its longest text, are cumulated in one task.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(_WORD)), F.lit(0)).cast("long")
    sized = stage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")), "sizes")
    counted = stage(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "size_counts")
    totals = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    sources = stage(source_targets(totals, weights, most), "targets")
    placed = counted.withColumnRenamed("source", "_s").join(sources.select("source", "place"), F.col("_s").eqNullSafe(F.col("source")))
    classes = stage(placed.select("place", "size", "n"), "classes")
    copied = stage(_class_copies(classes, sources, tilts(classes, sources, most), most), "copies")
    for _ in range(settle):
        copied = stage(_settled(copied, sources, most), "settled")

    # buckets by hash of the ids; the first buckets take the copies that are one more
    buckets = F.least(F.lit(BUCKETS), F.ceil(F.col("n") / BUCKET)).cast("long")
    each = copied.select("place", "size", "n", "rate", F.expr("copies div n").alias("base"), F.expr("copies % n").alias("extra"), buckets.alias("buckets"))
    each = each.join(sources.select("place", "source", "source_size", "target"), "place").withColumnRenamed("source", "_s").withColumnRenamed("size", "_size")
    dealt = sized.join(each, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_size"))).drop("_s", "_size")
    dealt = dealt.withColumn("h", F.xxhash64("id")).withColumn("bucket", F.pmod("h", "buckets"))
    dealt = stage(dealt.select("id", "place", "size", "source_size", "target", "rate", "base", "extra", "buckets", "bucket", "h"), "dealt")
    many = dealt.where("buckets > 1").groupBy("place", "size", "bucket").agg(F.count("*").alias("held"))
    lower = Window.partitionBy("place", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    many = many.select("place", "size", "bucket", F.coalesce(F.sum("held").over(lower), F.lit(0)).alias("before"))
    turn = F.row_number().over(Window.partitionBy("place", "size", "bucket").orderBy("h", "id"))
    out = dealt.withColumn("turn", turn).join(many, ["place", "size", "bucket"], "left")
    copies = F.col("base") + F.when(F.col("turn") + F.coalesce("before", F.lit(0)) <= F.col("extra"), 1).otherwise(0)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "rate", copies.cast("long").alias("copies"))
