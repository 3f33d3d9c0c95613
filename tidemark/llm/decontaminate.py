"""Benchmark decontamination by canonical templates.

Method
------
Texts become templates: words in lower case, with typed placeholders for numbers, names (a capital inside a
sentence) and units (after a number). Hashed windows of template tokens are joined between documents and benchmark
items. Matches of one document and item on one diagonal form a passage, and so do those on neighbouring
diagonals, since an inserted or dropped word moves the rest of a copy to another. Windows are joined in literal
form as well, so a verbatim copy matches whatever its slots and what stands before it; a passage's slots must map one to one (the
same benchmark value to the same document value, and back), which catches questions asked again with other
numbers or names and leaves accidental matches alone. Where they do not, literal windows alone count. A passage that covers enough of the item is a leak.

Documents send only windows whose hash is set in a bitmap of the benchmark's windows. The bitmap has a fixed
size whatever the benchmark's, and the join behind it decides, so it loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow
from tidemark.llm.words import LOWER, PrefixHash, Run, hash_bytes, mix, runs
from tidemark.session import stage

_R = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n:;")] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\x0b\x0c\"'()[]")] = True

#: Words that are units when they follow a number.
UNITS = (
    "kg g mg t lb lbs oz km m cm mm mi mile miles ft feet foot inch inches yd yard yards l ml litre litres liter liters gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars usd eur euro euros cent cents pound pounds percent degree degrees mph kmh watt watts volt volts"
).split()
_UNITS = np.array(sorted(hash_bytes(u.encode()) for u in UNITS), np.uint64)
NUMBER, NAME, UNIT = np.uint64(11), np.uint64(13), np.uint64(17)
BITS = 22


def _lowered(data: np.ndarray) -> np.ndarray:
    out = LOWER[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def template(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a run: starts, ends, first token of each text, literal hash, template hash, whether it is a slot, a number."""
    data = run.data
    digit = _DIGIT[data]
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = ((data[1:-1] == 0x2E) | (data[1:-1] == 0x2C)) & digit[:-2] & digit[2:]
    number_starts, number_ends, _ = run.spans(digit | inner)
    word_starts, word_ends, _ = run.spans(_LETTER[data])
    starts = np.r_[number_starts, word_starts]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.r_[number_ends, word_ends][order]
    numeric = (np.arange(len(starts)) < len(number_starts))[order]
    first = np.searchsorted(starts, run.offsets)
    literal = PrefixHash(_lowered(data)).of(starts, ends)
    n = len(starts)
    # last byte before a token that is neither blank nor bracket; a text's first token starts a sentence
    solid = np.where(~_BLANK[data], np.arange(len(data)), -1)
    last = np.maximum.accumulate(solid) if len(data) else solid
    text_start = np.repeat(run.offsets[:-1], np.diff(first))
    before = np.where(starts > 0, last[np.maximum(starts - 1, 0)], -1) if n else np.zeros(0, np.int64)
    opening = (before < text_start) | _ENDS[data[np.maximum(before, 0)]] if n else np.zeros(0, bool)
    head = data[starts] if n else np.zeros(0, np.uint8)
    second = data[np.minimum(starts + 1, len(data) - 1)] if n else head
    capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    name = capital & ~opening & ~numeric
    after_number = np.zeros(n, bool)
    if n > 1:
        after_number[1:] = numeric[:-1] & (starts[1:] - ends[:-1] <= 1)
    if n:
        at = np.minimum(np.searchsorted(_UNITS, literal), len(_UNITS) - 1)
        unit = after_number & ~numeric & (_UNITS[at] == literal)
    else:
        unit = after_number
    token = np.where(numeric, NUMBER, np.where(unit, UNIT, np.where(name, NAME, literal)))
    return starts, ends, first, literal, token, numeric | name | unit, numeric


def _windows(literal: np.ndarray, token: np.ndarray, slot: np.ndarray, numeric: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie in one text: start token, text, hash, form.

    Each has a literal form (0). Those with slots in less than half of their places also have the template (1), and
    where the first token is a name or unit, the template that takes it literally (2): what stands before it decides that.
    """
    n = len(token) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
    exact, h, rest = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    slots = np.zeros(n, np.int64)
    for k in range(size):
        exact = exact * _R + literal[k : k + n]
        h = h * _R + token[k : k + n]
        rest = rest * _R + (token if k else literal)[k : k + n]
        slots += slot[k : k + n]
    at = np.arange(n)
    text = np.searchsorted(first, at, "right") - 1
    inside = at + size <= first[text + 1]
    less = slots - 1
    chosen = (inside, inside & (slots > 0) & (2 * slots < size), inside & (slot & ~numeric)[:n] & (less > 0) & (2 * less < size))
    spots = np.concatenate([at[ok] for ok in chosen])
    hashes = np.concatenate([x[ok] for x, ok in zip((exact, h, rest), chosen, strict=True)])
    return spots, text[spots], mix(hashes + np.uint64(size)), np.repeat(np.arange(3, dtype=np.int8), [ok.sum() for ok in chosen])


def _rows(run: Run, sizes: list[int], bitmap: np.ndarray | None):
    """Per window: text, size, hash, place, form, slot values; only those in the bitmap."""
    starts, ends, first, literal, token, slot, numeric = template(run)
    low = _lowered(run.data).tobytes()
    for size in sizes:
        at, text, h, form = _windows(literal, token, slot, numeric, first, size)
        if bitmap is not None:
            bit = (h >> np.uint64(64 - BITS)).astype(np.int64)
            good = (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            at, text, h, form = at[good], text[good], h[good], form[good]
        for a, t, x, f in zip(at.tolist(), text.tolist(), h.view(np.int64).tolist(), form.tolist(), strict=True):
            places = np.flatnonzero(slot[a : a + size])
            values = [low[starts[a + p] : ends[a + p]].decode("utf-8", "replace") for p in places.tolist() if p or f < 2]
            yield t, size, x, a - int(first[t]), f, values


def _emit(batch: pa.RecordBatch, sizes_of, bitmap):
    for run in runs(batch.column(1)):
        rows = list(_rows(run, sizes_of, bitmap))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        ids = batch.column(0).take(pa.array([run.first + t for t in columns[0]], pa.int64()))
        yield pa.record_batch(
            [ids, pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int8()), pa.array(columns[5], pa.list_(pa.string()))],
            names=["id", "size", "hash", "place", "form", "slots"],
        )


def _covered(places: Column, size: Column) -> Column:
    """Tokens in windows of ``size`` at these sorted places."""
    steps = F.transform(places, lambda p, i: F.when(i == 0, size).otherwise(F.least(size, p - F.get(places, i - 1))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 8, least: int = 4, share: float = 0.5, run_tokens: int = 20, drift: int = 16) -> DataFrame:
    """Pairs of a document and a benchmark item that it leaks: ``doc_id``, ``item_id``, ``share``, ``n_windows``, ``n_slots``, ``n_changed``.

    A passage is a leak when its matching windows are ``share`` of the item's (of all, or of those with slots in less
    than half of their places), or cover ``run_tokens`` of its tokens;
    it holds diagonals at most ``drift`` tokens apart. One whose slots conflict is a leak when its literal windows cover ``run_tokens``.
    Items of fewer than ``window`` tokens match as a whole, those below ``least`` never. ``n_slots`` counts the
    distinct slot values of the passage, ``n_changed`` those that differ in the document. Null or empty texts and null ids on
    either side match nothing; repeated rows count once; an item that is repeated in a document gives one row;
    further columns, also ones with clashing names, are ignored; an empty table gives no rows.
    """

    def of_item(batch: pa.RecordBatch):
        for run in runs(batch.column(1)):
            counts = np.diff(template(run)[2])
            for size in sorted({min(window, int(c)) for c in counts if c >= least}):
                chosen = np.flatnonzero(np.minimum(counts, window) == size)
                own = batch.slice(run.first, run.n).take(pa.array(chosen))
                yield from _emit(own, [size], None)

    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("item is not null and text is not null")
    windows = map_arrow(items, of_item, f"id {benchmark.schema[item_col].dataType.simpleString()}, size int, hash long, place int, form tinyint, slots array<string>")
    windows = stage(windows.dropDuplicates(["id", "hash", "place", "form"]), "bench")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    spots = windows.select(F.shiftrightunsigned("hash", 64 - BITS).alias("spot")).distinct()
    words = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    for r in words:
        bitmap[r["word"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    found = map_arrow(texts, lambda batch: _emit(batch, sizes, bitmap), f"id {docs.schema[id_col].dataType.simpleString()}, size int, hash long, place int, form tinyint, slots array<string>")
    found = found.select(F.col("id").alias("doc"), "hash", F.col("place").alias("at"), (F.col("form") == 0).alias("exact"), F.col("slots").alias("theirs"))
    wordy = 2 * (F.size("slots") + (F.col("form") == 2).cast("int")) < F.col("size")
    windows = windows.withColumns({"exact": F.col("form") == 0, "wordy": wordy}).withColumnRenamed("id", "item")
    matched = found.join(windows, ["hash", "exact"]).withColumn("shift", F.col("at") - F.col("place"))
    diagonal = matched.groupBy("doc", "item", "shift").agg(
        F.collect_set("place").alias("places"),
        F.collect_set(F.when(F.col("wordy"), F.col("place"))).alias("wordy"),
        F.collect_set(F.when(F.col("exact"), F.col("place"))).alias("literal"),
        F.max("size").alias("size"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("values"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("exact"), F.arrays_zip("slots", "theirs"))))).alias("pairs"),
    )
    # a diagonal alone, and in the two overlapping stretches of diagonals that hold it: those at most ``drift`` apart share one
    stretch = F.floor(F.col("shift") / drift)
    within = F.array(F.struct(F.lit(0).alias("wide"), F.col("shift").cast("long").alias("k")), *[F.struct(F.lit(1).alias("wide"), (stretch - back).alias("k")) for back in (0, 1)])
    passage = diagonal.withColumn("within", F.explode(within)).groupBy("doc", "item", "within").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
        F.size(F.array_distinct(F.flatten(F.collect_list("wordy")))).alias("n_wordy"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("literal")))).alias("literal"),
        F.max("size").alias("size"),
        F.size(F.array_distinct(F.flatten(F.collect_list("values")))).alias("n_slots"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"),
    )
    pairs = F.col("pairs")
    one_to_one = (F.size(F.array_distinct(pairs["slots"])) == F.size(pairs)) & (F.size(F.array_distinct(pairs["theirs"])) == F.size(pairs))
    # where they conflict, windows with slots of other values drop out and the literal ones must be long enough by themselves
    passage = passage.withColumns({"fits": one_to_one, "n_changed": F.size(F.filter("pairs", lambda p: p["slots"] != p["theirs"]))})
    passage = passage.withColumn("places", F.when(F.col("fits"), F.col("places")).otherwise(F.col("literal")))
    passage = passage.withColumns({"n_windows": F.size("places").cast("long"), "covered": _covered(F.col("places"), F.col("size"))})
    # a copy with other values shows only in windows that are mostly words
    whole = windows.where("exact").groupBy("item").agg(F.count_distinct("place").alias("of"), F.count_distinct(F.when(F.col("wordy"), F.col("place"))).alias("of_wordy"))
    of_words = F.when(F.col("fits") & (F.col("of_wordy") > 0), F.col("n_wordy") / F.col("of_wordy"))
    leaks = passage.join(whole, "item").withColumn("share", F.greatest(F.col("n_windows") / F.col("of"), of_words))
    leaks = leaks.where((F.col("fits") & (F.col("share") >= share)) | (F.col("covered") >= run_tokens))
    best = leaks.groupBy("doc", "item").agg(F.max_by(F.struct("share", "n_windows", "n_slots", "n_changed"), F.struct("fits", "share", F.negative("within.wide"), F.negative("within.k"))).alias("b"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "b.*")
