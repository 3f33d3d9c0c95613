"""Hard negatives by an inverted multi-index with certified stopping.

Method
------
A vector is cut in two halves. A codebook for each half, fitted on a bounded sample, maps every row to a pair of
codewords: its cell. All rows are indexed; a cell's rows lie in blocks of bounded size. For an anchor, a codeword of a
half gives an upper bound of that half of the score: the product with the codeword plus the anchor's norm times the
codeword's radius, the greatest distance of any of its rows. The multi-sequence heap visits cells by falling sum
of their two bounds. A visited cell is read only if its own radii, which are smaller, allow a score that still matters.

A search runs twice over the heap. The first run reads the cells at the front until a number of rows is seen, which
gives each window of the anchor a score that its last wanted row cannot fall below. The second run goes on until the
bound at the front of the heap is below what all windows of the anchor still need: from there on no row can enter any window, which
certifies the result. It is exact for any data; codebooks and the first run only decide how much is read.

Positives are one search (same label, no upper end). Their scores then set the windows of a second search, over rows of
other labels. Anchors that share a cell are handled together, so a block is multiplied with many anchors at once; a
task keeps only the best rows of each window before anything is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import dimension, usable
from tidemark.session import stage

#: Entries are held within this magnitude, so that inner products of 512 entries are exact in 64 bits.
MOST = 1 << 27
_MOST_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Index:
    """Codebooks and, per cell, its rows and the radii of its halves. At most ``codewords ** 2`` cells."""

    dim: int
    books: tuple[np.ndarray, np.ndarray]
    n: np.ndarray
    radii: tuple[np.ndarray, np.ndarray]

    def codes(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Codeword of each half and the distance to it."""
        codes, far = [], []
        for half, book in zip(_halves(x), self.books, strict=True):
            # one row of the codebook at a time: no array of rows x codewords x entries
            gaps = np.stack([((half - word) ** 2).sum(axis=1) for word in book], axis=1)
            codes.append(gaps.argmin(axis=1))
            far.append(np.sqrt(gaps.min(axis=1)))
        return codes, far

    @cached_property
    def word_radii(self) -> tuple[np.ndarray, np.ndarray]:
        """The radius of each codeword of either half: the greatest over its cells."""
        first, second = (r.reshape(len(self.books[0]), len(self.books[1])) for r in self.radii)
        return first.max(axis=1), second.max(axis=0)

    def visits(self, x: np.ndarray) -> Iterator[tuple[float, int, float]]:
        """(sum of the half bounds, cell or -1 where it is empty, bound by the cell's own radii), by falling sum, for one anchor."""
        products = [book @ half for book, half in zip(self.books, _halves(x), strict=True)]
        norms = [float(np.linalg.norm(half)) for half in _halves(x)]
        sums = [p + norm * r for p, norm, r in zip(products, norms, self.word_radii, strict=True)]
        orders = [np.argsort(-s, kind="stable") for s in sums]
        first, second = (s[o] for s, o in zip(sums, orders, strict=True))
        heap = [(-(first[0] + second[0]), 0, 0)]
        while heap:
            key, i, j = heapq.heappop(heap)
            if j + 1 < len(second):
                heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))
            a, b = int(orders[0][i]), int(orders[1][j])
            cell = a * len(second) + b
            own = products[0][a] + norms[0] * self.radii[0][cell] + products[1][b] + norms[1] * self.radii[1][cell]
            yield -key, (cell if self.n[cell] else -1), own


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = x.shape[-1] // 2
    return x[..., :cut], x[..., cut:]


def _codebook(sample: np.ndarray, codewords: int, turns: int = 12) -> np.ndarray:
    """k-means of the sample, started from rows spread over it."""
    words = np.unique(sample, axis=0)
    words = words[np.linspace(0, len(words) - 1, min(codewords, len(words))).astype(int)]
    for _ in range(turns):
        nearest = ((words**2).sum(axis=1)[None] - 2 * sample @ words.T).argmin(axis=1)
        for k in range(len(words)):
            if (own := nearest == k).any():
                words[k] = sample[own].mean(axis=0)
    return words


def _integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(np.floor(vectors * scale), -MOST, MOST).astype(np.int32)


def _unpack(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, np.int32).reshape(-1, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; floating point only where every partial sum fits its 53 bits."""
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _one_row_per_id(rows: DataFrame) -> DataFrame:
    """Of rows that repeat an id, the one with the smallest label, then the smallest vector."""
    again = stage(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated_ids")
    if again.isEmpty():
        return rows
    once = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "x")).alias("r"))
    return rows.join(again, "id", "left_anti").unionByName(once.select("id", "r.label", "r.x"))


def _clean(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: float, dim: int) -> DataFrame:
    """(id, label, x): rows that take part, x the packed integers."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, entries = usable(batch.column(2), dim)
            x = _integers(entries, scale)
            kept = batch.filter(pa.array(good))
            yield pa.record_batch([kept.column(0), kept.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "x"])

    named = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    return named.where("id is not null and label is not null and v is not null").mapInArrow(of, "id long, label long, x binary")


def build_index(rows: DataFrame, dim: int, sample: int, codewords: int, per_cell: int) -> tuple[Index, DataFrame]:
    """Codebooks, radii, and every row (id, label, x) with its cell."""
    total = rows.count()
    drawn = rows.select("id", "x").orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    points = np.array([_unpack(r["x"], dim)[0] for r in drawn], np.float64).reshape(-1, dim)
    words = int(np.clip(np.sqrt(total / per_cell), 1, codewords))
    books = tuple(_codebook(half, words) for half in _halves(points)) if len(points) else (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))
    bare = Index(dim, books, np.zeros(0), (np.zeros(0), np.zeros(0)))
    width = len(books[1])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _unpack(b"".join(batch.column(2).to_pylist()), dim).astype(np.float64)
                (a, b), (far_a, far_b) = bare.codes(x)
                yield pa.record_batch([*batch.columns, pa.array(a * width + b, pa.int32()), pa.array(far_a), pa.array(far_b)], names=["id", "label", "x", "cell", "far_a", "far_b"])

    placed = stage(rows.mapInArrow(of, "id long, label long, x binary, cell int, far_a double, far_b double"), "cells")
    n, radii = np.zeros(len(books[0]) * width, np.int64), (np.zeros(len(books[0]) * width), np.zeros(len(books[0]) * width))
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far_a").alias("a"), F.max("far_b").alias("b")).collect():
        n[r["cell"]] = r["n"]
        # a little more than measured, against rounding
        radii[0][r["cell"]], radii[1][r["cell"]] = r["a"] * (1 + 1e-9) + 1e-6, r["b"] * (1 + 1e-9) + 1e-6
    return Index(dim, books, n, radii), placed.drop("far_a", "far_b")


def _blocks(placed: DataFrame, index: Index, block: int) -> DataFrame:
    """(cell, block, ids, labels, x): the rows of a cell in blocks of about ``block`` rows, ids rising."""

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        blob = lambda v, kind: np.asarray(v).astype(kind).tobytes()
        row = {"cell": [t["cell"][0].as_py()], "block": [t["block"][0].as_py()], "ids": [blob(t["id"], np.int64)], "labels": [blob(t["label"], np.int64)], "x": [b"".join(t["x"].to_pylist())]}
        return pa.table(row, schema=pa.schema([("cell", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary())]))

    parts = _per_cell(np.maximum(1, -(-index.n // block)))
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), parts[F.col("cell")]))
    return stage(dealt.groupBy("cell", "block").applyInArrow(pack, "cell int, block long, ids binary, labels binary, x binary"), "blocks")


def _per_cell(values: np.ndarray) -> Column:
    """An array column with a value for each cell."""
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _groups(index: Index, anchors: DataFrame, size: int) -> DataFrame:
    """Adds ``party``: about ``size`` anchors of neighbouring cells; a cell with more is split by id."""
    per = {r["cell"]: r["n"] for r in anchors.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    start, parts = np.zeros(len(index.n), np.int64), np.ones(len(index.n), np.int64)
    at, held = 0, 0
    for cell in range(len(index.n)):
        n = per.get(cell, 0)
        if held and held + n > size:
            at, held = at + 1, 0
        start[cell], parts[cell] = at, max(1, -(-n // size))
        if parts[cell] > 1:
            at, held = at + int(parts[cell]), 0
        else:
            held += n
    return anchors.withColumn("party", _per_cell(start)[F.col("cell")] + F.pmod(F.xxhash64("id", F.lit(5)), _per_cell(parts)[F.col("cell")]))


_VISIT = "cell int, ids binary, labels binary, x binary, tops binary, needs binary"


def _visits(windows: DataFrame, index: Index, rows: int | None) -> DataFrame:
    """Per party and cell: the anchors that visit it, with their windows.

    ``windows``: party, id, label, x, and arrays ``tops`` and ``needs`` of equal length. A window of an anchor wants rows that score
    from its need to its top. With ``rows`` the heap stops once so many rows are seen; else once no window can gain.
    """

    def of(t: pa.Table) -> pa.Table:
        x = _unpack(b"".join(t["x"].to_pylist()), index.dim)
        ids, labels = (np.asarray(t[c]).astype(np.int64) for c in ("id", "label"))
        tops, needs = t["tops"].to_pylist(), t["needs"].to_pylist()
        width = max(map(len, tops))
        top, need = np.full((len(ids), width), -_MOST_LONG, np.int64), np.full((len(ids), width), _MOST_LONG, np.int64)
        callers: dict[int, list[int]] = {}
        for k in range(len(ids)):
            top[k, : len(tops[k])], need[k, : len(needs[k])] = tops[k], needs[k]
            least, seen = min(needs[k], default=_MOST_LONG), 0
            for bound, cell, own in index.visits(x[k].astype(np.float64)):
                # scores are whole numbers; the slack covers the rounding of the bounds
                slack = 1e-6 + 1e-9 * abs(bound)
                if bound + slack < least:
                    break
                if cell >= 0 and own + slack >= least:
                    callers.setdefault(cell, []).append(k)
                    seen += int(index.n[cell])
                if rows is not None and seen >= rows:
                    break
        out = {name: [] for name in ("cell", "ids", "labels", "x", "tops", "needs")}
        for cell, who in callers.items():
            for name, value in (("cell", cell), ("ids", ids[who].tobytes()), ("labels", labels[who].tobytes()), ("x", x[who].tobytes()), ("tops", top[who].tobytes()), ("needs", need[who].tobytes())):
                out[name].append(value)
        kinds = [("cell", pa.int32()), *[(c, pa.binary()) for c in ("ids", "labels", "x", "tops", "needs")]]
        return pa.table(out, schema=pa.schema(kinds))

    return windows.groupBy("party").applyInArrow(of, _VISIT)


def _best(parts: list[np.ndarray], most: int) -> np.ndarray:
    """Of rows (anchor, window, score, id): the best ``most`` of each window, each id once."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]))]
    starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    return rows[rank < most]


def _search(windows: DataFrame, blocks: DataFrame, index: Index, same: bool, most: int, rows: int | None) -> DataFrame:
    """(anchor, slot, score, id, rank): the best rows of each window among the cells that its anchor visits."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count, limit = 0, 1 << 17

        def given(found: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(found[:, k]) for k in range(4)], names=["anchor", "slot", "score", "id"])

        for batch in batches:
            for r in batch.to_pylist():
                a, b = _unpack(r["x"], index.dim), _unpack(r["bx"], index.dim)
                who, ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["bids"], np.int64)
                equal = np.frombuffer(r["labels"], np.int64)[:, None] == np.frombuffer(r["blabels"], np.int64)[None]
                right = (equal & (who[:, None] != ids[None])) if same else ~equal
                score = products(a, b)
                tops, needs = (np.frombuffer(r[c], np.int64).reshape(len(who), -1) for c in ("tops", "needs"))
                for slot in range(tops.shape[1]):
                    fits = right & (score <= tops[:, slot, None]) & (score >= needs[:, slot, None])
                    if not fits.any():
                        continue
                    if fits.shape[1] > most:
                        # the score of the last wanted row; rows that tie with it are told apart by id
                        last = np.partition(np.where(fits, score, -_MOST_LONG), -most, axis=1)[:, -most, None]
                        fits &= score >= last
                    i, j = np.nonzero(fits)
                    held.append(_best([np.stack([who[i], np.full(len(i), slot), score[i, j], ids[j]], axis=1)], most))
                    count += len(held[-1])
                if count > limit:
                    held = [_best(held, most)]
                    count = len(held[0])
                    if count > limit:
                        yield given(held[0])
                        held, count = [], 0
        if held:
            yield given(_best(held, most))

    packed = blocks.select("cell", F.col("ids").alias("bids"), F.col("labels").alias("blabels"), F.col("x").alias("bx"))
    # visits are up to as many times larger than the anchors as there are cells, which no estimate of their size knows
    met = _visits(windows, index, rows).hint("merge").join(packed, "cell").drop("cell")
    found = met.mapInArrow(of, "anchor long, slot long, score long, id long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return stage(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most), "found")


def _certified(windows: DataFrame, blocks: DataFrame, index: Index, same: bool, most: int, probe: int) -> DataFrame:
    """The best ``most`` rows of each window over the whole index."""
    first = _search(windows, blocks, index, same, most, probe)
    last = first.where(F.col("rank") == most).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("last"))
    raised = F.transform("needs", lambda need, k: F.greatest(need, F.coalesce(F.try_element_at("last", k.cast("long")), need)))
    sharper = windows.join(last.withColumnRenamed("anchor", "id"), "id", "left").withColumn("needs", F.when(F.col("last").isNull(), F.col("needs")).otherwise(raised))
    return _search(sharper.drop("last"), blocks, index, same, most, None)


def mine_hard_negatives(
    rows: DataFrame,
    anchors: Callable[[Column], Column],
    id_col: str = "vec_id",
    label: Column | None = None,
    vector_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    codewords: int = 64,
    per_cell: int = 512,
    sample: int = 8192,
    block: int = 1024,
    party: int = 256,
    probe: int = 1024,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchors``: the condition that an anchor's id meets. Entries are multiplied by ``scale`` and rounded down; a
    score is the exact inner product of such vectors (entries are held within 2 ** 27). An anchor's positives are its best
    ``positives`` other rows of its label; each gets the best ``negatives`` rows of other labels that score at most as much as
    the positive and at least ``percent`` of it. Ties go to the smaller id. A positive with no such row, such as one
    of negative score, gives no rows.

    Null ids, null labels, null vectors, and null or non-finite entries keep a row out, as does a vector that is not of the table's
    commonest length. Rows that repeat an id count once, with the smallest label and then the smallest vector. Further columns of ``rows``
    are ignored; an empty table, or one without anchors, gives no rows. ``sample`` rows fit the codebooks, chosen by
    the hash of their id; every row is indexed.
    """
    label = F.col("label") if label is None else label
    spark = rows.sparkSession
    dim = dimension(rows, vector_col)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not dim:
        return spark.createDataFrame([], schema)
    clean = _one_row_per_id(stage(_clean(rows, id_col, label, vector_col, scale, dim), "vectors"))
    index, placed = build_index(clean, dim, sample, codewords, per_cell)
    blocks = _blocks(placed, index, block)
    asked = stage(_groups(index, placed.where(anchors(F.col("id"))), party).select("party", "id", "label", "x"), "anchors")

    everything = asked.withColumn("tops", F.array(F.lit(_MOST_LONG))).withColumn("needs", F.array(F.lit(-_MOST_LONG)))
    near = _certified(everything, blocks, index, True, positives, probe).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # windows of equal positives are one; a window without whole numbers, as below zero, is none
    ends = near.select("anchor", "positive_score", F.ceil(F.col("positive_score").cast("decimal(20,0)") * percent / 100).cast("long").alias("least")).where("least <= positive_score").distinct()
    slots = ends.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("positive_score", "least"))).alias("slots"))
    slots = stage(slots.select("anchor", F.col("slots.positive_score").alias("tops"), F.col("slots.least").alias("needs")), "windows")
    hard = _certified(asked.join(slots.withColumnRenamed("anchor", "id"), "id"), blocks, index, False, negatives, probe)
    hard = hard.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = slots.select("anchor", F.posexplode("tops").alias("slot", "positive_score"))
    pairs = near.join(named, ["anchor", "positive_score"]).join(hard, ["anchor", "slot"])
    return pairs.select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
