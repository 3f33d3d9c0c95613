"""Near-duplicate documents by MinHash with tensored banding and exact verification.

Method
------
A document is its set of distinct word shingles. Two small collections of ``pieces`` keys, each key made of
two minhash values, give ``pieces ** 2`` table keys: every pair of a key of the first and one of the second
collection. 32 minhash values thus serve 64 tables of four values each. Two sets of similarity 0.8 miss all
64 tables with probability 2 * (1 - 0.8 ** 2) ** 8 = 0.0006, of 0.9 with 0.000003.

Equal sets are one node. A table key is looked up in two steps. Nodes are dealt by the keys of the first collection that some
other node has too, ``pieces`` rows a node at most; whether two nodes of such a bucket also share a key of the second
collection, and so a table, is read off their sketches, which hold 32 bits of every key.

Every node is first held against the smallest id among the buckets it is in most often. This star of links
contracts a giant group of near copies in linear work; its buckets that hold one component are done. A second star joins what
is left of a bucket to a member of the largest component in it. Then nodes of the buckets that still hold several
components are dealt to blocks of bounded size, anew in each round, and every node proposes the partners in its
block that are not yet in its component, are of a size that allows the similarity, share a table, and agree with it on as many
minhash values and as much of a second sketch as all but a few pairs in ten thousand of the least similarity do,
best first. A pair is proposed in the first bucket that it shares, not in all of them, leaving aside buckets that take several blocks.
In the last round all open buckets are compared whole; a large one becomes a grid in which its nodes outside its largest component
meet all. There the nodes carry their sets as 32-bit hashes, so a block proposes only pairs that are similar enough, and no pair that others
already connect: as many pairs as nodes at most, however large the group is.
Proposals are confirmed on the full sets, and confirmed links are contracted to components before the next
round. Blocks are the unit that is dealt to tasks, so no bucket is gathered in one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow
from tidemark.llm.components import merge_components
from tidemark.llm.words import LOWER, SPACE, PrefixHash, mix, runs, shingles
from tidemark.session import stage

PIECES = 8
VALUES = 4 * PIECES
_STEP = np.arange(1, VALUES + 1, dtype=np.uint64)
_FACTORS = mix(_STEP * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_MASKS = mix(_STEP * np.uint64(0xA0761D6478BD642F))

#: One more sketch, for proposals: the least hash of each of so many ranges of hashes, by one byte; 0 where a range is empty.
RANGES = 128
_EDGES = (np.arange(RANGES + 1, dtype=np.uint64) << np.uint64(57)).astype(np.uint64)

#: What a node does in a block: compare with all, or only ask, or only answer.
BOTH, ASKS, ANSWERS = 0, 1, 2

#: A document that is in very many pairs has its text dealt to so many tasks at most.
HUB_SALTS = 32

#: Partners a node proposes per bucket and round; 0 compares whole.
ROUNDS = (3, 0)

#: Sets of more shingles than this aren't carried to blocks; their pairs are told by the sketches and confirmed on the texts.
CARRIED = 1 << 14


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    for run in runs(texts):
        data = LOWER[run.data]
        starts, ends, first = run.spans(~SPACE[data])
        words = PrefixHash(data).of(starts, ends)
        windows = shingles(words, size)
        for i in range(run.n):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= size:
                yield np.unique(windows[lo : hi - size + 1])
            elif hi > lo:
                yield shingles(words[lo:hi], hi - lo)
            else:
                yield np.zeros(0, np.uint64)


def minhashes(values: np.ndarray) -> np.ndarray:
    """``VALUES`` minimum hashes of a set, 32 bits each."""
    least = np.empty(VALUES, np.uint64)
    for j in range(VALUES):
        h = (values ^ _MASKS[j]) * _FACTORS[j]
        least[j] = (h ^ (h >> np.uint64(29))).min()
    return least >> np.uint64(32)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Per row: id, set size, a hash of the set, both key collections, and a sketch.

    The sketch holds one byte of every minhash value, ``RANGES`` bytes of least hashes, and 32 bits of every key.
    """

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, names, keys, sketches = [], [], [], []
        for values in shingle_sets(batch.column(1), size):
            counts.append(len(values))
            if not len(values):
                names.append(None), keys.append(None), sketches.append(None)
                continue
            least = minhashes(values)
            names.append(int(mix(np.bitwise_xor.reduce(mix(values + np.uint64(1)), keepdims=True) + values[:1] + np.uint64(len(values)))[0].view(np.int64)))
            pairs = mix(mix(least[0::2] + _STEP[: 2 * PIECES] * np.uint64(0x2545F4914F6CDD1D)) + least[1::2])
            keys.append(pairs.view(np.int64))
            at = np.searchsorted(values, _EDGES[:RANGES])
            ends = np.r_[at[1:], len(values)]
            ranges = np.where(at < ends, values[np.minimum(at, len(values) - 1)] % np.uint64(255) + np.uint64(1), 0)
            sketches.append(least.astype(np.uint8).tobytes() + ranges.astype(np.uint8).tobytes() + pairs.astype(np.uint32).tobytes())
        return pa.record_batch(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            names=["id", "n_shingles", "set_id", "keys", "sketch"],
        )

    return map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), of, "id long, n_shingles long, set_id long, keys array<long>, sketch binary")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal minhash values of every row of ``a`` with every row of ``b``."""
    total = np.zeros((len(a), len(b)), np.uint8)
    for j in range(a.shape[1]):
        total += a[:, j, None] == b[None, :, j]
    return total


def _alike(sketch: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether the least hashes of the ranges agree on about ``least`` of those that either set fills."""
    own = sketch[:, VALUES : VALUES + RANGES]
    good = np.zeros(len(i), bool)
    for lo in range(0, len(i), 1 << 14):
        a, b = own[i[lo : lo + (1 << 14)]], own[j[lo : lo + (1 << 14)]]
        good[lo : lo + (1 << 14)] = ((a == b) & (a > 0)).sum(axis=1) >= least * ((a > 0) | (b > 0)).sum(axis=1)
    return good


def _here(sketch: np.ndarray, i: np.ndarray, j: np.ndarray, crowded: np.ndarray, piece: int, oversize: bool, whole: bool) -> np.ndarray:
    """Whether a pair shares a table, and this bucket is the one to propose it.

    That is the first one that it shares; while crowded ones are compared in parts, the first not crowded one, or a crowded one if there is no other.
    """
    keys = np.ascontiguousarray(sketch[:, VALUES + RANGES :]).view(np.uint32)
    good = np.zeros(len(i), bool)
    for lo in range(0, len(i), 1 << 14):
        x, y = i[lo : lo + (1 << 14)], j[lo : lo + (1 << 14)]
        same = keys[x] == keys[y]
        tabled, free = same[:, PIECES:].any(axis=1), same[:, :PIECES]
        if not whole:
            free &= (crowded[x][:, None] >> np.arange(PIECES, dtype=np.uint64)) & np.uint64(1) == 0
        first = free.any(axis=1) & (free.argmax(axis=1) == piece)
        good[lo : lo + (1 << 14)] = tabled & (~free.any(axis=1) if oversize and not whole else first)
    return good


def least_agreement(percent: int) -> tuple[int, float]:
    """Minhash values, and part of the second sketch, on which all but a few in ten thousand pairs of this similarity agree."""
    p = percent / 100
    spread = (p * (1 - p)) ** 0.5
    return int(VALUES * p - 4.2 * spread * VALUES**0.5), p - 4 * spread / RANGES**0.5


def _candidates(
    ids: np.ndarray, comps: np.ndarray, crowded: np.ndarray, role: np.ndarray, sizes: np.ndarray, sketch: np.ndarray, piece: int, oversize: bool, whole: bool, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block that this bucket is to propose and the sketches don't rule out, with their agreement."""
    if role[0] == BOTH:
        rows = columns = np.arange(len(ids))
        agree = np.triu(_agreement(sketch[:, :VALUES], sketch[:, :VALUES]))
    else:
        rows, columns = np.flatnonzero(role == ASKS), np.flatnonzero(role == ANSWERS)
        agree = _agreement(sketch[rows, :VALUES], sketch[columns, :VALUES])
    values, ranges = least_agreement(percent)
    r, c = np.nonzero(agree >= values)
    score, i, j = agree[r, c].astype(np.int16), rows[r], columns[c]
    good = (comps[i] != comps[j]) & (ids[i] != ids[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))
    score, i, j = score[good], i[good], j[good]
    good = _alike(sketch, i, j, ranges)
    score, i, j = score[good], i[good], j[good]
    good = _here(sketch, i, j, crowded, piece, oversize, whole)
    return score[good], i[good], j[good]


def _similar(i: np.ndarray, j: np.ndarray, comps: np.ndarray, hashes: list[np.ndarray | None], percent: int) -> np.ndarray:
    """Which of the pairs are similar enough by their carried sets and connect what other pairs don't; those with a set that isn't carried stay."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = y
        return x

    carried = np.array([h is not None for h in hashes])
    kept = np.zeros(len(i), bool)
    order = np.argsort(i, kind="stable")
    for pairs in np.split(order, np.flatnonzero(np.diff(i[order])) + 1):
        own = hashes[i[pairs[0]]]
        pairs = pairs[[find(int(c)) != find(int(comps[i[pairs[0]]])) for c in comps[j[pairs]]]]
        told = carried[j[pairs]] if own is not None else np.zeros(len(pairs), bool)
        kept[pairs[~told]] = True
        pairs = pairs[told]
        if not len(pairs):
            continue
        others = [hashes[k] for k in j[pairs]]
        lengths = np.array([len(o) for o in others])
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        common = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(lengths) - lengths)
        for k in pairs[100 * common >= percent * (len(own) + lengths - common)]:
            x, y = find(int(comps[i[k]])), find(int(comps[j[k]]))
            if x != y:
                root[max(x, y)] = min(x, y)
                kept[k] = True
    return kept


def _proposals(
    ids: np.ndarray, comps: np.ndarray, crowded: np.ndarray, role: np.ndarray, sizes: np.ndarray, sketch: np.ndarray, hashes: np.ndarray, piece: int, oversize: bool, most: int, percent: int
) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of a block: nodes with their best partners of other components, and whether any were left out."""
    score, i, j = _candidates(ids, comps, crowded, role, sizes, sketch, piece, oversize, not most, percent)
    if not most and len(i):
        sets = [None if h is None else np.frombuffer(h, np.uint32) for h in hashes]
        good = _similar(i, j, comps, sets, percent)
        return i[good], j[good], False
    if not most or not len(i):
        return i, j, False
    # the nodes of the largest component wait for proposals
    names, counts = np.unique(comps, return_counts=True)
    asks = comps != names[counts.argmax()] if counts.max() > 1 else np.ones(len(ids), bool)
    who, pair = np.r_[i, j], np.r_[np.arange(len(i)), np.arange(len(i))]
    keep = asks[who]
    who, pair = who[keep], pair[keep]
    order = np.lexsort((-score[pair], who))
    who, pair = who[order], pair[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    chosen = np.unique(pair[rank < most])
    return i[chosen], j[chosen], bool((rank >= most).any())


def _dealt(members: DataFrame, block: int, turn: int, last: bool) -> DataFrame:
    """``members`` with the block that each compares its nodes in, and their role there.

    Buckets of up to ``block`` nodes are one block. Larger ones are dealt to blocks by the id and ``turn``; in the last
    turn they become a grid, in which every node outside the largest component meets every node.
    """
    blocks = F.ceil(F.col("n") / F.lit(block))
    dealt = F.when(blocks > 1, F.pmod(F.xxhash64("id", F.lit(turn)), blocks)).otherwise(0).cast("long")
    if not last:
        return members.withColumn("block", dealt).withColumn("role", F.lit(BOTH))
    small = members.where(F.col("n") <= block).withColumn("block", F.lit(0).cast("long")).withColumn("role", F.lit(BOTH))
    large = members.where(F.col("n") > block)
    counts = large.groupBy("key", "component").agg(F.count("*").alias("c"))
    lead = counts.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("lead"), F.max("c").alias("lead_n"))
    half = F.lit(max(block // 2, 1))
    large = large.join(lead, "key").withColumn("across", F.ceil((F.col("n") - F.col("lead_n")) / half)).withColumn("down", F.ceil(F.col("n") / half))
    asking = large.where("component <> lead").withColumn("g", F.pmod(F.xxhash64("id", F.lit(turn)), "across")).withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)))
    asked = large.withColumn("r", F.pmod(F.xxhash64("id", F.lit(turn)), "down")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)))
    grid = asking.withColumn("role", F.lit(ASKS)).unionByName(asked.withColumn("role", F.lit(ANSWERS)))
    grid = grid.withColumn("block", F.col("g") * F.col("down") + F.col("r"))
    return small.unionByName(grid.select(small.columns))


def _block_pairs(members: DataFrame, most: int, block_size: int, percent: int) -> DataFrame:
    """Proposals of every (key, block), read in sorted order so that no block meets another."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def pairs(key, block, ids, comps, piece, n, crowded, role, sizes, hashes, sketch):
            edges = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(key)], strict=True):
                if hi - lo > 1 and (comps[lo:hi] != comps[lo]).any():
                    own = (x[lo:hi] for x in (ids, comps, crowded.view(np.uint64), role, sizes, sketch, hashes))
                    i, j, more = _proposals(*own, int(piece[lo]), bool(n[lo] > block_size), most, percent)
                    a, b = ids[lo:hi][i], ids[lo:hi][j]
                    yield np.minimum(a, b), np.maximum(a, b), np.full(len(i), more)

        def batch_of(parts):
            parts = list(parts)
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
            return pa.record_batch(columns, names=["a", "b", "more"])

        for batch in batches:
            n = len(batch)
            if not n:
                continue
            sketch = np.frombuffer(b"".join(batch.column(10).to_pylist()), np.uint8).reshape(n, -1)
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(10)] + [sketch]
            now = [np.concatenate(x) for x in zip(kept, now, strict=True)] if kept else now
            key, block = now[0], now[1]
            cut = int(np.flatnonzero((key != key[-1]) | (block != block[-1]))[-1]) + 1 if (key[0] != key[-1] or block[0] != block[-1]) else 0
            kept = [x[cut:] for x in now]
            if cut:
                yield batch_of(pairs(*[x[:cut] for x in now]))
        if kept:
            yield batch_of(pairs(*kept))

    dealt = members.select("key", "block", "id", "component", "piece", "n", "crowded", "role", "n_shingles", "hashes", "sketch").repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(over, "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more"))


def carried_sets(texts: DataFrame, size: int) -> DataFrame:
    """(id, hashes): the set of each text as rising 32-bit hashes; null beyond ``CARRIED``."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [None if len(v) > CARRIED else np.unique((v >> np.uint64(32)).astype(np.uint32)).tobytes() for v in shingle_sets(batch.column(1), size)]
        return pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], names=["id", "hashes"])

    return map_arrow(texts.select("id", "text"), of, "id long, hashes binary")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. ``texts``: (id, text)."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for x, y in zip(shingle_sets(batch.column(2), size), shingle_sets(batch.column(3), size), strict=True):
            common = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    # a hub is in very many pairs: they are dealt by both ids, and only texts that a pair names are dealt out
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).join(pairs.select("b").distinct(), "b", "left_semi")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(HUB_SALTS)))
    hubs = first.join(salted.select("a", "salt").distinct(), "a")
    both = salted.join(second, "b").join(hubs, ["a", "salt"])
    return map_arrow(both.select("a", "b", "text_a", "text_b"), of, "a long, b long")


def one_row_per_id(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(id, text) with one row for each id that is not null, and whether any id repeats; of several texts the least counts."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    again = stage(rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated_ids")
    if again.isEmpty():
        return rows, False
    once = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return rows.join(again, "id", "left_anti").unionByName(once), True


def _star(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """Links (a, b) from a member of the largest component of a bucket to each node outside it; one link a node at most, to the member it meets most often."""
    if label is None:
        named = members.withColumn("component", F.col("id"))
        reps = members.groupBy("key").agg(F.min("id").alias("rep"))
    else:
        named = members.join(label.withColumnRenamed("component", "_c"), "id", "left").withColumn("component", F.coalesce("_c", "id")).drop("_c")
        held = named.groupBy("key", "component").agg(F.count("*").alias("c"), F.min("id").alias("rep"))
        reps = held.groupBy("key").agg(F.max_by(F.struct("rep", "component"), F.struct("c", F.negative("component"))).alias("r"), F.count("*").alias("parts"))
        reps = reps.where("parts > 1").select("key", F.col("r.rep").alias("rep"), F.col("r.component").alias("lead"))
    met = named.join(reps, "key")
    met = met.where("id <> rep") if label is None else met.where("component <> lead")
    often = met.groupBy("id", "rep").agg(F.count("*").alias("c")).where(F.col("c") >= PIECES // 4)
    best = often.groupBy("id").agg(F.min_by("rep", F.struct(F.negative("c"), "rep")).alias("rep"))
    return stage(best.select(F.least("rep", "id").alias("a"), F.greatest("rep", "id").alias("b")).distinct(), "star")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, block: int = 512) -> DataFrame:
    """One row per document: ``doc_id`` (under its own name), ``n_shingles``, ``component_id``, ``kept``.

    ``percent``: two documents are linked when their sets share that part of their union, 80 at least: below, the tables
    would miss pairs. Tokens are runs of anything but ASCII white space, with A-Z lower-cased. ``component_id`` is the smallest id reachable over
    links; ``kept`` marks it. Null and empty texts, or texts of white space, are linked with nothing; texts
    with fewer words than a shingle count as one shingle. A null id keeps its row, alone and kept. Rows that
    repeat an id are one document, of the least of their texts; each gives a row. Further columns of ``docs`` are ignored; an empty table gives no rows.
    """
    if percent < 80:
        raise ValueError("the tables find pairs of 80 percent and more")
    single, repeats = one_row_per_id(docs, id_col, text_col)
    prints = stage(fingerprints(single, "id", "text", shingle), "fingerprints")
    valid = prints.where("set_id is not null and id is not null")
    sets = stage(valid.groupBy("set_id").agg(F.min("id").alias("id")), "sets")

    # keys of the first collection that several nodes have; a node without such a key of the second shares no table
    nodes = valid.join(sets, ["set_id", "id"])
    keys = nodes.select("id", F.posexplode("keys").alias("piece", "key"))
    common = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = stage(keys.join(common, "key"), "shared_keys")
    tabled = shared.where(F.col("piece") < PIECES).join(shared.where(F.col("piece") >= PIECES).select("id").distinct(), "id", "left_semi")
    buckets = stage(tabled.groupBy("key").agg(F.count("*").alias("n"), F.min("piece").alias("piece"), F.bit_xor(F.xxhash64("id")).alias("held")).where("n > 1"), "buckets")
    # of buckets with the same nodes one is enough
    first_of = buckets.groupBy("n", "held").agg(F.min_by("key", "piece").alias("key"))
    crowds = tabled.join(buckets.where(F.col("n") > block).select("key"), "key").groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, piece)")).alias("crowded"))
    members = tabled.join(first_of.select("key", "n"), "key").join(crowds, "id", "left").withColumn("crowded", F.coalesce("crowded", F.lit(0).cast("long")))
    members = stage(members, "members")
    near = stage(members.select("id").distinct(), "near")
    sketches = stage(nodes.join(near, "id", "left_semi").select("id", "n_shingles", "sketch"), "sketches")
    texts = stage(single.where("text is not null").join(near, "id", "left_semi"), "texts")

    label, tested = None, None
    for _ in range(2):
        star = _star(members, label)
        star = star if tested is None else stage(star.join(tested, ["a", "b"], "left_anti"), "star")
        label = merge_components(label, stage(confirmed(star, texts, shingle, percent), "links"))
        tested = star if tested is None else tested.unionByName(star)
    turns = list(ROUNDS)
    while turns:
        most = turns.pop(0)
        open_ = members.join(label.withColumnRenamed("component", "_c"), "id", "left").withColumn("component", F.coalesce("_c", "id")).drop("_c")
        open_ = stage(open_, "labelled")
        split = open_.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        open_ = stage(open_.join(split, "key", "left_semi"), "open")
        # what is done stays done: later rounds look at these buckets alone
        members = open_.drop("component")
        oversize = not open_.where(F.col("n") > block).isEmpty()
        known = sketches.withColumn("hashes", F.lit(None).cast("binary"))
        if not most:
            known = sketches.join(carried_sets(texts.join(open_.select("id").distinct(), "id", "left_semi"), shingle), "id")
        dealt = _dealt(open_, block, len(turns), last=not most).join(known, "id")
        found = stage(_block_pairs(dealt, most, block, percent), "proposals")
        pairs = stage(found.join(tested, ["a", "b"], "left_anti").select("a", "b"), "pairs")
        if not pairs.isEmpty():
            label = merge_components(label, stage(confirmed(pairs, texts, shingle, percent), "links"))
            tested = tested.unionByName(pairs)
        if found.where("more").isEmpty():
            # nothing was left out; only buckets of several blocks still need to be compared whole
            turns = turns[-1:] if oversize else []

    named = sets.join(label.withColumnRenamed("component", "_c"), "id", "left").select("set_id", F.coalesce("_c", "id").alias("component"))
    # empty texts have no set and wait for nobody in the join
    with_set = prints.where("set_id is not null").select("id", "n_shingles", "set_id").join(named, "set_id", "left").select("id", "n_shingles", "component")
    without = prints.where("set_id is null").select("id", "n_shingles", F.col("id").alias("component"))
    out = with_set.unionByName(without)
    if repeats:
        known = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null")
        out = out.where("id is null").unionByName(known.join(out.where("id is not null"), "id"))
    component = F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id")
    out = out.select(F.col("id").alias(id_col), "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
