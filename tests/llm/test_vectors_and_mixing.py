"""Hard negatives, source mixing and whitening: brute force, odd rows, hot groups, empty tables."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, difference
from tidemark.llm import hard_negatives, queries
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.mixing import mix_sources
from tidemark.llm.whitening import Spectrum, fit_whitening, rank_one, whiten

FOLDER = "/root/testdata/sf0.001"
ODD = "vec_id long, embedding array<float>, label int, id string, x int, cell int, n int, v int, rank int, source string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Every fault a row can have, repeated ids, ties, and columns whose names the operators use."""
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in rng.normal(size=4)], int(rng.integers(3))) for i in range(60)]
    good += [(100 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(30)]
    bad = [(201, None, 1), (202, [1.0, None, 0.0, 1.0], 1), (203, [1.0, NAN, 0.0, 1.0], 1), (204, [1.0, INF, 0.0, 1.0], 1), (205, [1.0, 2.0], 1), (206, [], 1)]
    bad += [(207, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0, 1.0], 1)]
    again = [good[3], good[3], (4, [9.0, 9.0, 9.0, 9.0], 2)]
    return spark.createDataFrame([(*r, "s", 1, 2, 3, 4, 5, "t") for r in good + bad + again], ODD)


def mined(rows, step, scale=256.0, share=80):
    """The definition, pair by pair; ``rows`` are (id, label, vector)."""
    one = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or len(v) != 4 or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = tuple(math.floor(scale * c) for c in v)
        one[i] = min(one.get(i, (label, x)), (label, x))
    out = set()
    for a, (label, x) in one.items():
        if a % step:
            continue
        scores = sorted(((-sum(p * q for p, q in zip(x, y, strict=True)), j, lab) for j, (lab, y) in one.items() if j != a))
        for s, p, _ in [r for r in scores if r[2] == label][:5]:
            fits = [r for r in scores if r[2] != label and -share * s <= -100 * r[0] <= -100 * s][:5]
            out |= {(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits)}
    return out


@pytest.mark.parametrize("sizes", [{}, {"codewords": 4, "per_cell": 4, "block": 3, "party": 2, "probe": 5}])
def test_hard_negatives_equal_brute_force(spark, odd_vectors, sizes):
    got = mine_hard_negatives(odd_vectors, lambda i: i % 3 == 0, **sizes).collect()
    want = mined([(r.vec_id, r.label, r.embedding) for r in odd_vectors.collect()], 3)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100
    # of two rows under one id the smaller label counts, and a tie goes to the smaller id
    assert any(r.anchor_id == 102 and r.positive_score == r.negative_score for r in got)


def test_hard_negatives_stop_before_all_cells(spark):
    """Clustered rows: the heap leaves most cells unread, and nothing is lost."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(24, 4)) * 20
    rows = [(i, [float(c) for c in centres[i % 24] + rng.normal(size=4) * 0.05], i % 5) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clean = hard_negatives._clean(df, "vec_id", F.col("label"), "embedding", 256.0, 4)
    index, placed = hard_negatives.build_index(clean, 4, 1000, 16, 8)
    asked = hard_negatives._groups(index, placed.where("id % 100 = 0"), 8)
    # a need as high as the best scores of the anchors' own cluster
    windows = asked.withColumn("tops", F.array(F.lit((1 << 62)))).withColumn("needs", F.array(F.lit(int(256 * 256 * 0.9 * (centres[0] ** 2).sum()))))
    read = hard_negatives._visits(windows.where("id = 0"), index, None).count()
    assert 0 < read < 0.5 * (index.n > 0).sum()
    got = mine_hard_negatives(df, lambda i: i % 100 == 0, codewords=16, per_cell=8, probe=50).collect()
    assert {tuple(r) for r in got} == mined([(i, lab, v) for i, v, lab in rows], 100)


def test_cells_come_by_falling_bounds_that_hold(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, size=(400, 6))
    books = tuple(hard_negatives._codebook(h.astype(float), 5) for h in hard_negatives._halves(x))
    bare = hard_negatives.Index(6, books, np.zeros(0), (np.zeros(0), np.zeros(0)))
    (a, b), (far_a, far_b) = bare.codes(x.astype(float))
    cell = a * len(books[1]) + b
    n, ra, rb = np.zeros(25, int), np.zeros(25), np.zeros(25)
    np.add.at(n, cell, 1), np.maximum.at(ra, cell, far_a), np.maximum.at(rb, cell, far_b)
    index = hard_negatives.Index(6, books, n, (ra, rb))
    for anchor in x[:20]:
        seen = list(index.visits(anchor.astype(float)))
        assert len(seen) == 25 and sorted(c for _, c, _ in seen if c >= 0) == sorted(np.flatnonzero(n))
        assert all(p[0] >= q[0] for p, q in zip(seen, seen[1:], strict=False))
        for bound, c, own in seen:
            if c >= 0:
                best = int((x[cell == c] @ anchor).max())
                assert best <= own + 1e-6 <= bound + 2e-6


def test_products_are_exact():
    big = np.array([[1 << 27, -(1 << 27), 3]], np.int32)
    assert hard_negatives.products(big, big)[0, 0] == 2 * (1 << 54) + 9
    assert hard_negatives.products(big[:, :0], big[:, :0]).shape == (1, 1)


def test_hard_negatives_of_nothing(spark, odd_vectors):
    for df in (odd_vectors.limit(0), odd_vectors.where("embedding is null"), odd_vectors.where("label is null")):
        assert mine_hard_negatives(df, lambda i: i % 3 == 0).collect() == []
    assert mine_hard_negatives(odd_vectors, lambda i: i < 0).collect() == []


def test_hard_negatives_equal_sql(spark):
    assert difference(queries.op11_hard_negatives(spark, FOLDER), connect(FOLDER), queries.ORACLE["op11_hard_negatives"]) is None


# mixing


def _targets(sizes, weights=(5, 2, 1), most=3):
    """Water-filling, source by source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        level = (total - sum(most * sizes[s] for s in full)) / (sum(weight[s] for s in names if s not in full) or 1)
        more = {s for s in names if s not in full and weight[s] * level > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= more


def _tilt(sizes, target, most=3):
    mean = sum(sizes) / len(sizes)
    lo, hi = -2000.0, 2000.0
    for _ in range(300):
        at = (lo + hi) / 2
        got = sum(s * min(most, math.exp(min(at * s / mean, 50))) for s in sizes)
        lo, hi = (at, hi) if got < target else (lo, at)
    return {s: min(most, math.exp(min(lo * s / mean, 50))) for s in sizes}


def test_mixing_meets_targets_by_the_least_relative_entropy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in docs.collect()}
    got = {r.doc_id: r for r in mix_sources(docs).collect()}
    sizes = collections.Counter()
    for source, size in texts.values():
        sizes[source] += size
    want = _targets(sizes)
    of = collections.defaultdict(list)
    for i, (source, size) in texts.items():
        r = got[i]
        assert (r.size, r.source_size, r.taken) == (size, sizes[source], size * r.copies) and 0 <= r.copies <= 3
        assert r.target == pytest.approx(want[source], rel=1e-12)
        of[source].append(i)
    assert len(got) == len(texts)
    for source, ids in of.items():
        if want[source] < 3 * sizes[source]:
            rates = _tilt([texts[i][1] for i in ids], want[source])
            assert all(got[i].rate == pytest.approx(rates[texts[i][1]], rel=1e-6) for i in ids if texts[i][1])
        least = min(texts[i][1] for i in ids if texts[i][1])
        assert abs(sum(got[i].taken for i in ids) - want[source]) <= max(0.01 * want[source], least)
    # whole copies stay by the rates but for the few documents that settle a source
    assert sum(abs(r.copies - r.rate) > 1 for r in got.values()) <= 3 * len(of)


def test_mixing_does_not_depend_on_the_dealing_of_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [sorted(tuple(r) for r in mix_sources(d).collect()) for d in (docs, docs.repartition(7), docs.orderBy(F.desc("text")))]
    assert rows[0] == rows[1] == rows[2]


def test_mixing_of_odd_rows(spark):
    schema = "doc_id long, text string, source string, size int, n int, place int, bucket int, h int"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t\x0b", "a"), (4, "one two three\x1cfour", "b"), (5, "w " * 50_000, "b"), (6, "x y z", None), (6, "x y z", None), (None, "p q", "b"), (7, "é\r\nü", "é")]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], schema)
    got = mix_sources(df)
    assert got.count() == len(rows)
    by = {r.doc_id: r for r in got.collect()}
    assert [by[i].size for i in (1, 2, 3, 4, 5, 6, 7, None)] == [0, 0, 0, 2, 50_000, 3, 2, 2]
    assert by[1].target == 0 and by[1].taken == 0 and by[1].source_size == 0 and by[6].source_size == 6
    # the null source comes last and weighs as the fourth: 5; every other one is far below its share and is taken three times
    assert by[6].target == 18 and by[6].copies == 3 and by[7].copies == 3
    assert mix_sources(df.limit(0)).collect() == []
    assert mix_sources(df.where("source = 'a'")).where("taken > 0").count() == 0


def test_mixing_deals_a_hot_class_to_buckets(spark):
    """30,000 documents of one size in one source: the copies that are one more go to an exact number of them."""
    hot = spark.range(30_000).selectExpr("id as doc_id", "'one two three' as text", "'hot' as source")
    rest = spark.range(30_000, 33_000).selectExpr("id as doc_id", "repeat('w ', cast(id % 97 as int)) as text", "concat('s', id % 3) as source")
    got = mix_sources(hot.unionByName(rest))
    sums = got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("copies").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 100 and r.most <= 3 for r in sums)
    assert got.where("source_size = 90000").select("copies").distinct().count() == 2


# whitening


def whitened_by_hand(vectors, scale=1024.0, shift=100_000):
    x = [[math.floor(scale * c) + shift for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    away = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array(away, float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    return n, [sum(c * c for c in row) for row in away], centred @ u[:, ::-1][:, :8] / np.sqrt(e[::-1][:8]), e[::-1], np.trace(cov)


@pytest.mark.parametrize("parts", [1, 40])  # 40 spectra take two rounds of the tree
def test_whitening_equals_a_full_eigendecomposition(spark, parts):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id")
    data = rows.collect()
    n, deviation, white, e, trace = whitened_by_hand([r.embedding for r in data])
    got = collections.defaultdict(dict)
    for r in whiten(rows.repartition(parts)).collect():
        got[r.vec_id][r.component] = r
    assert len(got) == n and all(sorted(c) == list(range(1, 9)) for c in got.values())
    first = [got[r.vec_id] for r in data]
    for k in range(8):
        own = np.array([c[k + 1].whitened for c in first])
        sign = np.sign(own @ white[:, k])
        assert np.abs(own - sign * white[:, k]).max() < 1e-8
        assert first[0][k + 1].explained == pytest.approx(e[k] / trace, rel=1e-10)
    assert [int(c[1].deviation) for c in first] == deviation
    assert {(c[1].n, c[8].identity_error < 1e-9) for c in first} == {(n, True)}


def test_whitening_of_odd_rows(spark, odd_vectors):
    kept = [r for r in odd_vectors.collect() if r.embedding and len(r.embedding) == 4 and all(c is not None and math.isfinite(c) for c in r.embedding)]
    n, deviation, white, e, trace = whitened_by_hand([r.embedding for r in kept])
    got = whiten(odd_vectors).collect()
    # labels play no part, repeated rows count each, and a null id keeps its row
    assert len(got) == 4 * n and sum(r.vec_id is None for r in got) == 4
    assert collections.Counter((r.vec_id, int(r.deviation)) for r in got if r.component == 1) == collections.Counter((r.vec_id, d) for r, d in zip(kept, deviation, strict=True))
    assert max(r.identity_error for r in got) < 1e-9
    assert whiten(odd_vectors.limit(0)).collect() == [] and whiten(odd_vectors.where("embedding is null")).collect() == []
    assert fit_whitening(odd_vectors.limit(0)) is None


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whiten(same).collect()
    assert len(got) == 27 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.identity_error == 0 for r in got)
    # one entry that varies: the other components have no variance, and none comes from rounding
    line = spark.createDataFrame([(i, [float(i), 2.0, 3.0]) for i in range(9)], "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whiten(line).collect()}
    assert got[0, 1].explained == pytest.approx(1) and abs(got[0, 1].whitened) == pytest.approx(4 / math.sqrt(60 / 9))
    assert got[0, 2].whitened is None and got[0, 1].identity_error < 1e-12
    # sums beyond 64 bits stay exact
    wide = spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 0.5])], "vec_id long, embedding array<double>")
    one = {r.vec_id: r for r in whiten(wide, scale=1.0, shift=0).where("component = 1").collect()}
    assert int(one[1].deviation) == int(one[2].deviation) == (2 * 10**12) ** 2


@pytest.mark.parametrize("block", [1, 16, 4096])
def test_rank_one_updates_follow_the_scatter(block):
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 24):
        x = (np.floor(rng.normal(size=(300, d)) * 90) + 100_000).astype(np.int64)
        x[40:70] = x[0]  # equal rows, an entry that repeats another, and one that never changes: all deflate
        if d > 2:
            x[:, 2], x[:, 0] = x[:, 1], 7
        whole, left, right = (Spectrum.empty(d) for _ in range(3))
        whole.add(x, block), left.add(x[:80], block), right.add(x[80:], block)
        left.merge(right)
        centred = x - x.mean(axis=0)
        scatter = centred.T @ centred
        for s in (whole, left):
            assert s.n == 300 and list(s.sums) == list(x.sum(axis=0))
            top = max(np.linalg.eigvalsh(scatter)[-1], 1.0)
            assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-10 * top
            assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-10
            assert (np.diff(s.values) >= 0).all()


def test_a_rank_one_update_of_equal_values_and_of_nothing():
    values, vectors = rank_one(np.zeros(3), np.eye(3), 2.0, np.array([1.0, 1.0, 1.0]))
    assert values == pytest.approx([0, 0, 6]) and np.abs(vectors.T @ vectors - np.eye(3)).max() < 1e-14
    same = rank_one(values, vectors, 0.0, np.ones(3))
    assert same[0] is values and rank_one(values, vectors, 1.0, np.zeros(3))[1] is vectors
