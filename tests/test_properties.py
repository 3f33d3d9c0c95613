"""Scale forms against plain Python over generated inputs."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import outside_domain
from tidemark.operators.cleanse import quarantine
from tidemark.operators.combine import spine_join
from tidemark.operators.dedup import collapse_duplicates, dedup_report
from tidemark.operators.ranking import global_ranks, number_rows, split_by_range, topk_per_group
from tidemark.operators.temporal import asof_join

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

entity = st.sampled_from(["hot", "hot", "hot", "a", "b"])
month = st.dates(dt.date(2010, 1, 1), dt.date(2014, 12, 31)).map(lambda x: x.replace(day=1))
cents = st.integers(-10_000, 10_000)


def brute_asof(left, hist):
    out = {}
    for e, m in left:
        seen = [(h, g) for (x, h), g in hist.items() if x == e and h <= m]
        h, g = max(seen) if seen else (None, "NAO_INFORMADO")
        kind = "NAO_INFORMADO" if h is None else "EXATA" if h == m else "HERDADA"
        lag = None if h is None else (m.year - h.year) * 12 + m.month - h.month
        out[e, m] = (g, kind, lag)
    return out


@FEW
@given(st.sets(st.tuples(entity, month), max_size=30), st.dictionaries(st.tuples(entity, month), st.sampled_from("xyz"), max_size=30))
def test_asof_forms_agree(spark, left, hist):
    asked = spark.createDataFrame(sorted(left), "e string, m date")
    known = spark.createDataFrame([(e, m, g) for (e, m), g in sorted(hist.items())], "e string, m date, g string")
    expected = brute_asof(left, hist)
    for bucket in (None, "year", "quarter"):
        out = asof_join(asked, known, ["e"], "m", "m", ["g"], bucket=bucket).collect()
        assert {(r["e"], r["m"]): (r["g"], r["tipo_atribuicao"], r["meses_defasagem"]) for r in out} == expected
    # the form with a range join, as SQL would write it
    pairs = asked.alias("l").join(known.alias("h"), (F.col("l.e") == F.col("h.e")) & (F.col("h.m") <= F.col("l.m")), "left")
    w = Window.partitionBy("l.e", "l.m").orderBy(F.desc_nulls_last("h.m"))
    best = pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    ranged = best.select("l.e", "l.m", F.coalesce("h.g", F.lit("NAO_INFORMADO")).alias("g")).collect()
    assert {(r["e"], r["m"]): r["g"] for r in ranged} == {k: v[0] for k, v in expected.items()}


@FEW
@given(st.dictionaries(st.integers(0, 15), cents, max_size=12), st.dictionaries(st.integers(0, 15), cents, max_size=12))
def test_spine_conserves_totals(spark, a, b):
    frames = {n: (spark.createDataFrame(sorted(x.items()), f"k int, {n} int"), [n]) for n, x in (("a", a), ("b", b))}
    rows = {r["k"]: r for r in spine_join(frames, ["k"]).collect()}
    assert set(rows) == set(a) | set(b)
    assert all(r["a"] == a.get(k, 0) and r["b"] == b.get(k, 0) for k, r in rows.items())
    assert all((r["fl_tem_a"], r["fl_tem_b"]) == (k in a, k in b) for k, r in rows.items())


@FEW
@given(st.lists(st.sampled_from([-5, 0, 0, 0, 7, 7, 100, 2, 3, 10**9, -(10**9)]) | cents, min_size=1, max_size=40))
def test_global_rank_is_sql_rank(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    out = global_ranks(df.withColumn("v", F.col("v").cast("decimal(20,2)")), ["k"], ["v"], ["r"])
    assert {r["k"]: r["r"] for r in out.collect()} == {i: 1 + sum(x > v for x in values) for i, v in enumerate(values)}


@FEW
@given(st.lists(st.tuples(st.sampled_from([None, 3, 3, 3, -2, 9]) | cents, st.none() | cents), min_size=1, max_size=40))
def test_global_ranks_of_two_metrics(spark, values):
    df = spark.createDataFrame([(i, a, b, f"x{i}") for i, (a, b) in enumerate(values)], "k int, a int, b int, kept string")
    out = {r["k"]: r for r in global_ranks(df.repartition(3), ["k"], ["a", "b"], ["ra", "rb"]).collect()}
    for i, pair in enumerate(values):
        want = [None if v is None else 1 + sum(x[m] is not None and x[m] > v for x in values) for m, v in enumerate(pair)]
        assert [out[i]["ra"], out[i]["rb"]] == want and out[i]["kept"] == f"x{i}" and (out[i]["a"], out[i]["b"]) == pair


@FEW
@given(st.lists(st.sampled_from(["b", "a", "é", None, "B"]), max_size=30))
def test_numbers_follow_the_order(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    out = sorted(number_rows(df, [F.asc_nulls_last("v")], ["k"], "n").collect(), key=lambda r: r["n"])
    assert [r["n"] for r in out] == list(range(1, len(values) + 1))
    assert [r["v"] for r in out] == sorted((v for v in values if v is not None), key=lambda v: v.encode()) + [None] * values.count(None)


@pytest.mark.parametrize("shape", ["narrow", "one value", "null"])
def test_ranges_are_of_equal_size_whatever_the_values(spark, shape):
    """100,000 narrow values, one value that half the rows hold, and NULL for half: no range is far above the mean."""
    value = {"narrow": "1e9 + id * 1e-3", "one value": "if(id % 2 = 0, 7, id)", "null": "if(id % 2 = 0, null, id)"}[shape]
    df = spark.range(100_000).selectExpr("id", f"cast({value} as decimal(20,4)) as v")
    with_aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in split_by_range(df, [F.desc_nulls_last("v")], ["id"]).groupBy("__range").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1.5 * 25_000
        ranks = global_ranks(df, ["id"], ["v"], ["r"])
        greatest, ties = ranks.agg(F.max("r"), F.max(F.when(F.col("v") == 7, F.col("r")))).first()
        assert greatest == {"narrow": 100_000, "one value": 100_000, "null": 50_000}[shape]
        assert ties == {"narrow": None, "one value": 49_997, "null": 49_997}[shape]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_aqe)


@FEW
@given(st.lists(st.tuples(entity, cents), max_size=40), st.integers(1, 5))
def test_topk_keeps_the_greatest(spark, data, k):
    df = spark.createDataFrame([(i, e, v) for i, (e, v) in enumerate(data)], "i int, e string, v int")
    kept = Counter((r["e"], r["v"]) for r in topk_per_group(df, ["e"], "v", k, ["i"]).collect())
    expected = Counter()
    for e in {x for x, _ in data}:
        expected.update((e, v) for v in sorted((v for x, v in data if x == e), reverse=True)[:k])
    assert kept == expected


@FEW
@given(st.lists(st.tuples(st.sampled_from(["k", "j", None]), st.integers(-3, 3)), max_size=30))
def test_dedup_report_counts(spark, data):
    collapsed = collapse_duplicates(spark.createDataFrame(data, "k string, v int"))
    r = dedup_report(collapsed, F.col("v")).first()
    distinct = set(data)
    assert (r["linhas_antes"], r["linhas_depois"]) == (len(data), len(distinct))
    assert r["soma_removida"] == sum(v for _, v in data) - sum(v for _, v in distinct)


@FEW
@given(st.lists(st.sampled_from(["A", "B", "a", "", None]), max_size=30))
def test_quarantine_partitions_rows(spark, codes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, c string")
    good, bad = quarantine(df, outside_domain("c", ["A", "B"]), "t", "r")
    kept = {r["i"] for r in good.collect()}
    set_aside = {int(r["registro_json"].split('"i":')[1].split(",")[0]) for r in bad.collect()}
    assert kept | set_aside == set(range(len(codes))) and not kept & set_aside
    assert kept == {i for i, c in enumerate(codes) if c in ("A", "B")}


def test_hot_entity_spreads_over_buckets(spark):
    """With buckets no window partition holds more than one bucket of the hot entity."""
    days = spark.range(4000).select(F.lit("hot").alias("e"), F.date_add(F.lit("2010-01-01").cast("date"), F.col("id").cast("int")).alias("m"))
    hist = days.filter(F.dayofmonth("m") == 1).withColumn("g", F.date_format("m", "yyyyMM"))
    out = asof_join(days, hist, ["e"], "m", "m", ["g"], bucket="year")
    wrong = out.filter(F.col("g") != F.date_format("m", "yyyyMM"))
    assert out.count() == 4000 and wrong.count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [last(__h" in plan and "[e#" in plan


@pytest.mark.parametrize("salted", [0, 3])
def test_rank_with_one_value_for_a_third(spark, salted):
    values = [7] * 30 + list(range(60)) + [salted]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    out = global_ranks(df.withColumn("v", F.col("v").cast("double")), ["k"], ["v"], ["r"])
    assert {r["k"]: r["r"] for r in out.collect()} == {i: 1 + sum(x > v for x in values) for i, v in enumerate(values)}
