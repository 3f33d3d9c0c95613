"""Every registered query against its SQL, and the shape of the plans behind them."""

import os
import re

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference
from tidemark.plans.catalog_of_queries import ORACLE, QUERIES

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    assert not re.search(r"CartesianProduct|ArrowEvalPython|BatchEvalPython|MapInPandas", text)
    assert "BroadcastNestedLoopJoin" not in text
    assert difference(df, con, ORACLE[name]) is None


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def scans(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))


def test_scans_read_only_what_they_need(spark):
    (fields,) = scans(QUERIES["b1_annual_flow"](spark, FOLDER))[:1]
    assert {f.split(":")[0] for f in fields.split(",")} == {"l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"}
    text = plan(QUERIES["j8_spine_flow"](spark, FOLDER))
    assert text.count("EqualTo(o_orderstatus,") >= 3  # each source's filter reaches its scan


def test_period_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(l_shipdate" in plan(QUERIES["j3_full_outer"](spark, FOLDER))


def test_no_set_is_gathered_from_raw_rows(spark):
    for name in ("a6_distinct_set", "f6_collection"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "collect_set" not in text and text.count("WindowGroupLimit") >= 2


def test_one_scan_for_all_references_of_a_table(spark):
    scanned = [f for f in scans(QUERIES["d31_fk"](spark, FOLDER)) if "l_suppkey" in f or "l_orderkey" in f]
    assert len(scanned) == 1
    assert len([f for f in scans(QUERIES["d31_audit"](spark, FOLDER)) if "l_suppkey" in f]) == 1
    assert all(plan(QUERIES[q](spark, FOLDER)).count("FileScan parquet") == 1 for q in ("d13_outside_codes", "d10_evidence"))


def test_topk_is_cut_before_the_shuffle(spark):
    assert plan(QUERIES["w6_position"](spark, FOLDER)).count("WindowGroupLimit") >= 2


def test_spine_shuffles_no_more_than_its_sources(spark):
    """Three grouped sources, and the stacked rows."""
    initial = plan(QUERIES["j8_spine_flow"](spark, FOLDER))
    assert initial.count("Exchange hashpartitioning") <= 4


def test_asof_pairs_no_rows(spark):
    assert plan(QUERIES["j6_asof_bridge"](spark, FOLDER)).count("Join") == 1  # lines with their orders, nothing else
