"""Periods: conditions that say the same, and bounds that reach scans and partitions."""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.period import ALWAYS, YEAR, Period, by_year, during, on_calendar, with_month
from tidemark.plans import analyses as an
from tidemark.plans import roles as r
from tidemark.plans.q_model import PERIOD
from tidemark.plans.catalog_of_queries import QUERIES
from tidemark.plans.registry import Tables
from tidemark.sources import TableStore

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("period", "days"),
    [
        (Period.months("2020-02", "2020-04"), lambda d: (2020, 2) <= (d.year, d.month) <= (2020, 4)),
        (Period.months("2020-02-17"), lambda d: d >= dt.date(2020, 2, 1)),
        (Period.months(None, dt.date(2020, 2, 29)), lambda d: d < dt.date(2020, 3, 1)),
        (Period.years(2019, 2021), lambda d: d.year in (2019, 2021)),
        (Period.years(2020, 2019, 2020), lambda d: d.year in (2019, 2020)),
        (Period.months("2020-02", "2020-04").reaching_back(3), lambda d: (2019, 11) <= (d.year, d.month) <= (2020, 4)),
        (Period.years(2019, 2021).until(), lambda d: d.year <= 2021),
        (ALWAYS, lambda d: True),
    ],
)
@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_the_conditions_say_the_same(spark, period, days, kind):
    dates = [dt.date(2018, 12, 31) + dt.timedelta(days=k) for k in range(0, 1500, 1)]
    df = spark.createDataFrame([(d,) for d in [*dates, None]], "d date").select(F.col("d").cast(kind), F.col("d").alias("day"))
    want = {d for d in dates if days(d)}
    by_raw = {x["day"] for x in with_month(df, "d", period).collect()}
    monthly = df.withColumn("mes_ref", F.trunc("day", "MM")).withColumn(YEAR, F.year("day"))
    by_month = {x["day"] for x in during(monthly, period).collect()}
    assert by_raw - {None} == want and by_month - {None} == want
    assert (None in by_raw) == (None in by_month) == period.whole


def test_years_become_ranges():
    assert Period.years(2001, 2000, 2003).ranges == ((dt.date(2000, 1, 1), dt.date(2001, 12, 1)), (dt.date(2003, 1, 1), dt.date(2003, 12, 1)))
    assert Period.months("2020-02", "2020-04").reaching_back(2).ranges == ((dt.date(2019, 12, 1), dt.date(2020, 4, 1)),)
    assert Period.years() .ranges == () and not Period.years().whole


def test_no_year_asked_reads_nothing(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),)], "d date")
    assert with_month(df, "d", Period.years()).count() == 0


BOUND = ["p10_range", "p18_period_scope", "p19_scope_period", "b2_ytd_flow", "b3_moving_mean", "b7_top5", "b10_unit_balance", "t6_top_magnitude", "d22_outlier", "w3_moving_mean"]


@data
@pytest.mark.parametrize("name", BOUND)
def test_the_period_reaches_the_scan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    found = [p for p in re.findall(r"PushedFilters: \[([^\]]*)", text) if "l_shipdate" in p]
    assert found and all("GreaterThanOrEqual(l_shipdate" in p for p in found)
    if name in ("p10_range", "p18_period_scope", "p19_scope_period", "b7_top5", "b10_unit_balance", "t6_top_magnitude"):
        assert all("LessThan(l_shipdate" in p for p in found)


@data
def test_the_period_reaches_the_scans_behind_staged_frames(spark):
    """What b11 to b13, the facts and their bridge write on the way."""
    t = Tables(spark, FOLDER)
    for period, both in ((Period.years(2000), True), (Period.years(*range(1995, 2001)), True), (PERIOD, True), (PERIOD.until(), False)):
        text = plan(r.supplier_fact(t, period)) + plan(r.customer_lines(t, period)) + plan(r.transfers(t, period)) + plan(r.group_history(t, period))
        assert text.count("LessThan(l_shipdate") == 2 and text.count("LessThan(o_orderdate") == 2
        assert ("GreaterThanOrEqual(l_shipdate" in text) == both
    sources = r.customer_sources(t, PERIOD)
    assert sources["contribuicao"].agg(F.min("mes_ref"), F.max("mes_ref")).first() == (dt.date(1996, 1, 1), dt.date(2001, 7, 1))


@pytest.fixture(scope="module")
def by_years(spark, tmp_path_factory):
    """A fact and a calendar as the builds store them."""
    store = TableStore(spark, prefix=f"y{uuid.uuid4().hex[:8]}_", root=str(tmp_path_factory.mktemp("by_year")))
    store.create_layers(["gold"])
    t = Tables(spark, FOLDER)
    flow = store.publish(by_year(r.supplier_fact(t)), "gold", "flow_fact", partition_by=[YEAR])
    stock = store.publish(by_year(r.stock_rows(t)), "gold", "stock_fact", partition_by=[YEAR])
    calendar = store.publish(r.calendar(t), "gold", "dim_calendar")
    yield t, flow, stock, calendar
    spark.sql(f"DROP SCHEMA `{store.prefix}gold` CASCADE")


def _pruning(df):
    return re.findall(r"PartitionFilters: \[([^\]]*)", plan(df))


@data
def test_questions_prune_the_partitions_of_stored_facts(spark, by_years):
    t, flow, stock, calendar = by_years
    names, year = r.names(t), Period.years(2000)
    newest = an.labelled_flows(flow, calendar, r.GENERIC, year)
    asked = {
        "b2": an.ytd_flow(flow, calendar, 1999, r.MILLIONS),
        "b3": an.monthly_flow(flow, "1998-01-01", 3, r.MILLIONS),
        "b7": an.top_units(an.unit_contributions(flow, calendar, r.GENERIC, Period.years(1995, 2000)), names, [1995, 2000], 5, r.MILLIONS),
        "b10": an.unit_balance(newest, names, "2000", r.MILLIONS),
    }
    for name, df in asked.items():
        assert any(f"{YEAR}#" in p and ("<=" in p or ">=" in p) for p in _pruning(df)), name
    # the others ask for full years, which the calendar knows
    calendar_led = {
        "b1": an.annual_flow(flow, calendar, r.MILLIONS),
        "b4": an.redemption_rate(flow, stock, calendar, 1998, r.MILLIONS),
        "b5": an.unit_contributions(flow, calendar, r.GENERIC),
        "b6": an.contribution_concentration(an.unit_contributions(flow, calendar, r.GENERIC)),
    }
    for name, df in calendar_led.items():
        facts = [p for p in _pruning(df) if YEAR in p]
        assert len(facts) >= (2 if name == "b4" else 1) and all(" IN (" in p for p in facts), name
        assert not any("2001" in p for p in facts) or name == "b4"
    # b11 to b13 stage what they read of the fact
    assert any(f"{YEAR}#" in p for p in _pruning(newest))


@data
def test_stored_and_raw_facts_answer_alike(spark, by_years):
    t, flow, stock, calendar = by_years

    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(an.annual_flow(flow, calendar, r.MILLIONS, 6)) == rows(QUERIES["b1_annual_flow"](spark, FOLDER))
    rate = an.redemption_rate(flow, stock, calendar, 1998, r.MILLIONS, 6).withColumn("pmbac_media_mi", F.round("pmbac_media_mi", 6))
    assert rows(rate) == rows(QUERIES["b4_flow_stock_rate"](spark, FOLDER))
    shown = an.labelled_flows(flow, calendar, r.GENERIC, Period.years(*range(1995, 2001)))
    b11 = an.leaders_history(shown, r.names(t), ("1998", "2000"), ("1995", "2000"), 8, r.MILLIONS)
    assert rows(b11) == rows(QUERIES["b11_top8_history"](spark, FOLDER))


def test_on_calendar_joins_a_plain_fact_on_its_month(spark):
    fact = spark.createDataFrame([(dt.date(2020, 1, 1), 1)], "mes_ref date, v int")
    months = spark.createDataFrame([(dt.date(2020, 1, 1), 2020)], "mes_ref date, ano int")
    assert on_calendar(fact, months).columns == ["mes_ref", "v", "ano"] and on_calendar(by_year(fact), months).count() == 1
