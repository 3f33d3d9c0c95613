"""Column functions on literal values, NULLs and blanks included."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    band,
    count_where,
    decode_cp1252,
    has_padding,
    has_replacement_char,
    in_domain,
    in_period,
    is_blank,
    matches,
    not_numeric,
    outside_domain,
    parse_decimal,
    parse_integer,
    parse_month,
    percent_where,
    ratio,
    ratio_of_sums,
    recode,
    row_hash,
    sum_where,
    unit_code,
    zero_fill,
)


def values(rows, texts, column, schema="x string"):
    return [r[0] for r in rows([(t,) for t in texts], schema).select(column).collect()]


def test_parse_decimal(rows):
    texts = ["31557844,9700002", " 350407,58 ", "1.234,56", "", None, "abc", "1e3", "-0,005", "7"]
    found = values(rows, texts, parse_decimal("x"))
    expected = ["31557844.97", "350407.58", None, None, None, None, "1000.00", "-0.01", "7.00"]
    assert found == [None if e is None else Decimal(e) for e in expected]
    assert values(rows, ["1.50"], parse_decimal("x", 10, 1, decimal_sep=".")) == [Decimal("1.5")]


def test_parse_month(rows):
    texts = [" 201401  ", "201313", "201300", "189912", "209912", "", None, "2014", "20140101"]
    found = values(rows, texts, parse_month("x"))
    assert found == [dt.date(2014, 1, 1), None, None, None, dt.date(2099, 12, 1), None, None, None, None]


def test_parse_integer(rows):
    assert values(rows, [" 42 ", "4,2", "", None, "x"], parse_integer("x")) == [42, None, None, None, None]


def test_predicates_are_never_null(rows):
    texts = ["A", "", " ", None, "A ", "x�"]
    df = rows([(t,) for t in texts], "x string")
    checks = {
        "blank": is_blank("x"),
        "inside": in_domain("x", ["A"]),
        "outside": outside_domain("x", ["A"]),
        "fits": matches("x", "^A$"),
        "padded": has_padding("x"),
        "bad": has_replacement_char("x"),
    }
    found = df.select(*[c.alias(n) for n, c in checks.items()]).collect()
    assert [r["blank"] for r in found] == [False, True, True, True, False, False]
    assert [r["inside"] for r in found] == [True, False, False, False, False, False]
    assert all(r["inside"] != r["outside"] for r in found)
    assert [r["padded"] for r in found] == [False, False, True, False, True, False]
    assert [r["bad"] for r in found] == [False] * 5 + [True]
    assert all(v is not None for r in found for v in r)


def test_in_period_includes_both_ends(rows):
    days = [dt.date(2013, 12, 31), dt.date(2014, 1, 1), dt.date(2014, 2, 1), dt.date(2014, 2, 2), None]
    assert values(rows, days, in_period("x", "2014-01-01", "2014-02-01"), "x date") == [False, True, True, False, False]


def test_not_numeric(rows):
    assert values(rows, ["1,5", "abc", "1.234,56", "", None], not_numeric("x")) == [False, True, True, False, False]


def test_recode_keeps_case_and_unknown_null(rows):
    assert values(rows, ["R", "D", "r", None], recode("x", {"R": "IN", "D": "OUT"})) == ["IN", "OUT", None, None]


def test_band_edges_are_included(rows):
    found = values(rows, [0.0, 0.001, 0.0011, 0.05, 0.051, None], band("x", [0.001, 0.05], ["a", "b", "c"]), "x double")
    assert found == ["a", "a", "b", "b", "c", None]
    with pytest.raises(ValueError):
        band("x", [1], ["only"])


def test_unit_code(rows):
    df = rows([("10", "E1"), ("99999", "E2"), (None, "E3")], "g string, e string")
    assert [r[0] for r in df.select(unit_code("g", "e", ["99999"])).collect()] == ["10", "EMP_E2", None]


def test_row_hash_modes(rows):
    df = rows([("x|", "y"), ("x", "|y"), (None, "a"), ("", "a")], "a string, b string")
    joined = [r[0] for r in df.select(row_hash(["a", "b"])).collect()]
    strict = [r[0] for r in df.select(row_hash(["a", "b"], "json")).collect()]
    assert joined[0] == joined[1] and joined[2] == joined[3]
    assert len(set(strict)) == 4
    with pytest.raises(ValueError):
        row_hash(["a"], "md5")


def test_decode_cp1252_covers_every_defined_byte(rows):
    defined = []
    for b in range(256):
        try:
            defined.append((bytes([b]).decode("latin-1"), bytes([b]).decode("windows-1252")))
        except UnicodeDecodeError:
            continue
    found = values(rows, [a for a, _ in defined], decode_cp1252("x"))
    assert found == [b for _, b in defined]


def test_aggregates(rows):
    df = rows([(1, Decimal("2.00"), True), (2, Decimal("3.00"), False), (3, None, None)], "k int, v decimal(20,2), f boolean")
    r = df.agg(
        count_where(F.col("f")).alias("n"),
        sum_where("v", F.col("f")).alias("s"),
        percent_where(F.col("f")).alias("p"),
        ratio_of_sums("v", "k").alias("q"),
        F.sum(zero_fill("v")).alias("z"),
    ).first()
    assert (r["n"], r["s"], r["p"], r["z"]) == (1, Decimal("2.00"), 50.0, Decimal("5.00"))
    assert r["q"] == pytest.approx(5 / 6)
    empty = df.filter("k > 9").agg(count_where(F.col("f")).alias("n"), ratio_of_sums("v", "k").alias("q")).first()
    assert (empty["n"], empty["q"]) == (0, None)
    assert df.select(ratio(F.col("v"), F.lit(0))).first()[0] is None
