"""Composed operators on small literal tables: NULLs, ties, negatives, empty inputs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import is_blank, parse_decimal
from tidemark.operators.catalog import data_catalog, profile_columns, undocumented
from tidemark.operators.cleanse import (
    canonical_names,
    domain_difference,
    name_variants,
    quarantine,
    scope_filter,
    split_rejects,
    standardize,
    tag_rejects,
    undocumented_columns,
    union_all,
)
from tidemark.operators.combine import (
    conservation,
    coverage_gap,
    orphan_keys,
    orphan_rows,
    percent_reconciled,
    reconcile,
    reconcile_summary,
    spine_join,
)
from tidemark.operators.dedup import (
    DuplicateKey,
    ValueLost,
    collapse_duplicates,
    consolidate_subrows,
    dedup_conserving,
    dedup_report,
    duplicate_keys,
    first_grain_break,
    grain_profile,
    pivot_sum,
    require_unique,
)
from tidemark.operators.metrics import (
    concentration,
    continuity_test,
    flow_to_stock_rate,
    group_changes,
    hhi,
    implausible_average,
    outliers,
    share_of_total,
    symmetry_test,
    topk_share,
    worst_asymmetry,
)
from tidemark.operators.quality import DQSuite, QualityFailure, Rule, at_least, at_most, below, count_rule, info, zero
from tidemark.operators.ranking import (
    global_ranks,
    rank_shift,
    rank_shift_summary,
    topk_by_magnitude,
    topk_entities_history,
    topk_per_group,
)
from tidemark.operators.star import dim_calendar, dim_latest, economic_unit, flow_fact, primary_key_report, stock_fact, unit_names
from tidemark.operators.temporal import (
    asof_join,
    attribution_summary,
    fill_months,
    latest_per_key,
    moving_mean,
    pct_change,
    temporal_bridge,
    trailing_mean,
)


def d(y, m):
    return dt.date(y, m, 1)


def dec(x):
    return None if x is None else Decimal(x)


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# --- cleansing --------------------------------------------------------------------------------


def test_names(rows):
    a, b = rows([("1", "2")], "COENTI string, v string"), rows([("1",)], "Coenti string")
    standard = {"coenti": "cod"}
    assert canonical_names(a, standard).columns == ["cod", "v"]
    assert name_variants({"a": a, "b": b}, standard) == [("a", "COENTI", "cod"), ("b", "Coenti", "cod")]
    assert table(standardize(rows([(" x ",)], "a string"), {"b": "a"})) == [("x",)]
    assert standardize(rows([(" x ",)], "a string"), {"b": "a"}, trim=False).first()["b"] == " x "


def test_undocumented_columns(rows):
    df = rows([("1", " ", "a"), ("2", "x", None)], "K string, extra string, other string")
    assert table(undocumented_columns(df, ["k"])) == [("extra", 1), ("other", 1)]
    assert undocumented_columns(df, ["k", "EXTRA", "other"]).count() == 0


def test_quarantine_splits_without_loss(rows):
    df = rows([("a", 1), (None, 2), ("z", None)], "code string, n int")
    good, bad = quarantine(df, F.col("code") == "z", "t", "bad code")
    assert table(good) == [("a", 1), (None, 2)]  # a NULL condition rejects nothing
    assert table(bad) == [("t", "bad code", '{"code":"z","n":null}')]
    good, bad = split_rejects(df, [(F.col("code").isNull(), "null"), (F.col("n").isNull() | F.col("code").isNull(), "no n")], "t")
    assert good.count() + bad.count() == df.count()
    assert {r["motivo"] for r in bad.collect()} == {"null", "no n"}
    assert tag_rejects(df, [(F.lit(True), "first"), (F.lit(True), "second")]).select("__motivo").distinct().collect()[0][0] == "first"


def test_union_all(spark, rows):
    parts = [rows([(i,)], "a int") for i in range(5)]
    assert table(union_all(parts)) == [(i,) for i in range(5)]
    assert union_all([], spark).columns == ["tabela_origem", "motivo", "registro_json"]
    with pytest.raises(ValueError):
        union_all([])


def test_scope_filter_counts_what_it_cuts(rows):
    df = rows([("A", dec("10")), ("B", dec("4")), (None, dec("6")), ("", None)], "code string, v decimal(20,2)")
    kept, report = scope_filter(df, "code", ["A"], "v")
    r = report.first()
    assert table(kept, "code") == [("A",)]
    assert (r["linhas_no_escopo"], r["linhas_fora"], r["linhas_sem_codigo"]) == (1, 3, 2)
    assert (r["valor_fora"], r["valor_sem_codigo"], r["pct_valor_no_escopo"]) == (dec("10"), dec("6"), 50.0)
    nothing = scope_filter(df.limit(0), "code", ["A"], "v")[1].first()
    assert (nothing["valor_no_escopo"], nothing["pct_valor_no_escopo"]) == (0, None)


def test_domain_difference_lists_null(rows):
    assert table(domain_difference(rows([("A",), ("x",), (None,), (None,)], "c string"), "c", ["A"])) == [("x", 1), (None, 2)]


# --- duplicates -------------------------------------------------------------------------------


def test_dedup_conserving(rows):
    df = rows([("k", "0")] * 3 + [("k", "5,00"), ("j", "0"), (None, None), (None, None)], "k string, v string")
    collapsed = collapse_duplicates(df)
    r = dedup_report(collapsed, parse_decimal("v")).first()
    assert (r["linhas_antes"], r["linhas_depois"], r["linhas_removidas"], r["soma_removida"]) == (7, 4, 3, 0)
    assert dedup_conserving(collapsed, parse_decimal("v")).count() == 4
    worth = collapse_duplicates(rows([("k", "5")] * 2 + [("j", "-5")] * 2, "k string, v string"))
    assert dedup_report(worth, parse_decimal("v")).first()["modulo_removido"] == 10
    with pytest.raises(ValueLost):
        dedup_conserving(collapse_duplicates(rows([("k", "5")] * 2, "k string, v string")), parse_decimal("v"))
    assert dedup_report(collapse_duplicates(df.limit(0)), parse_decimal("v")).first()["soma_removida"] == 0


def test_consolidate_subrows(rows):
    df = rows([("a", dec("1")), ("a", None), ("a", dec("2")), ("b", None)], "k string, v decimal(20,2)")
    out = consolidate_subrows(df, ["k"], {"total": "v"}, "n")
    assert table(out) == [("a", dec("3.00"), 3), ("b", None, 1)]
    assert dict(out.dtypes)["total"] == "decimal(20,2)"


def test_pivot_sum(rows):
    df = rows([("k", "IN", dec("5"), None), ("k", "OUT", dec("2"), True), ("j", "IN", dec("1"), False)], "k string, c string, v decimal(20,2), f boolean")
    out = pivot_sum(df, ["k"], "c", "v", {"IN": "i", "OUT": "o"}, ["f"])
    assert table(out) == [("j", dec("1.00"), dec("0.00"), False), ("k", dec("5.00"), dec("2.00"), True)]


def test_grain(rows):
    df = rows([("a", "201401"), ("a", "201401"), ("b", "201401"), ("a", "201301")], "k string, m string")
    assert duplicate_keys(df, ["k", "m"]).first()[0] == 1
    assert duplicate_keys(df.limit(0), ["k"]).first()[0] == 0
    assert first_grain_break(df, ["k", "m"], "m").first()[0] == "201401"
    assert first_grain_break(df.distinct(), ["k", "m"], "m").first()[0] is None
    assert table(grain_profile(df, ["k", "m"], {"y": F.substring("m", 1, 4)})) == [("2013", 1.0, 1), ("2014", 1.5, 2)]
    with pytest.raises(DuplicateKey):
        require_unique(df, ["k", "m"], "t")
    require_unique(df.distinct(), ["k", "m"], "t")


# --- joins ------------------------------------------------------------------------------------


def test_spine_join_equals_left_joins(rows):
    a = rows([(1, dec("5"), True), (2, dec("7"), None)], "k int, a decimal(20,2), fa boolean")
    b = rows([(2, dec("1")), (3, None)], "k int, b decimal(20,2)")
    out = spine_join({"a": (a, ["a", "fa"]), "b": (b, ["b"])}, ["k"])
    assert table(out, "k", "a", "fa", "b", "fl_tem_a", "fl_tem_b") == [
        (1, dec("5.00"), True, dec("0.00"), True, False),
        (2, dec("7.00"), False, dec("1.00"), True, True),
        (3, dec("0.00"), False, dec("0.00"), False, True),
    ]
    assert dict(out.dtypes)["a"] == "decimal(20,2)"
    with pytest.raises(ValueError):
        spine_join({"a": (a, ["a"]), "c": (a, ["a"])}, ["k"])


def test_reconcile_bands(rows):
    a = rows([(1, dec("1000")), (2, dec("1000")), (3, dec("1000")), (4, dec("1000")), (5, dec("1000")), (6, dec("9")), (8, dec("0"))], "k int, v decimal(20,2)")
    b = rows([(1, dec("999")), (2, dec("990")), (3, dec("950")), (4, dec("949")), (5, dec("1000")), (7, dec("3")), (8, dec("40"))], "k int, v decimal(20,2)")
    out = reconcile(a, b, ["k"], "v")
    found = {r["k"]: r for r in out.collect()}
    classes = {k: r["classe_conciliacao"] for k, r in found.items()}
    assert classes == {1: "ATE_0,1%", 2: "ATE_1%", 3: "ATE_5%", 4: "ACIMA_5%", 5: "ATE_0,1%", 6: "SO_FONTE_A", 7: "SO_FONTE_B", 8: "ACIMA_5%"}
    assert found[8]["pc_diferenca"] == 40 and found[6]["vl_diferenca"] == 9 and found[7]["vl_diferenca"] == -3
    summary = {r["classe_conciliacao"]: (r["linhas"], r["pct"]) for r in reconcile_summary(out).collect()}
    assert summary["ATE_0,1%"] == (2, 25.0) and sum(n for n, _ in summary.values()) == 8
    graded = percent_reconciled(out.withColumn("g", F.lit("x")), ["g"], at_least=30).first()
    assert (graded["pct_conciliado"], graded["status"]) == (37.5, "OK")


def test_orphans_and_coverage(rows):
    fact = rows([(1, dec("5")), (1, dec("6")), (2, dec("7")), (None, dec("1"))], "k int, v decimal(20,2)")
    dim = rows([(2,)], "k int")
    assert table(orphan_keys(fact, dim, "k")) == [(1,), (None,)]
    assert orphan_rows(fact, dim, "k").first()[0] == 3
    assert orphan_rows(dim, dim, "k").first()[0] == 0
    assert tuple(coverage_gap(fact.filter("k IS NOT NULL"), dim, ["k"], "v").first()) == (2, dec("11"))


def test_conservation(rows):
    before, after = rows([(dec("5"),), (dec("6"),)], "a decimal(20,2)"), rows([(dec("11"), dec("1"))], "x decimal(20,2), y decimal(20,2)")
    found = {r["metrica"]: r for r in conservation(before, after, {"x": "a", "y": "a"}).collect()}
    assert (found["x"]["status"], found["y"]["status"], found["y"]["diferenca"]) == ("OK", "FALHA", dec("-10"))


# --- time -------------------------------------------------------------------------------------


def test_asof_labels_and_lags(rows):
    left = rows([("a", d(2014, 1), 1), ("a", d(2014, 3), 2), ("a", d(2013, 1), 3), ("b", d(2014, 1), 4), (None, d(2014, 1), 5), ("a", None, 6)], "e string, t date, n int")
    hist = rows([("a", d(2013, 12), "g1"), ("a", d(2014, 3), "g2"), (None, d(2010, 1), "g3"), ("a", None, "g4")], "e string, h date, g string")
    for bucket in (None, "year", "month"):
        out = asof_join(left, hist, ["e"], "t", "h", ["g"], bucket=bucket)
        found = {r["n"]: (r["g"], r["tipo_atribuicao"], r["meses_defasagem"]) for r in out.collect()}
        none = ("NAO_INFORMADO", "NAO_INFORMADO", None)
        assert found == {1: ("g1", "HERDADA", 1), 2: ("g2", "EXATA", 0), 3: none, 4: none, 5: none, 6: none}, bucket
        assert out.columns == ["e", "t", "n", "g", "tipo_atribuicao", "meses_defasagem"]


def test_temporal_bridge(rows):
    flows = [rows([("a", d(2014, 1)), ("a", d(2014, 1))], "e string, m date"), rows([("a", d(2014, 2)), ("b", d(2010, 1))], "e string, m date")]
    hist = rows([("a", d(2014, 1), "g")], "e string, m date, g string")
    bridge = temporal_bridge(flows, hist, "e", "m", "g", F.col("m") >= "2014-01-01")
    assert table(bridge, "e", "m", "g", "tipo_atribuicao") == [("a", d(2014, 1), "g", "EXATA"), ("a", d(2014, 2), "g", "HERDADA")]
    assert table(attribution_summary(bridge)) == [("EXATA", 1, 0), ("HERDADA", 1, 1)]


def test_latest_per_key_breaks_ties(rows):
    df = rows([("g", "old", 1, "x"), ("g", "new", 2, "a"), ("g", "tie", 2, "b"), ("h", None, None, "z")], "k string, name string, t int, e string")
    assert table(latest_per_key(df, ["k"], "t", ["e"]), "k", "name") == [("g", "tie"), ("h", None)]


def test_row_frames(rows):
    df = rows([("a", i, dec(v)) for i, v in enumerate([2, 4, 6, 0, 10])], "k string, t int, v decimal(20,2)")
    changes = [r["var_pct"] for r in pct_change(df, ["k"], "t", "v").orderBy("t").collect()]
    assert changes == [None, 1.0, 0.5, -1.0, None]
    assert [r["media_anterior"] for r in trailing_mean(df, ["k"], "t", "v", 2).orderBy("t").collect()] == [None, 2.0, 3.0, 5.0, 3.0]
    assert [r["media_movel"] for r in moving_mean(df, ["k"], "t", "v", 3).orderBy("t").collect()][:3] == [2.0, 3.0, 4.0]


def test_fill_months(rows):
    df = rows([("a", d(2014, 1), 1), ("a", d(2014, 4), 2), ("b", d(2014, 2), 3)], "k string, m date, v int")
    assert table(fill_months(df, ["k"], "m"), "k", "m", "v") == table(rows([("a", d(2014, 1), 1), ("a", d(2014, 2), None), ("a", d(2014, 3), None), ("a", d(2014, 4), 2), ("b", d(2014, 2), 3)], "k string, m date, v int"))


def test_continuity(rows):
    series = [100, 110, 121, 133, 500]
    df = rows([("p", d(2014, i + 1), dec(v)) for i, v in enumerate(series)], "p string, m date, v decimal(20,2)")
    assert continuity_test(df, ["p"], "m", "v", "2014-03-01", "2014-01-01", "2014-04-01").first()["status"] == "OK"
    assert continuity_test(df, ["p"], "m", "v", "2014-05-01", "2014-01-01", "2014-04-01").first()["status"] == "ALERTA"


def test_outliers_need_a_past(rows):
    df = rows([("a", i, dec(v)) for i, v in enumerate([1000, 10, 10, 2000, 60])], "k string, t int, v decimal(20,2)")
    assert table(outliers(df, ["k"], "t", "v", 12, 5, 100), "t") == [(3,)]


# --- metrics ----------------------------------------------------------------------------------


def test_concentration(rows):
    df = rows([("y", "a", dec(50)), ("y", "b", dec(30)), ("y", "c", dec(20)), ("y", "neg", dec(-40)), ("y", "zero", dec(0)), ("z", "a", dec(7))], "y string, e string, v decimal(20,2)")
    r = {x["y"]: x for x in concentration(df, ["y"], "e", "v", 2, "top").collect()}
    assert (r["y"]["n_unidades"], r["y"]["top"], r["y"]["hhi"]) == (3, 80.0, pytest.approx(3800))
    assert (r["z"]["n_unidades"], r["z"]["top"], r["z"]["hhi"]) == (1, 100.0, 10000.0)
    assert {x["y"]: x["hhi"] for x in hhi(df, ["y"], "v").collect()}["z"] == 10000.0
    assert {x["y"]: x["participacao_top"] for x in topk_share(df, ["y"], "e", "v", 2).collect()} == {"y": 0.8, "z": 1.0}
    assert {x["e"]: x["participacao"] for x in share_of_total(df.filter("y = 'y'"), ["y"], "v").collect()} == {"a": 0.5, "b": 0.3, "c": 0.2}


def test_flow_to_stock_rate_averages_stock(rows):
    flow = rows([(1, "p", d(2014, 1), dec(5)), (1, "p", d(2014, 1), dec(5)), (1, "p", d(2014, 2), dec(10)), (1, "p", d(2014, 3), dec(99))], "y int, p string, m date, f decimal(20,2)")
    stock = rows([("p", d(2014, 1), dec(60)), ("p", d(2014, 1), dec(40)), ("p", d(2014, 2), dec(300))], "p string, m date, s decimal(20,2)")
    r = flow_to_stock_rate(flow, stock, ["p"], "y", "m", "f", "s").first()
    assert (r["fluxo"], r["estoque_medio"], r["taxa_pct"]) == (dec(20), 200.0, 10.0)


def test_symmetry(rows):
    df = rows([(2014, dec(110), dec(100)), (2015, dec(80), dec(100)), (2016, dec(1), dec(0))], "y int, i decimal(20,2), o decimal(20,2)")
    out = symmetry_test(df, F.col("y"), "i", "o")
    assert {r["ano"]: r["dif_pct"] for r in out.collect()} == {2014: 10.0, 2015: -20.0, 2016: None}
    worst = worst_asymmetry(out, F.col("ano") < 2016).first()
    assert (worst["maior_dif_pct"], worst["status"]) == (20.0, "ALERTA")


def test_implausible_average(rows):
    df = rows([(1000, dec(1)), (0, dec(1)), (None, dec(1)), (1, dec(500)), (3, None)], "q bigint, v decimal(20,2)")
    assert [r[0] for r in df.select(implausible_average(F.col("q"), F.col("v"), 100)).collect()] == [True, False, None, False, None]


def test_group_changes(rows):
    df = rows([("a", "1"), ("a", "2"), ("a", "1"), ("b", "1")], "e string, g string")
    assert [(r["e"], r["n_grupos"], r["grupos"]) for r in group_changes(df, "e", "g").collect()] == [("a", 2, ["1", "2"])]


# --- ranking ----------------------------------------------------------------------------------


def test_topk_ties_and_history(rows):
    df = rows([("g", "b", 5), ("g", "a", 5), ("g", "c", 4), ("h", "a", None)], "g string, e string, v int")
    assert table(topk_per_group(df, ["g"], "v", 2, ["e"]), "g", "e", "pos") == [("g", "a", 1), ("g", "b", 2), ("h", "a", 1)]
    yearly = rows([("a", 1, 5), ("b", 1, 9), ("c", 1, 5), ("c", 2, 100), ("a", 2, 1)], "e string, y int, v int")
    assert table(topk_entities_history(yearly, "e", F.col("v"), 2, F.col("y") == 1)) == [("a", 1, 5), ("a", 2, 1), ("b", 1, 9)]
    signed = rows([("a", 5), ("b", -7), ("c", 1)], "e string, v int")
    assert [r["e"] for r in topk_by_magnitude(signed, "v", 2, ["e"]).collect()] == ["b", "a"]


def test_rank_shift(rows):
    data = [("a", dec(10), dec(-5)), ("b", dec(10), dec(20)), ("c", dec(0), dec(7)), ("d", dec(-3), dec(-3))]
    out = rank_shift(rows(data, "e string, x decimal(20,2), y decimal(20,2)"), ["e"], "x", "y")
    found = {r["e"]: (r["posicao_a"], r["posicao_b"], r["variacao_posicao"], r["muda_de_sinal"]) for r in out.collect()}
    assert found == {"a": (1, 4, -3, True), "b": (1, 1, 0, False), "c": (3, 2, 1, False), "d": (4, 3, 1, False)}
    assert tuple(rank_shift_summary(out).first()) == (4, 3, 1)


def test_global_ranks_leave_null_unranked(rows):
    out = global_ranks(rows([(1, 5.0), (2, None), (3, 5.0), (4, -1.0)], "k int, v double"), ["k"], ["v"], ["r"])
    assert {r["k"]: (r["v"], r["r"]) for r in out.collect()} == {1: (5.0, 1), 2: (None, None), 3: (5.0, 1), 4: (-1.0, 3)}


# --- quality ----------------------------------------------------------------------------------


def test_suite(spark, rows):
    df = rows([("a", 1), ("a", 2), (None, 3)], "k string, n int")
    suite = DQSuite(spark, "SILVER").row(
        "t",
        df,
        count_rule("Completude", "k filled", "blank", is_blank("k"), zero("ALERTA")),
        Rule("Validade", "sum", "sum", F.sum("n"), at_most(5), "<=5"),
        Rule("Validade", "sum2", "sum", F.sum("n"), at_least(6), ">=6"),
        Rule("Escopo", "max", "max", F.max("n"), info(), "-", shown=F.concat(F.lit("max "), F.max("n").cast("string"))),
        Rule("Escopo", "small", "max", F.max("n"), below(3), "<3"),
    )
    suite.key("t", df, ["k"]).foreign_key("t", df, rows([("a",)], "k string"), "k", "dim")
    suite.orphan_entities("t", df, rows([("z",)], "k string"), "k", "dim2", zero("ALERTA"))
    found = {r["regra"]: (r["valor"], r["valor_num"], r["status"]) for r in suite.results().collect()}
    assert found == {
        "k filled": ("1", 1.0, "ALERTA"),
        "sum": ("6", 6.0, "FALHA"),
        "sum2": ("6", 6.0, "OK"),
        "max": ("max 3", 3.0, "INFO"),
        "small": ("3", 3.0, "ALERTA"),
        "uma linha por k": ("1", 1.0, "FALHA"),
        "k consta em dim": ("1", 1.0, "FALHA"),
        "k consta em dim2": ("2", 2.0, "ALERTA"),
    }
    with pytest.raises(QualityFailure, match="sum = 6"):
        DQSuite.enforce(suite.results())
    assert suite.results().columns == ["camada", "tabela", "dimensao", "regra", "metrica", "valor", "valor_num", "esperado", "status", "acao", "evidencia", "ts_execucao"]
    assert DQSuite(spark, "GOLD").results().count() == 0


def test_row_rules_of_a_table_share_one_scan(spark, rows):
    df = rows([("a", 1)], "k string, n int")
    rules = [count_rule("V", f"r{i}", "m", F.col("n") == i, zero()) for i in range(10)]
    plan = DQSuite(spark, "S").row("t", df, *rules).results()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


# --- star and catalogue -----------------------------------------------------------------------


def test_dim_calendar(spark):
    cal = dim_calendar(spark, "2014-01-01", "2026-07-01", 2025, 7)
    assert cal.count() == 151
    r = cal.filter("ano_mes = '202608' OR ano_mes = '201408'").collect()
    assert [(x["mes"], x["trimestre"], x["fl_ano_completo"], x["fl_periodo_ytd"]) for x in r] == [(8, 3, True, False)]


def test_dim_latest_and_units(rows):
    hist = rows([("1", "old", d(2014, 1), "e"), ("1", "new", d(2014, 2), "e"), ("9", "other", d(2014, 1), "e")], "g string, n string, m date, e string")
    dim = dim_latest(hist, "g", ["n"], "m", ["e"], {"g": "NI", "n": "unknown"})
    assert table(dim) == [("1", "new"), ("9", "other"), ("NI", "unknown")]
    assert dim_latest(hist, "g", ["n"], "m", ["e"]).count() == 2
    own = rows([("E1", "same"), ("E2", "same")], "e string, en string")
    names = unit_names(dim, own, ("g", "n"), ("e", "en"), ["9", "NI"])
    assert table(names) == [("1", "new"), ("EMP_E1", "same (sem grupo)"), ("EMP_E2", "same (sem grupo)")]
    units = economic_unit(rows([("9", "E1"), ("9", "E2"), ("1", "E3")], "g string, e string"), "g", "e", ["9", "NI"])
    assert {r["unidade"] for r in units.collect()} == {"EMP_E1", "EMP_E2", "1"}


def test_facts(rows):
    a = rows([("e", d(2014, 1), dec(5)), ("e", d(2013, 1), dec(9))], "e string, m date, a decimal(20,2)")
    b = rows([("e", d(2014, 2), dec(2))], "e string, m date, b decimal(20,2)")
    bridge = rows([("e", d(2014, 1), "g1"), ("e", d(2014, 2), "g2")], "e string, m date, g string")
    period = F.col("m") >= "2014-01-01"
    fact = flow_fact({"a": (a, ["a"]), "b": (b, ["b"])}, ["e", "m"], bridge, ["e", "m"], {"net": F.col("a") - F.col("b")}, period)
    assert table(fact, "m", "g", "net", "fl_tem_a") == [(d(2014, 1), "g1", dec("5.00"), True), (d(2014, 2), "g2", dec("-2.00"), False)]
    assert dict(fact.dtypes)["net"] == "decimal(20,2)"
    assert table(stock_fact(a, bridge, ["e", "m"], ["m", "g", "a"], period)) == [(d(2014, 1), "g1", dec("5.00"))]
    assert table(primary_key_report({"x": (fact, ["m"]), "y": (a, ["e"])})) == [("x", 0), ("y", 1)]


def test_profile_and_catalog(rows):
    data = [(i, f"v{i:02d}", "x" if i % 2 else None, d(2014, 1), True, "{}") for i in range(20)]
    df = rows(data, "n int, wide string, narrow string, day date, flag boolean, registro_json string")
    profile = {r["coluna"]: r for r in profile_columns(df, skip=["registro_json"]).collect()}
    assert (profile["n"]["minimo"], profile["n"]["maximo"], profile["n"]["pct_nulos"]) == ("0", "19", 0.0)
    assert (profile["wide"]["n_distintos"], len(profile["wide"]["valores"])) == (20, 12)
    assert profile["narrow"]["pct_nulos"] == 50.0
    cat = data_catalog({"silver.t": df}, {"silver.t": ("about", "from")}, {"n": "A number."})
    found = {r["coluna"]: r for r in cat.collect()}
    assert found["n"]["dominio_observado"] == "[0 ; 19]" and found["day"]["dominio_observado"] == "[2014-01-01 ; 2014-01-01]"
    assert found["wide"]["dominio_observado"] == "20 valores distintos (ex.: v00, v01, v02 ...)"
    assert found["narrow"]["dominio_observado"] == "{x}" and found["flag"]["dominio_observado"] == "{true}"
    assert (found["registro_json"]["dominio_observado"], found["registro_json"]["pct_nulos"]) == ("JSON", None)
    assert (found["n"]["camada"], found["n"]["descricao_tabela"], found["n"]["linhagem"], found["n"]["tipo"]) == ("SILVER", "about", "from", "int")
    assert undocumented(cat).count() == 5
    assert profile_columns(df.select("n")).first()["valores"] == []


# --- one-pass tests ---------------------------------------------------------------------------


def test_table_audit_counts_key_references_and_totals(rows):
    from tidemark.operators.star import orphan_report, table_audit

    fact = rows([(1, "x", 10.0), (1, "x", 5.0), (2, "y", 1.0), (3, None, 2.0)], "k int, d string, v double").withColumn("v", F.col("v").cast("decimal(20,2)"))
    known = rows([("x",), ("z",)], "d string")
    got = table_audit(fact, ["k"], {"d": (known, "d")}, ["v"]).first().asDict()
    assert {k: float(v) for k, v in got.items()} == {"duplicadas": 1, "orfaos_d": 2, "total_v": 18}
    # a reference that is also the key, a key of two columns, and no rows
    assert table_audit(fact, ["d"], {"d": (known, "d")}).first() == (1, 2)
    assert table_audit(fact, ["k", "d"], {"k": (rows([(1,), (2,)], "i int"), "i"), "d": (known, "d")}).first() == (1, 1, 2)
    assert [float(v) for v in table_audit(fact.limit(0), ["k"], {"d": (known, "d")}, ["v"]).first()] == [0, 0, 0]
    report = orphan_report(fact, {"f.d": ("d", known, "d"), "f.k": ("k", rows([(9,)], "n int"), "n")}).collect()
    assert {r["referencia"]: r["orfaos"] for r in report} == {"f.d": 2, "f.k": 4}
    assert {r["orfaos"] for r in orphan_report(fact.limit(0), {"f.d": ("d", known, "d")}).collect()} == {0}


def test_suite_reads_a_relation_once_and_keeps_what_is_known(spark, rows):
    from tidemark.operators.quality import DQSuite, Rule, domain_rule, zero

    one = rows([(1, 0)], "a int, b int")
    suite = DQSuite(spark, "GOLD").relation("t", one, Rule("D", "a", "m", F.col("a"), zero())).relation("u", one, Rule("D", "b", "m", F.col("b"), zero()))
    suite.counted_key("t", ["k", "j"], 3)
    codes = rows([("a",), ("b",), ("b",), (None,), ("ok",)], "c string")
    bad = (F.col("c") != "ok") | F.col("c").isNull()
    suite.row("t", codes, domain_rule("D", "c", "m", "c", bad, zero(), k=2))
    found = {r["regra"]: r for r in suite.results().collect()}
    assert (found["a"]["status"], found["b"]["status"], found["b"]["tabela"]) == ("FALHA", "OK", "u")
    assert (found["uma linha por k, j"]["valor_num"], found["uma linha por k, j"]["status"]) == (3, "FALHA")
    assert (found["c"]["valor_num"], found["c"]["evidencia"]) == (4, "b: 2, NULL: 1")
    text = suite.results()._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LocalRelation") + text.count("LogicalRDD") <= 4


def test_first_values_are_bounded(rows):
    from tidemark.operators.ranking import first_values

    df = rows([("g", x) for x in "dacbca"] + [("h", None), ("h", "z"), ("i", None)], "k string, v string")
    assert {r["k"]: r["s"] for r in first_values(df, ["k"], "v", 3, "s").collect()} == {"g": ["a", "b", "c"], "h": ["z"]}
