"""Raw files to answers, checked against plain Python over the same numbers."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tests.raw_files import PRODUCTS, write_raw_files
from tidemark.operators.dedup import DuplicateKey, ValueLost
from tidemark.operators.quality import QualityFailure
from tidemark.plans.analyses import Money
from tidemark.plans.medallion import answers, build_bronze, build_catalog, build_gold, build_silver
from tidemark.plans.settings import RAW_COLUMNS, Settings
from tidemark.sources import TableStore


def settings(folder):
    return Settings(
        folder=folder,
        snapshot_date="2015-08-15",
        max_month="201507",
        start="2014-01-01",
        end="2015-07-01",
        last_full_year=2014,
        first_ytd_year=2014,
        monthly_from="2014-06-01",
        max_unknown_share_pct=25,
        grain_history=("2013-07-01", "2015-07-01"),
    )


def new_store(spark, folder):
    return TableStore(spark, prefix=f"t{uuid.uuid4().hex[:8]}_", root=str(folder))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("medallion")
    expected = write_raw_files(str(base / "raw"))
    store, s = new_store(spark, base / "tables"), settings(str(base / "raw"))
    loaded = {r["tabela"]: r for r in build_bronze(store, s).collect()}
    build_silver(store, s)
    build_gold(store, s)
    return store, s, expected, loaded


def in_period(month):
    return "201401" <= month <= "201507"


def status(store, layer="SILVER"):
    found = store.read("silver", "dq_results").filter(F.col("camada") == layer).collect()
    return {(r["tabela"], r["regra"]): r for r in found}


def test_every_file_is_loaded_in_full(built):
    _, _, _, loaded = built
    assert set(loaded) == set(RAW_COLUMNS)
    assert all(r["status"] == "OK" and r["linhas_na_tabela"] > 0 for r in loaded.values())


def test_bronze_keeps_text_and_provenance(built):
    store, *_ = built
    bronze = store.read("bronze", "companies")
    assert {t for c, t in bronze.dtypes if not c.startswith("_")} == {"string"}
    row = bronze.filter("Coenti LIKE '00003%'").first()
    assert row["Coenti"] == "00003   " and row["Noenti"] == "GAMA – “em aprovação”"
    assert row["_arquivo_origem"].endswith("Companies.csv") and len(row["_hash_linha"]) == 64


def test_silver_amounts(built):
    store, _, e, _ = built
    stored = {(r["cod_empresa"], r["ano_mes"], r["cod_produto"]): r for r in store.read("silver", "contributions").collect()}
    assert set(stored) == set(e.contributions)
    for key, v in e.contributions.items():
        if key != ("00005", "201312", "PGBL"):
            assert stored[key]["vl_contribuicao"] == v
    assert stored["00005", "201312", "PGBL"]["vl_contribuicao"] is None
    assert stored["00002", "201406", "VGBL"]["fl_contribuicao_negativa"]
    drawn = {(r["cod_empresa"], r["ano_mes"], r["cod_produto"]): r for r in store.read("silver", "redemptions").collect()}
    assert {k: r["vl_resgate"] for k, r in drawn.items()} == e.redemptions | {
        ("00001", m, p): e.redemptions["00001", m, p] for _, m, p in e.redemptions if ("00001", m, p) in e.redemptions
    }
    assert drawn["00002", "201312", "PGBL"]["qt_linhas_origem"] == 2
    assert drawn["00002", "201312", "PGBL"]["vl_resgate_pag_programado"] == 9


def test_quarantine_holds_what_cannot_be_read(built):
    store, *_ = built
    found = {}
    for r in store.read("silver", "quarantine").collect():
        found[r["tabela_origem"], r["motivo"]] = found.get((r["tabela_origem"], r["motivo"]), 0) + 1
    assert found == {
        ("group_history", "mês vazio ou inválido"): 2,
        ("group_history", "código de grupo vazio"): 1,
        ("contributions", "mês vazio ou inválido"): 1,
        ("redemptions", "mês vazio ou inválido"): 1,
        ("transfers", "direção fora do domínio"): 3,
        ("transfers", "mês vazio ou inválido"): 1,
    }
    blank = store.read("silver", "quarantine").filter("motivo = 'código de grupo vazio'").first()
    assert "“em aprovação”" in blank["registro_json"] and '"mes_ref":"2014-01-01"' in blank["registro_json"]


def test_rules_find_the_defects(built):
    store, *_ = built
    found = status(store)
    value = lambda table, rule: (found[table, rule]["valor_num"], found[table, rule]["status"])
    assert value("bronze.companies", "Coenti sem espaços nas pontas") == (5, "ALERTA")
    assert value("bronze.companies", "Cogrupo traz valores") == (100, "ALERTA")
    assert value("bronze.companies", "leitura em windows-1252") == (0, "OK")
    assert found["bronze.companies", "leitura em UTF-8"]["valor_num"] == 2
    assert value("bronze.*", "grafia única da chave") == (3, "ALERTA")
    assert value("silver.contributions", "contrib em formato de número") == (1, "FALHA")
    assert value("silver.contributions", "benef em formato de número") == (1, "FALHA")
    assert value("silver.contributions", "mês interpretável") == (1, "FALHA")
    assert found["silver.contributions", "contribuição sem sinal negativo"]["valor"] == "1 / -250.00"
    assert found["silver.portability", "direção conhecida"]["valor"] == "3 / 6000.00"
    assert found["silver.portability", "produto informado"]["valor"].startswith("1 / ")
    assert found["silver.portability", "produto informado"]["status"] == "ALERTA"
    assert value("silver.portability", "valor médio a partir de 100") == (8, "ALERTA")
    assert found["silver.redemptions", "cópias retiradas nada valem"]["status"] == "OK"
    assert found["silver.redemptions", "uma linha por chave em todo mês"]["valor"] == "201306"
    assert found["bronze.redemptions_vgbl", "cabeçalho conhecido"]["valor"] == "Resg_Pag_programado"
    assert found["silver.stock", "estoque com saldo"]["valor_num"] == 1
    assert found["silver.company_group_month", "nenhuma linha repetida"]["valor_num"] == 1
    assert found["silver.company_group_month", "histórico de grupo por empresa"]["valor_num"] == 1
    # what offends is named with the counts
    assert found["silver.portability", "direção conhecida"]["evidencia"]
    assert sum(int(x.split(": ")[1]) for x in found["silver.portability", "direção conhecida"]["evidencia"].split(", ")) == 3
    assert found["silver.contributions", "produto conhecido"]["evidencia"] == ""
    assert found["silver.contributions", "produtos da análise: VGBL, PGBL"]["evidencia"]
    assert found["silver.contributions", "contrib em formato de número"]["evidencia"] is None
    outlier = [r for (t, _), r in found.items() if r["dimensao"] == "Outliers"]
    assert [r["valor_num"] for r in outlier] == [1]


def test_reconciliation_bands(built):
    store, *_ = built
    table = store.read("silver", "reconciliation").filter("tipo_conciliacao = 'CONTRIB_PGBL'")
    found = {(r["cod_empresa"], r["classe_conciliacao"]) for r in table.collect()}
    assert {("00001", "ATE_0,1%"), ("00002", "ATE_1%"), ("00003", "ACIMA_5%"), ("00004", "SO_FONTE_A"), ("00009", "SO_FONTE_B")} == found


def test_bridge_follows_the_group_of_the_month(built):
    store, _, e, _ = built
    for r in store.read("gold", "bridge").collect():
        month = r["mes_ref"].strftime("%Y%m")
        assert (r["cod_grupo"], r["tipo_atribuicao"]) == e.group[r["cod_empresa"], month]
        if r["tipo_atribuicao"] == "HERDADA":
            assert r["meses_defasagem"] == int(month[4:]) - 2


def test_flow_fact_equals_plain_sums(built):
    store, _, e, _ = built
    keys = {k for d in (e.contributions, e.redemptions, e.accepted) for k in d if in_period(k[1])}
    rows = {(r["cod_empresa"], r["mes_ref"].strftime("%Y%m"), r["cod_produto"]): r for r in store.read("gold", "flow_fact").collect()}
    assert set(rows) == keys
    for k, r in rows.items():
        c, d, i, o = (x.get(k, 0) for x in (e.contributions, e.redemptions, e.accepted, e.ceded))
        assert (r["vl_contribuicao"], r["vl_resgate"], r["vl_portab_aceita"], r["vl_portab_cedida"]) == (c, d, i, o)
        assert (r["vl_flcr"], r["vl_captacao_liquida"]) == (c - d, c - d + i - o)
        assert (r["fl_tem_contribuicao"], r["fl_tem_resgate"], r["fl_tem_portabilidade"]) == tuple(k in x for x in (e.contributions, e.redemptions, e.accepted))
    assert dict(store.read("gold", "flow_fact").dtypes)["vl_captacao_liquida"] == "decimal(20,2)"


def test_gold_rules_pass_and_a_rerun_does_not_double_them(built):
    store, s, *_ = built
    before = status(store, "GOLD")
    build_gold(store, s)
    counted = store.read("silver", "dq_results").groupBy("camada").count().collect()
    counts = {r["camada"]: r["count"] for r in counted}
    assert counts["GOLD"] == len(before) == 24 and counts["SILVER"] > 50
    assert {r["status"] for r in before.values()} == {"OK"}


def test_gold_rules_scan_each_fact_once(built, monkeypatch):
    """Fifteen scans of the facts in the rules before; a failed rule now leaves the stored star as it was."""
    from dataclasses import replace

    import tidemark.plans.medallion as m

    store, s, *_ = built
    plans = []
    kept = m.stage

    def seen(df, label="stage"):
        if label == "gold-results":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(m, "stage", seen)
    spark = store.spark
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    before = store.read("gold", "flow_fact").count()
    with pytest.raises(QualityFailure):
        build_gold(store, replace(s, end="2015-03-01", max_unknown_share_pct=1))
    assert store.read("gold", "flow_fact").count() == before
    assert not [t for t in (r["tableName"] for r in store.list_tables("gold").collect()) if "__" in t]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    places = [p for p in plans[0].split("Location: ")[1:]]
    assert sum("/flow_fact__fresh" in p.split("]")[0] for p in places) == 1
    assert sum("/stock_fact__fresh" in p.split("]")[0] for p in places) == 1
    build_gold(store, s)


def test_builds_leave_no_staged_files(built, spark):
    import os

    from tidemark.session import shared_folder

    assert not [d for d in os.listdir(shared_folder(spark)) if d.startswith("block-")]


def test_answers(built):
    store, s, e, _ = built
    money = Money(1.0, 2, "")
    found = {name: df.collect() for name, df in answers(store, s, money).items()}
    annual = {(r["ano"], r["cod_produto"]): r for r in found["annual_flow"]}
    for p in PRODUCTS:
        paid = sum(v for (c, m, q), v in e.contributions.items() if m[:4] == "2014" and q == p)
        assert annual[2014, p]["contribuicoes"] == paid
    units = {}
    for (c, m, p), v in e.contributions.items():
        if m[:4] == "2014" and p == "VGBL":
            g = e.group[c, m][0]
            u = f"EMP_{c}" if g in ("99999", "NAO_INFORMADO") else g
            units[u] = units.get(u, 0) + v
    whole = sum(units.values())
    hhi = {(r["ano"], r["cod_produto"]): r for r in found["concentration"]}[2014, "VGBL"]
    assert hhi["hhi"] == round(sum((100 * v / whole) ** 2 for v in units.values())) and hhi["n_unidades"] == len(units)
    rate = {(r["base"], r["ano"], r["cod_produto"]): r for r in found["redemption_rate"]}
    drawn = sum(v for (c, m, p), v in e.redemptions.items() if m[:4] == "2014" and p == "VGBL")
    held = {}
    for (c, m, p), v in e.stock.items():
        if m[:4] == "2014" and p == "VGBL":
            held[m] = held.get(m, 0) + v
    assert rate["ANO_COMPLETO", 2014, "VGBL"]["taxa_resgate_pct"] == pytest.approx(100 * drawn / (sum(held.values()) / 12), abs=0.006)
    assert {r["unidade"] for r in found["unit_balance"]} >= {"EMP_00004", "EMP_00005"}  # one name, two units
    order = [r["posicao_captacao"] for r in found["rank_change"]]
    assert order == sorted(order) and len(found["rank_leaders"]) <= 12
    assert found["rank_summary"][0]["unidades"] == len(found["rank_change"])
    assert len(found["recent_rows"]) == 10 or len(found["recent_rows"]) == 20


def test_catalog_describes_every_column(built):
    store, *_ = built
    catalog = build_catalog(store)
    assert catalog.filter("descricao_coluna = '' OR descricao_coluna IS NULL").count() == 0
    found = {(r["tabela"], r["coluna"]): r for r in catalog.collect()}
    assert found["gold.dim_product", "cod_produto"]["dominio_observado"] == "{PGBL, VGBL}"
    assert found["gold.dim_calendar", "mes_ref"]["dominio_observado"] == "[2014-01-01 ; 2015-07-01]"
    assert found["silver.quarantine", "registro_json"]["dominio_observado"] == "JSON"
    assert found["silver.contributions", "vl_contribuicao"]["pct_nulos"] > 0
    described = {r["col_name"]: r["comment"] for r in store.describe("gold", "flow_fact").collect()}
    assert described["mes_ref"] == "First day of the month that the row is about, as a date."
    assert store.list_tables("gold").count() == 8


def test_missing_file_stops_the_load(spark, tmp_path):
    write_raw_files(str(tmp_path / "raw"))
    (tmp_path / "raw" / "transfers.csv").unlink()
    with pytest.raises(FileNotFoundError, match="transfers.csv"):
        build_bronze(new_store(spark, tmp_path / "tables"), settings(str(tmp_path / "raw")))


@pytest.mark.parametrize(
    ("file", "line", "error"),
    [
        ("redemptions_vgbl.csv", "201401;00001;5,00;0;0\n201401;00001;5,00;0;0\n", ValueLost),
        ("contributions.csv", "00001;201401;VGBL;1,00;0\n", DuplicateKey),
    ],
)
def test_gates_stop_the_build(spark, tmp_path, file, line, error):
    raw = tmp_path / "raw"
    write_raw_files(str(raw))
    with open(raw / file, "a", encoding="windows-1252") as f:
        f.write(line)
    store, s = new_store(spark, tmp_path / "tables"), settings(str(raw))
    build_bronze(store, s)
    with pytest.raises(error):
        build_silver(store, s)


def test_gold_gate_stops_on_too_many_unknown_groups(built, spark):
    store, s, *_ = built
    from dataclasses import replace

    with pytest.raises(QualityFailure, match="grupo atribuído"):
        build_gold(store, replace(s, max_unknown_share_pct=1))
    build_gold(store, s)
