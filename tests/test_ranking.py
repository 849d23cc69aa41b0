import pytest
from pyspark.sql import functions as F

from tiermill.operators import ranking as R
from tiermill.schemas import age_band_domain

QT = "qt_beneficiarios_ativos"


@pytest.fixture()
def gold(spark):
    rows = [(f"{i:03d}", f"City {i}", (i * 37) % 11 * 100) for i in range(57)]
    rows.append((None, "Nowhere", 300))
    return spark.createDataFrame(rows, f"cd_municipio string, nm_municipio string, {QT} long").repartition(5)


def brute(gold):
    rows = [tuple(r) for r in gold.collect()]
    return sorted(rows, key=lambda r: (-r[2], r[0] is None, r[0] or "", r[1]))


def test_with_position_matches_brute_force(spark, gold):
    out = R.with_position(gold, R.order_desc(QT, ["cd_municipio", "nm_municipio"])).collect()
    got = sorted(out, key=lambda r: r["posicao"])
    assert [r["posicao"] for r in got] == list(range(1, 59))
    assert [(r["cd_municipio"], r["nm_municipio"], r[QT]) for r in got] == brute(gold)


def test_rank_with_share(spark, gold):
    out = R.rank_with_share(gold, QT, ["cd_municipio", "nm_municipio"]).collect()
    assert abs(sum(r["participacao"] for r in out) - 100.0) < 1e-9
    top = min(out, key=lambda r: r["posicao"])
    assert top["proporcao_lider"] == 100.0


def test_share_zero_total(spark):
    df = spark.createDataFrame([("a", "x", 0), ("b", "y", 0)], f"cd_municipio string, nm_municipio string, {QT} long")
    out = R.rank_with_share(df, QT, ["cd_municipio", "nm_municipio"]).collect()
    assert {r["participacao"] for r in out} == {0.0}


@pytest.mark.parametrize("number,expected_page", [(0, 1), (1, 1), (3, 3), (99, 6)])
def test_page_is_clamped(spark, gold, number, expected_page):
    ranked = R.with_position(gold, R.order_desc(QT, ["cd_municipio"]))
    out = R.page(ranked, number, 10).collect()
    assert {r["pagina"] for r in out} == {expected_page}
    assert {r["n_paginas"] for r in out} == {6}
    lo = (expected_page - 1) * 10 + 1
    assert sorted(r["posicao"] for r in out) == list(range(lo, min(lo + 9, 58) + 1))
    with pytest.raises(ValueError):
        R.page(ranked, 1, 0)


def test_search_and_top_n(spark, gold):
    assert R.search(gold, "nm_municipio", "CITY 1").count() == 11
    top = R.top_n(gold, QT, ["cd_municipio", "nm_municipio"], 3).collect()
    assert [tuple(r) for r in top] == brute(gold)[:3]


def test_order_by_domain_drops_unknown_and_null(spark):
    bands = age_band_domain()
    assert len(bands) == 17 and bands[0] == "0 a 4 anos" and bands[-1] == "80 anos ou mais"
    df = spark.createDataFrame([("80 anos ou mais", 5), ("0 a 4 anos", 9), ("??", 1), (None, 2)],
                               f"de_faixa_etaria string, {QT} long")
    out = R.order_by_domain(R.flag_leader(df, QT, ["de_faixa_etaria"]), "de_faixa_etaria", bands).collect()
    assert [(r.de_faixa_etaria, r.ordem, r.lider) for r in out] == [("0 a 4 anos", 1, True), ("80 anos ou mais", 17, False)]


def test_concentration_and_kpis(spark, gold):
    ranked = R.with_position(gold, R.order_desc(QT, ["cd_municipio", "nm_municipio"]))
    c = R.concentration(ranked, QT, "nm_municipio").collect()[0]
    b = brute(gold)
    total = sum(r[2] for r in b)
    assert c.n_itens == 58 and c.total == total and c.lider == b[0][1]
    assert c.share_top5 == pytest.approx(100.0 * sum(r[2] for r in b[:5]) / total)
    ops = spark.createDataFrame([("1", "a", 3), ("1", "b", 4), ("2", "c", 1)], f"cd_operadora string, nm_razao_social string, {QT} long")
    fx = spark.createDataFrame([("0 a 4 anos", 5), ("5 a 9 anos", 7)], f"de_faixa_etaria string, {QT} long")
    k = R.kpis(ops, fx, gold).collect()[0]
    assert (k.total_beneficiarios, k.n_operadoras, k.n_municipios, k.faixa_lider, k.qt_faixa_lider) == (total, 2, 57, "5 a 9 anos", 7)


def test_display_headings(spark, gold):
    ranked = R.rank_with_share(gold, QT, ["cd_municipio", "nm_municipio"])
    out = R.display_municipios(ranked)
    assert out.columns == ["Posição", "Cód. IBGE", "Município", "Beneficiários ativos", "Participação"]
    first = out.orderBy("Posição").first()
    assert first["Beneficiários ativos"] == "1.000" and first["Participação"].endswith("%")


def test_no_global_window_over_data(spark, gold):
    """Positions must not come from a single-partition window over the rows."""
    ranked = R.with_position(gold, R.order_desc(QT, ["cd_municipio"]))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_with_position_heavy_ties_many_partitions(spark):
    # one value holds most rows: the keys break the tie, positions stay exact
    df = spark.range(20000).selectExpr(
        "lpad(CAST(id AS STRING), 6, '0') AS k", f"CASE WHEN id % 10 = 0 THEN id ELSE 7 END AS {QT}"
    ).repartition(16)
    out = R.with_position(df, R.order_desc(QT, ["k"])).select("posicao", "k", QT).collect()
    got = sorted(out, key=lambda r: r.posicao)
    expected = sorted(((r.k, r[QT]) for r in out), key=lambda x: (-x[1], x[0]))
    assert [r.posicao for r in got] == list(range(1, 20001))
    assert [(r.k, r[QT]) for r in got] == expected


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], f"cd_municipio string, nm_municipio string, {QT} long")
    assert R.with_position(empty, R.order_desc(QT, ["cd_municipio"])).count() == 0
    ranked = R.rank_with_share(empty, QT, ["cd_municipio", "nm_municipio"])
    assert ranked.count() == 0
    c = R.concentration(ranked, QT, "nm_municipio").collect()[0]
    assert c.n_itens == 0 and c.total is None and c.share_top1 == 0.0
    p = R.page(ranked, 3, 25).collect()
    assert p == []


def test_flag_leader_with_null_key(spark):
    df = spark.createDataFrame([(None, 9), ("a", 3)], f"de_faixa_etaria string, {QT} long")
    out = {r.de_faixa_etaria: r.lider for r in R.flag_leader(df, QT, ["de_faixa_etaria"]).collect()}
    assert out == {None: True, "a": False}


def test_display_cards_and_highlights(spark):
    df = spark.createDataFrame(
        [(f"{i:03d}", f"Op {i}", v) for i, v in enumerate([5000, 2500, 1250, 625, 625, 1000])],
        f"cd_operadora string, nm_razao_social string, {QT} long",
    )
    ranked = R.rank_with_share(df, QT, ["cd_operadora", "nm_razao_social"])
    cards = [tuple(r) for r in R.display_cards(ranked, "nm_razao_social", 3).orderBy("posicao").collect()]
    assert cards == [
        (1, "Op 0", "5.000", "45,5%", 100.0),
        (2, "Op 1", "2.500", "22,7%", 50.0),
        (3, "Op 2", "1.250", "11,4%", 25.0),
    ]
    h = R.display_highlights(R.concentration(ranked, QT, "nm_razao_social")).collect()[0]
    assert (h.lider, h.quantidade_lider, h.participacao_lider, h.n_itens) == ("Op 0", "5.000", "45,5%", "6")
    assert (h.concentracao_top5, h.concentracao_top10) == ("94,3%", "100,0%")  # 10375 / 11000


def test_kpis_on_empty_golds(spark):
    ops = spark.createDataFrame([], f"cd_operadora string, nm_razao_social string, {QT} long")
    fx = spark.createDataFrame([], f"de_faixa_etaria string, {QT} long")
    mu = spark.createDataFrame([], f"cd_municipio string, nm_municipio string, {QT} long")
    rows = R.kpis(ops, fx, mu).collect()
    assert len(rows) == 1 and (rows[0].n_operadoras, rows[0].n_municipios, rows[0].faixa_lider) == (0, 0, None)


def test_search_is_literal_and_case_insensitive(spark):
    df = spark.createDataFrame([("1", "NATION_1"), ("2", "NATIONX1"), ("3", "nation_10"), ("4", "50%_off")],
                               "cd_municipio string, nm_municipio string")
    assert sorted(r.cd_municipio for r in R.search(df, "nm_municipio", "nation_1").collect()) == ["1", "3"]
    assert [r.cd_municipio for r in R.search(df, "nm_municipio", "%_").collect()] == ["4"]
