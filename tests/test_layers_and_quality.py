import pytest
from pyspark.sql import functions as F

from tiermill.operators import quality as Q
from tiermill.operators.layers import Golds, gold_by, to_bronze, to_golds, to_silver
from tiermill.schemas import RAW_COLUMNS, RAW_SCHEMA


def raw_rows(spark, rows):
    """Raw frame from dicts of overrides on a valid default row."""
    base = {
        "CD_OPERADORA": "000001", "NM_RAZAO_SOCIAL": " OP ONE ", "NR_CNPJ": "00000001000199",
        "MODALIDADE_OPERADORA": "M", "SG_UF": "SP", "CD_MUNICIPIO": "1", "NM_MUNICIPIO": "CITY",
        "TP_SEXO": "F", "DE_FAIXA_ETARIA": "40 a 44 anos", "DE_SEGMENTACAO_PLANO": "S",
        "DE_ABRG_GEOGRAFICA_PLANO": "G", "DE_CONTRATACAO_PLANO": "C", "COBERTURA_ASSIST_PLAN": "P",
        "TIPO_VINCULO": "T", "QT_BENEFICIARIO_ATIVO": "10", "QT_BENEFICIARIO_ADERIDO": "1",
        "QT_BENEFICIARIO_CANCELADO": "0", "DT_CARGA": "2025-08-31", "ID_CMPT_MOVEL": "202508",
    }
    data = [tuple({**base, **r}[c] for c in RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(data, RAW_SCHEMA)


def test_bronze_audit_columns(spark):
    b = to_bronze(raw_rows(spark, [{}, {}]), source="s3://x/file.csv")
    rows = b.select("_ingested_at", "_source_file").distinct().collect()
    assert len(rows) == 1 and rows[0][0] is not None and rows[0][1] == "s3://x/file.csv"


def test_silver_edge_rows(spark):
    raw = raw_rows(spark, [
        {"QT_BENEFICIARIO_ATIVO": ""}, {"QT_BENEFICIARIO_ATIVO": " 12 "}, {"QT_BENEFICIARIO_ATIVO": "12.7"},
        {"NR_CNPJ": None}, {"NR_CNPJ": "123"}, {"NM_MUNICIPIO": "  x\t"}, {"DT_CARGA": "31/08/2025"},
    ])
    s = to_silver(to_bronze(raw, "f")).collect()
    assert [r.qt_beneficiario_ativo for r in s[:3]] == [None, 12, None]
    assert s[3].nr_cnpj_masc is None and s[4].nr_cnpj_masc == "123******"
    assert s[5].nm_municipio == "x\t" and s[0].nm_razao_social == "OP ONE"
    assert s[6].dt_carga is None and s[0].id_cmpt_movel == "202508"


def test_gold_null_key_and_two_names(spark):
    raw = raw_rows(spark, [{"DE_FAIXA_ETARIA": None}, {}, {"NM_RAZAO_SOCIAL": "OTHER NAME"}])
    silver = to_silver(to_bronze(raw, "f"))
    g = to_golds(silver)
    assert g.faixa.count() == 2
    assert g.operadora.count() == 2
    assert dict(g.operadora.dtypes)["qt_beneficiarios_ativos"] == "bigint"
    # strict reconcile (reference behaviour): NULL key and the two-name code diverge
    strict = Q.divergences(Q.recompute(silver, "de_faixa_etaria"), g.faixa, "de_faixa_etaria").count()
    assert strict == 2
    safe = Q.divergences(Q.recompute(silver, ["de_faixa_etaria"]), g.faixa, ["de_faixa_etaria"], mode="null_safe").count()
    assert safe == 0
    assert Q.divergences(Q.recompute(silver, "cd_operadora"), g.operadora, "cd_operadora").count() == 2
    assert Q.divergences(Q.recompute(silver, ["cd_operadora", "nm_razao_social"]), g.operadora,
                         ["cd_operadora", "nm_razao_social"], mode="null_safe").count() == 0


def _passed(df):
    return {r["check"]: r["passed"] for r in df.collect()}


def test_checks_pass_on_clean_rows(spark):
    raw = raw_rows(spark, [{}, {"CD_OPERADORA": "000002", "QT_BENEFICIARIO_ATIVO": "5"}])
    bronze = to_bronze(raw, "f")
    silver = to_silver(bronze)
    golds = to_golds(silver)
    rep = Q.report(
        Q.check_volume(raw, bronze, silver), Q.check_typing(bronze, silver), Q.check_masking(silver),
        Q.check_sanity(silver), Q.check_reconcile(silver, golds), Q.check_totals(silver, golds),
    )
    assert all(_passed(rep).values()) and len(_passed(rep)) == 13
    s = Q.summary(rep).collect()[0]
    assert (s.n_passed, s.n_checks, s.all_passed) == (13, 13, True)
    Q.assert_all(rep)


def test_checks_fail_on_damaged_rows(spark):
    raw = raw_rows(spark, [{"QT_BENEFICIARIO_ATIVO": "abc"}, {"NR_CNPJ": None}, {"QT_BENEFICIARIO_ATIVO": "-3"},
                           {"NR_CNPJ": "123456789012345"}])
    bronze = to_bronze(raw, "f")
    silver = to_silver(bronze)
    p = _passed(Q.check_typing(bronze, silver))
    assert p["V2 no extra NULL in qt_beneficiario_ativo"] is False
    m = _passed(Q.check_masking(silver))
    assert m["V3a every id ends in the mask"] is False
    assert _passed(Q.check_sanity(silver))["V4 no negative active quantity"] is False
    with pytest.raises(Q.ChecksFailed):
        Q.assert_all(Q.check_sanity(silver))


def test_reconcile_detects_damaged_gold(spark):
    raw = raw_rows(spark, [{"CD_OPERADORA": f"{i:06d}", "QT_BENEFICIARIO_ATIVO": str(i)} for i in range(1, 6)])
    silver = to_silver(to_bronze(raw, "f"))
    g = to_golds(silver)
    damaged = g.operadora.select(
        F.when(F.col("cd_operadora") == "000001", F.lit("999999")).otherwise(F.col("cd_operadora")).alias("cd_operadora"),
        "nm_razao_social",
        F.when(F.col("cd_operadora") == "000005", F.col("qt_beneficiarios_ativos") + 1)
        .otherwise(F.col("qt_beneficiarios_ativos")).alias("qt_beneficiarios_ativos"),
    )
    assert Q.divergences(Q.recompute(silver, "cd_operadora"), damaged, "cd_operadora").count() == 3
    p = _passed(Q.check_reconcile(silver, Golds(damaged, g.faixa, g.municipio)))
    assert p["V5 gold operadora = recompute"] is False and p["V5 gold municipio = recompute"] is True
    t = _passed(Q.check_totals(silver, Golds(damaged, g.faixa, g.municipio)))
    assert t["V7 totals equal in silver and golds"] is False


def test_gold_by_is_partial_aggregate(spark):
    raw = raw_rows(spark, [{}])
    plan = gold_by(to_silver(to_bronze(raw, "f")), ["cd_operadora"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_one_pass_golds_equal_separate_scans(spark):
    from tiermill.operators.layers import golds_one_pass, split_golds

    raw = raw_rows(spark, [
        {"DE_FAIXA_ETARIA": None}, {}, {"NM_RAZAO_SOCIAL": "OTHER NAME"}, {"CD_MUNICIPIO": None},
        {"CD_OPERADORA": "000002", "QT_BENEFICIARIO_ATIVO": "7"}, {"QT_BENEFICIARIO_ATIVO": "x"},
    ])
    silver = to_silver(to_bronze(raw, "f"))
    a, b = split_golds(golds_one_pass(silver)), to_golds(silver)
    for x, y in zip(a.by_table().values(), b.by_table().values()):
        assert sorted(map(tuple, x.collect()), key=str) == sorted(map(tuple, y.collect()), key=str)
        assert x.dtypes == y.dtypes


def test_full_suite_has_21_checks_on_clean_lake(spark):
    import __spark_entry__ as e

    rep = e.queries()["dq_report"](spark, "/root/testdata/sf0.001")
    rows = rep.collect()
    assert len(rows) == 21 and all(r.passed for r in rows)


def test_reconcile_suite_modes(spark):
    raw = raw_rows(spark, [{"DE_FAIXA_ETARIA": None}, {}, {"NM_RAZAO_SOCIAL": "OTHER NAME"}])
    silver = to_silver(to_bronze(raw, "f"))
    g = to_golds(silver)
    strict = {r["check"]: r["detail"] for r in Q.check_reconcile(silver, g).collect()}
    assert strict == {
        "V5 gold operadora = recompute": "divergences=2",
        "V5 gold faixa_etaria = recompute": "divergences=2",
        "V5 gold municipio = recompute": "divergences=0",
    }
    safe = Q.check_reconcile(silver, g, mode="null_safe").collect()
    assert all(r["passed"] for r in safe) and len(safe) == 3
    with pytest.raises(ValueError):
        Q.check_reconcile(silver, g, mode="other")
