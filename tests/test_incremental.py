"""Write-audit-publish, golds by month, streamed months, rejects, the ledger of deliveries, search and pages."""

import os

import pytest
from pyspark.sql import functions as F

from tests.support import SF_SMALL, local_path
from tiermill.operators import quality, rejects
from tiermill.operators.ranking import page, page_stored, search
from tiermill.plans import load_golds, load_month, load_silver, run, upsert
from tiermill.plans.medallion import (
    SILVER,
    golds_from_partials,
    load_partials,
    load_rankings,
    month_sums,
    refresh_gold,
    refresh_gold_months,
    refresh_partials,
)
from tiermill.schemas import GOLD_KEYS, MONTH, RAW_COLUMNS, RAW_SCHEMA
from tiermill.session import new_scratch_path
from tiermill.sources.fixture import raw_from_tpch, write_raw_csv
from tiermill.sources.ledger import ledger, load_new, sort_out
from tiermill.sources.staging import STAGING, promote, staged
from tiermill.streaming.months import stream_months


@pytest.fixture(scope="module")
def raws(spark):
    base = new_scratch_path(spark, "incremental-raw")
    for dirty in (False, True):
        write_raw_csv(raw_from_tpch(spark, SF_SMALL, dirty).filter("ID_CMPT_MOVEL < '1996'"), f"{base}/{dirty}")
    return base


@pytest.fixture()
def lake(spark, raws, scratch):
    run(spark, f"{raws}/False", scratch, f"{scratch}-out", steps=["bronze", "silver", "gold"])
    return scratch


def golds_of(spark, root):
    return {t: sorted(map(tuple, g.collect()), key=str) for t, g in load_golds(spark, root).by_table().items()}


def test_a_dirty_delivery_leaves_the_former_layers(spark, raws, lake):
    before, silver = golds_of(spark, lake), load_silver(spark, lake).count()
    with pytest.raises(quality.ChecksFailed):
        run(spark, f"{raws}/True", lake, steps=["bronze", "silver", "gold"], gate=True)
    assert golds_of(spark, lake) == before and load_silver(spark, lake).count() == silver
    assert load_silver(spark, lake).filter("qt_beneficiario_ativo is null").count() == 0
    staging = local_path(f"{lake}/{STAGING}")
    assert not os.path.isdir(staging) or not os.listdir(staging)
    # a clean one is promoted, and nothing is left beside the tables
    run(spark, f"{raws}/False", lake, steps=["bronze", "silver", "gold"], gate=True)
    assert golds_of(spark, lake) == before
    assert not [n for n in os.listdir(local_path(f"{lake}/gold")) if n.endswith(".before")]


def test_a_broken_promotion_is_undone(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/t")
    with staged(spark, scratch) as aside:
        spark.range(5).write.parquet(f"{aside}/t")
        os.rename(local_path(f"{scratch}/t"), local_path(f"{scratch}/t.before"))  # stopped between the two renames
        promote(spark, f"{aside}/t", f"{scratch}/t")
    assert spark.read.parquet(f"{scratch}/t").count() == 5
    assert sorted(os.listdir(local_path(scratch))) == [STAGING, "t"]


def test_golds_from_months_equal_a_full_refresh_after_every_month(spark, lake):
    months = [r[0] for r in load_silver(spark, lake).select(MONTH).distinct().orderBy(MONTH).collect()]
    assert refresh_partials(spark, lake, []) == months  # all are missing at first
    for month in months[:3]:
        rows = load_silver(spark, lake).filter(F.col(MONTH) == month).withColumn("qt_beneficiario_ativo", F.col("qt_beneficiario_ativo") + 1)
        at = new_scratch_path(spark, "month")
        rows.write.parquet(at)
        load_month(spark.read.parquet(at), lake, month)
        refresh_gold_months(spark, lake, [month])
        merged = golds_of(spark, lake)
        refresh_gold(spark, lake)
        assert golds_of(spark, lake) == merged
    assert refresh_partials(spark, lake, [months[1]]) == [months[1]]


def test_only_the_loaded_month_of_silver_is_scanned(spark, lake):
    from tiermill.plans.medallion import _month_in

    plan = month_sums(load_silver(spark, lake).filter(_month_in(["1995-05"])))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "1995-05" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    refresh_partials(spark, lake, [])
    plan = golds_from_partials(load_partials(spark, lake)).operadora._jdf.queryExecution().executedPlan().toString()
    assert "silver" not in plan and "_parciais_por_mes" in plan


def test_writers_of_silver_keep_the_sums_right(spark, lake):
    refresh_partials(spark, lake, [])
    batch = load_silver(spark, lake).filter(F.col(MONTH) == "1995-06").limit(1).withColumn(MONTH, F.lit(None).cast("string"))
    at = new_scratch_path(spark, "batch")
    batch.write.parquet(at)
    upsert(spark, spark.read.parquet(at), lake, *SILVER, [MONTH, "cd_operadora", "cd_municipio", "de_faixa_etaria"],
           schema=load_silver(spark, lake).schema, partition_by=[MONTH], unique=False)
    assert load_partials(spark, lake).filter(F.col(MONTH).isNull()).count() == len(GOLD_KEYS)
    refresh_gold_months(spark, lake, [])
    merged = golds_of(spark, lake)
    refresh_gold(spark, lake)
    assert golds_of(spark, lake) == merged
    # months that are gone lose their sums
    kept = load_silver(spark, lake).filter(F.col(MONTH) >= "1995-06")
    kept.write.parquet(f"{at}-kept")
    spark.read.parquet(f"{at}-kept").write.mode("overwrite").partitionBy(MONTH).parquet(f"{lake}/{'/'.join(SILVER)}")
    assert refresh_partials(spark, lake, []) == []
    assert load_partials(spark, lake).filter(F.col(MONTH).isNull() | (F.col(MONTH) < "1995-06")).count() == 0


def test_a_month_delivered_again_by_stream_replaces_the_earlier_one(spark, raws, scratch):
    raw = spark.read.options(header=True, sep=";").schema(RAW_SCHEMA).csv(f"{raws}/False")
    write_raw_csv(raw, f"{scratch}/in/a")
    stream_months(spark, f"{scratch}/in/*", f"{scratch}/lake", f"{scratch}/checkpoint")
    first = load_silver(spark, f"{scratch}/lake").groupBy(MONTH).count().collect()
    write_raw_csv(raw.filter("ID_CMPT_MOVEL = '1995-07'").limit(2), f"{scratch}/in/b")
    stream_months(spark, f"{scratch}/in/*", f"{scratch}/lake", f"{scratch}/checkpoint")
    now = dict(map(tuple, load_silver(spark, f"{scratch}/lake").groupBy(MONTH).count().collect()))
    assert now.pop("1995-07") == 2 and now == {k: v for k, v in map(tuple, first) if k != "1995-07"}
    merged = golds_of(spark, f"{scratch}/lake")
    refresh_gold(spark, f"{scratch}/lake")
    assert golds_of(spark, f"{scratch}/lake") == merged
    # nothing new: nothing changes
    stream_months(spark, f"{scratch}/in/*", f"{scratch}/lake", f"{scratch}/checkpoint")
    assert golds_of(spark, f"{scratch}/lake") == merged


def test_short_and_long_lines_are_rejected_with_their_text(spark, scratch):
    good = ["1"] * 14 + ["10", "1", "2", "2024-05-01", "2024-05"]
    bad = {14: "x1", 15: "99999999999", 17: "01/05/2024"}
    lines = [good, good[:7], [*good, "more"], [bad.get(i, v) for i, v in enumerate(good)], [" " if i == 16 else v for i, v in enumerate(good)]]
    at = local_path(scratch)
    os.makedirs(at)
    with open(f"{at}/raw.csv", "w") as f:
        f.write("\n".join(";".join(x) for x in [RAW_COLUMNS, *lines]) + "\n")
    accepted, rejected = rejects.split(rejects.read_with_lines(spark, f"{scratch}/raw.csv"))
    assert accepted.columns == RAW_COLUMNS and [r.ID_CMPT_MOVEL for r in accepted.collect()] == ["2024-05"]
    got = sorted((r["coluna"], r["motivo"], r["valor"]) for r in rejected.collect())
    assert got == sorted([
        ("*", "numero de campos", ";".join(lines[1])), ("*", "numero de campos", ";".join(lines[2])),
        ("QT_BENEFICIARIO_ATIVO", "nao inteiro", "x1"), ("QT_BENEFICIARIO_ADERIDO", "nao inteiro", "99999999999"),
        ("DT_CARGA", "nao e data", "01/05/2024"), ("QT_BENEFICIARIO_CANCELADO", "em branco", " ")])


def test_a_file_is_loaded_once_under_any_name(spark, raws, scratch):
    raw = spark.read.options(header=True, sep=";").schema(RAW_SCHEMA).csv(f"{raws}/False")
    write_raw_csv(raw, f"{scratch}/a")
    write_raw_csv(raw.orderBy(F.desc("CD_OPERADORA"), "DT_CARGA").coalesce(1), f"{scratch}/b")  # the rows in another order and one file
    loaded = []
    report = load_new(spark, f"{scratch}/a", scratch, lambda rows: loaded.append(rows.count()))
    assert {r["situacao"] for r in report.collect()} == {"nova"} and sum(loaded) == raw.count()
    files = report.count()
    again = load_new(spark, f"{scratch}/a", scratch, lambda rows: loaded.append(rows.count()))
    assert again.filter("situacao = 'repetida' and igual_a is not null").count() == files and len(loaded) == 1
    assert ledger(spark, scratch).count() == files
    if files == 1:  # equal as a whole, whatever the order of rows
        assert [r["situacao"] for r in sort_out(spark, f"{scratch}/b", scratch).collect()] == ["repetida"]
    # two equal files in one delivery: the first by name
    write_raw_csv(raw.limit(3).coalesce(1), f"{scratch}/c/x")
    write_raw_csv(raw.limit(3).coalesce(1), f"{scratch}/c/y")
    assert sorted(r["situacao"] for r in sort_out(spark, f"{scratch}/c/*", scratch).collect()) == ["nova", "repetida"]

    def fail(rows):
        raise RuntimeError("no load")

    with pytest.raises(RuntimeError):
        load_new(spark, f"{scratch}/c/x", scratch, fail)
    assert ledger(spark, scratch).count() == files  # made again by the next delivery


def test_search_without_accents(spark):
    names = spark.createDataFrame([("São Paulo",), ("SAO TOME",), ("Santos",), (None,), ("são%_",)], "nm string")
    found = lambda term, **k: sorted(r[0] for r in search(names, "nm", term, **k).collect())
    assert found("sao", accents=False) == ["SAO TOME", "São Paulo", "são%_"]
    assert found("SÃO", accents=False) == ["SAO TOME", "São Paulo", "são%_"]
    assert found("sao") == ["SAO TOME"] and found("%", accents=False) == ["são%_"]


def test_pages_of_a_stored_ranking_push_their_bounds(spark, lake):
    from tiermill.plans.medallion import publish

    publish(spark, lake, f"{lake}-out")
    ranked = load_rankings(spark, lake).operadora
    for number in (-1, 1, 2, 99):
        assert page_stored(ranked, number, 4).collect() == page(ranked, number, 4).collect()
    plan = page_stored(ranked, 2, 4)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(posicao,4)" in plan and "LessThanOrEqual(posicao,8)" in plan
    with pytest.raises(ValueError):
        page_stored(ranked, 1, 0)
