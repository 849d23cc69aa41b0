"""What is shuffled and written for a lake: no wide rows through a shuffle, no table twice."""

import os

import pytest
from pyspark.sql import functions as F

from tests.support import SF_SMALL, local_path
from tiermill.operators.layers import to_bronze, to_silver
from tiermill.plans import catalogue
from tiermill.plans import workspace as W
from tiermill.plans.catalogue import deliveries_once
from tiermill.plans.medallion import _may_match, load_silver, upsert
from tiermill.session import _MADE
from tiermill.sources import layers
from tiermill.sources.fixture import DELIVERY_OPTIONS, joined_lines, raw_from_tpch, raw_rows, write_raw_csv
from tiermill.sources.layers import write_layer
from tiermill.sources.ledger import CONTENT, fingerprints
from tiermill.sources.raw_csv import read_raw


def _files(path, end):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(local_path(path)) for f in fs if f.endswith(end))


def test_raw_files_are_compressed_and_written_by_the_tasks_that_have_the_rows(spark, scratch):
    raw = raw_from_tpch(spark, SF_SMALL).repartition(3)
    write_raw_csv(raw, f"{scratch}/raw")
    assert len(_files(f"{scratch}/raw", ".csv.gz")) == 3 and not _files(f"{scratch}/raw", ".csv")
    back = read_raw(spark, f"{scratch}/raw")
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_lines_that_joins_shuffle_are_narrow(spark):
    lines = joined_lines(spark, SF_SMALL)
    assert not {"s_name", "n_name", "r_name", "l_partkey"} & set(lines.columns)
    for dirty in (False, True):
        a, b = raw_rows(spark, SF_SMALL, lines, dirty), raw_from_tpch(spark, SF_SMALL, dirty)
        assert a.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
        assert a.exceptAll(b).count() == 0


def test_clean_and_dirty_delivery_are_made_of_the_same_stored_lines(spark):
    made = len([p for p in _MADE if "/cut-" in p])
    first = W.stored_lines(spark, f"{SF_SMALL}/")
    assert W.stored_lines(spark, SF_SMALL) is first
    assert len([p for p in _MADE if "/cut-" in p]) <= made + 1


def test_local_layout_writes_without_sort_or_shuffle(spark, scratch):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    rows = spark.range(3000).select((F.col("id") % 200).cast("string").alias("m"), "id").repartition(2, "id")
    write_layer(rows, scratch, "silver", "t", partition_by=["m"], layout="local")  # more values than files open at once
    back = spark.read.parquet(f"{scratch}/silver/t")
    assert back.count() == 3000 and back.select("id").distinct().count() == 3000
    assert back.filter("cast(m as int) <> id % 200").count() == 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == before


def test_silver_of_two_files_is_written_by_their_two_tasks(spark, scratch):
    from tiermill.plans.medallion import run

    raw = raw_from_tpch(spark, SF_SMALL).limit(400).repartition(2)
    write_raw_csv(raw, f"{scratch}/raw")
    run(spark, f"{scratch}/raw", f"{scratch}/lake", steps=["bronze", "silver"])
    silver = load_silver(spark, f"{scratch}/lake")
    assert silver.select(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).alias("t")).distinct().count() <= 2
    want = to_silver(to_bronze(raw, source="x"))
    assert silver.exceptAll(want).count() == 0 and want.exceptAll(silver).count() == 0


def test_upsert_joins_only_rows_that_can_have_a_key_of_the_batch(spark, scratch):
    old = spark.createDataFrame(
        [("1", "a", 1), ("1", None, 2), ("2", "a", 3), (None, "a", 4), (None, None, 5), ("3", "b", 6), ("1", "a", 7)],
        "m string, c string, v int")
    batch = spark.createDataFrame([("1", "a", 10), (None, None, 50)], "m string, c string, v int")
    may = _may_match(batch, ["m", "c"])
    assert sorted(r.v for r in old.filter(may).collect()) == [1, 2, 4, 5, 7]
    assert old.filter(~may).count() == 2  # no row lost to an unknown condition
    write_layer(old, scratch, "silver", "u")
    upsert(spark, batch, scratch, "silver", "u", ["m", "c"])
    assert sorted(r.v for r in spark.read.parquet(f"{scratch}/silver/u").collect()) == [2, 3, 4, 6, 10, 50]


def test_deliveries_of_other_names_have_the_same_files(spark):
    rows = deliveries_once(spark, SF_SMALL)
    base = [p for p in _MADE if "/once-" in p][-1]
    first, again = (read_raw(spark, f"{base}/raw/entrega={name}") for name in ("first", "again"))
    content = lambda raw: sorted(tuple(r) for r in fingerprints(raw).select(*CONTENT).collect())
    assert content(first) == content(again)
    assert rows.count() == first.count() and rows.exceptAll(first).count() == 0


def test_deliveries_are_written_by_tasks_with_one_file_open(spark, monkeypatch):
    written = []
    monkeypatch.setattr(catalogue, "write_raw_csv", lambda raw, path: written.append(path.rsplit("/", 1)[1]) or write_raw_csv(raw, path))
    rows = deliveries_once(spark, SF_SMALL)
    assert written == ["entrega=first", "entrega=again"]
    assert rows.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_small_tasks_read_few_bytes_each_and_leave_the_setting(spark, scratch, monkeypatch):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.range(600).repartition(6).write.parquet(f"{scratch}/t")
    tasks = lambda: spark.read.parquet(f"{scratch}/t").rdd.getNumPartitions()
    assert tasks() < 6
    monkeypatch.setattr(layers, "TASK_BYTES", 4096)
    with layers.small_tasks(spark):
        assert tasks() == 6
    with pytest.raises(ValueError), layers.small_tasks(spark):
        raise ValueError
    assert spark.conf.get(key) == before
    spark.conf.set(key, "2k")  # a smaller one stays
    try:
        with layers.small_tasks(spark):
            assert spark.conf.get(key) == "2048"
        assert spark.conf.get(key) == "2k"
    finally:
        spark.conf.set(key, before)


def test_sorted_layout_writes_a_file_per_task_and_value(spark, scratch):
    rows = spark.range(3000).select((F.col("id") % 200).cast("string").alias("m"), "id").repartition(2, "id")
    rows = rows.select(F.when(F.col("m") != "7", F.col("m")).alias("m"), "id")  # a NULL month among them
    write_layer(rows, scratch, "silver", "t", partition_by=["m"], layout="sorted")
    back = spark.read.schema(rows.schema).parquet(f"{scratch}/silver/t").select("m", "id")
    assert len(_files(f"{scratch}/silver/t", ".parquet")) == 400
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    with pytest.raises(ValueError, match="layout"):
        write_layer(rows, scratch, "silver", "t", partition_by=["m"], layout="unknown")


def test_layers_of_the_runner_are_read_in_small_tasks_and_silver_is_sorted(spark, scratch, monkeypatch):
    from tiermill.plans import medallion

    seen, write = {}, medallion.write_layer

    def watched(df, root, layer, table, *args, **kw):
        seen[layer, table] = (int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")), kw.get("layout"))
        return write(df, root, layer, table, *args, **kw)

    monkeypatch.setattr(medallion, "write_layer", watched)
    write_raw_csv(raw_from_tpch(spark, SF_SMALL).limit(50), f"{scratch}/raw")
    medallion.run(spark, f"{scratch}/raw", f"{scratch}/lake", steps=["bronze", "silver", "gold"])
    assert seen["bronze", "beneficiarios"][0] == layers.TASK_BYTES
    assert seen["silver", "beneficiarios"] == (layers.TASK_BYTES, "sorted")
    assert seen["gold", "beneficiarios_por_municipio"][0] > layers.TASK_BYTES  # files of silver are many and small already


def test_raw_files_are_compressed_at_the_fastest_level(spark, scratch):
    raw = raw_from_tpch(spark, SF_SMALL).coalesce(1)
    write_raw_csv(raw, f"{scratch}/raw")
    raw.write.options(**{**DELIVERY_OPTIONS, "zlib.compress.level": "BEST_COMPRESSION"}).csv(f"{scratch}/small")
    size = lambda p: sum(map(os.path.getsize, _files(p, ".csv.gz")))
    assert size(f"{scratch}/raw") > 1.15 * size(f"{scratch}/small")
