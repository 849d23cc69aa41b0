import pytest

from tiermill.schemas import RAW_COLUMNS, SILVER_SCHEMA, gold_schema
from tiermill.sources import SourceNotFound, read_layer, read_raw, write_layer
from tiermill.sources.results import drop_order_columns, export_result, read_result, written_order
from tiermill.operators.ranking import with_position

HEADER = ";".join(f'"{c}"' for c in RAW_COLUMNS)


def write_text(spark, path, text):
    # Written through Spark so the test also works on a shared file system.
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_missing_source_fails_early(spark, scratch):
    with pytest.raises(SourceNotFound):
        read_raw(spark, f"{scratch}/does-not-exist")


def test_raw_scan_edge_rows(spark, scratch):
    full = ";".join(['"1"'] * 19)
    rows = [
        HEADER,
        '"a;b";' + ";".join(['"x"'] * 18),   # separator inside quotes
        '"3";"a"',                            # short row
        full + ';"extra"',                    # long row
        "",                                   # blank line
        '"q""q";' + ";".join(['""'] * 18),    # doubled quote, empty quoted fields
    ]
    path = f"{scratch}/raw"
    write_text(spark, path, "\n".join(rows))
    df = read_raw(spark, path)
    assert df.columns == RAW_COLUMNS
    out = df.collect()
    assert len(out) == 4
    assert out[0]["CD_OPERADORA"] == "a;b"
    assert out[1]["CD_OPERADORA"] == "3" and out[1]["NM_RAZAO_SOCIAL"] == "a" and out[1]["ID_CMPT_MOVEL"] is None
    assert out[2]["ID_CMPT_MOVEL"] == "1"
    assert out[3]["CD_OPERADORA"] == '"q""q"' or out[3]["CD_OPERADORA"] == 'q"q'
    assert out[3]["QT_BENEFICIARIO_ATIVO"] is None


def test_partition_value_stays_text(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("202508", 1)], "id_cmpt_movel string, n int")
    silver_like = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER_SCHEMA.fields if f.name != "id_cmpt_movel"], "id_cmpt_movel")
    write_layer(silver_like, scratch, "silver", "t", partition_by=["id_cmpt_movel"])
    back = read_layer(spark, scratch, "silver", "t", schema=SILVER_SCHEMA)
    assert dict(back.dtypes)["id_cmpt_movel"] == "string"
    assert back.collect()[0]["id_cmpt_movel"] == "202508"


def test_range_layout_same_rows(spark, scratch):
    df = spark.range(5000).selectExpr("CAST(id % 3 AS STRING) AS m", "id")
    write_layer(df, scratch, "silver", "local", partition_by=["m"])
    write_layer(df, scratch, "silver", "range", partition_by=["m"], layout="range")
    a = read_layer(spark, scratch, "silver", "local")
    b = read_layer(spark, scratch, "silver", "range")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_export_keeps_order_and_leading_zeros(spark, scratch):
    rows = [(f"{i:06d}", f"name{i}", (i * 7919) % 1000) for i in range(300)]
    df = spark.createDataFrame(rows, "cd_operadora string, nm_razao_social string, qt_beneficiarios_ativos long")
    ordered = df.orderBy(df.qt_beneficiarios_ativos.desc(), df.cd_operadora).repartitionByRange(
        4, df.qt_beneficiarios_ativos.desc(), df.cd_operadora
    ).sortWithinPartitions(df.qt_beneficiarios_ativos.desc(), df.cd_operadora)
    export_result(ordered, scratch, "r")
    back = read_result(spark, scratch, "r", gold_schema("beneficiarios_por_operadora"), keep_order_columns=True)
    pos = drop_order_columns(with_position(back, written_order())).orderBy("posicao").collect()
    expected = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert [(r["cd_operadora"], r["qt_beneficiarios_ativos"]) for r in pos] == [(e[0], e[2]) for e in expected]


def test_file_positions_across_parts_and_splits(spark, scratch):
    from tiermill.sources.results import read_result_positions

    rows = [(f"{i:06d}", f"name{i}", (i * 7919) % 1000) for i in range(2000)]
    df = spark.createDataFrame(rows, "cd_operadora string, nm_razao_social string, qt_beneficiarios_ativos long")
    order = [df.qt_beneficiarios_ativos.desc(), df.cd_operadora]
    export_result(df.repartitionByRange(5, *order).sortWithinPartitions(*order), scratch, "r")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits per file
    try:
        got = read_result_positions(spark, scratch, "r", gold_schema("beneficiarios_por_operadora")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted(got, key=lambda r: r["posicao"])
    expected = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert [r["posicao"] for r in got] == list(range(1, 2001))
    assert [r["cd_operadora"] for r in got] == [e[0] for e in expected]


def test_range_layout_splits_hot_month(spark, scratch):
    from pyspark.sql import functions as F

    # one month holds 90% of the rows
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 == 0, F.lit("2025-07")).otherwise(F.lit("2025-08")).alias("m"), "id"
    )
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        write_layer(df, scratch, "silver", "hot", partition_by=["m"], layout="range")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    files = (
        spark.read.parquet(f"{scratch}/silver/hot")
        .filter(F.col("m") == "2025-08")
        .select(F.input_file_name().alias("f"))
        .groupBy("f").count().collect()
    )
    assert len(files) >= 4  # the hot month is written by several tasks
    assert max(r["count"] for r in files) < 36000 * 0.5


def test_rebalance_layout_splits_hot_month(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.range(200000).select(
        F.when(F.col("id") % 10 == 0, F.lit("2025-07")).otherwise(F.lit("2025-08")).alias("m"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    ).repartition(8)
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        write_layer(df, scratch, "silver", "reb", partition_by=["m"], layout="rebalance")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(f"{scratch}/silver/reb")
    assert back.count() == 200000 and back.select("id").distinct().count() == 200000
    files = back.filter(F.col("m") == "2025-08").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(files) >= 4  # the hot month is split over several writers


def test_fixture_dates_ignore_session_time_zone(spark):
    from tiermill.sources.fixture import raw_from_tpch

    base = sorted(r[0] for r in raw_from_tpch(spark, "/root/testdata/sf0.001").select("DT_CARGA").collect())
    keys = ["spark.sql.parquet.inferTimestampNTZ.enabled", "spark.sql.session.timeZone"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        raw = raw_from_tpch(spark, "/root/testdata/sf0.001")
        shifted = sorted(r[0] for r in raw.select("DT_CARGA").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert shifted == base
