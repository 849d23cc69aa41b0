"""Derive a raw beneficiary file from the TPC-H style test tables.

One raw row per ``lineitem`` row, every column text, in the raw layout:
supplier -> operator, nation -> municipality, region -> state,
``p_size`` -> age band, quantities from line quantity / number / part size,
load date and reference month from the ship date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.schemas import MONTH, RAW_COLUMNS
from tiermill.sources.layers import small_tasks

RAW_WRITE_OPTIONS = {
    "header": "true",
    "sep": ";",
    "quote": '"',
    "quoteAll": "true",
    "encoding": "UTF-8",
    # Writing trims padded values unless both are disabled.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Text of repeated codes and names is a sixth of the bytes when compressed; readers tell it by the files' names.
#: A compressed file is read by one task, so files stay small. The fastest level leaves two fifths more bytes than the usual
#: one and makes half the writer's work.
DELIVERY_OPTIONS = {**RAW_WRITE_OPTIONS, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}

#: A dimension of at most so many rows is sent to all tasks; a longer one is joined by a shuffle.
SEND_ROWS = 500_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _age_band(size: Column) -> Column:
    age = size * 2 - 2
    low = age - age % 5
    return (
        F.when(age >= 80, F.lit("80 anos ou mais"))
        .otherwise(F.concat(low.cast("string"), F.lit(" a "), (low + 4).cast("string"), F.lit(" anos")))
    )


def _wall_clock_date(df: DataFrame, name: str, spark: SparkSession) -> Column:
    """Calendar date of a timestamp column as written in the file.

    The test tables store timestamps without a time zone; Spark reads them
    as TIMESTAMP_NTZ by default and the cast is zone-free. If a session reads
    them as local-zone timestamps instead, the instant is shifted back to its
    UTC wall clock first, so the date never depends on the session zone.
    """
    col = F.col(name)
    if dict(df.dtypes)[name] == "timestamp":
        col = F.to_utc_timestamp(col, spark.conf.get("spark.sql.session.timeZone"))
    return col.cast("date")


def _spoil(m: Column, cols: dict[str, Column]) -> dict[str, Column]:
    """Faults that deliveries have, on some of every 23 rows (``m`` is the row's number modulo 23).

    Numbers that are none, overflow, are blank or negative; dates that are
    not ISO or missing; missing ids; accents; unknown and missing bands.
    """
    faults = {
        "QT_BENEFICIARIO_ATIVO": {0: "abc", 1: "99999999999", 2: None, 3: "  ", 4: "-5"},
        "DT_CARGA": {5: "31/12/2024", 6: None},
        "NR_CNPJ": {7: None},
        "NM_MUNICIPIO": {8: F.concat(F.lit("São "), cols["NM_MUNICIPIO"])},
        "DE_FAIXA_ETARIA": {9: "Ignorado", 10: None},
        "QT_BENEFICIARIO_ADERIDO": {11: "12.7"},
    }
    out = dict(cols)
    for name, values in faults.items():
        for k, value in values.items():
            bad = value if isinstance(value, Column) else F.lit(value).cast("string")
            out[name] = F.when(m == k, bad).otherwise(out[name])
    return out


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One narrow row per line with what its raw row is made of: keys, typed values and codes.

    The rows that joins shuffle hold numbers and codes only. Suppliers, of
    which a row needs the key until its text is written, are joined by
    :func:`raw_rows`, as are nations and regions. The other joins are left to
    the size-based planner and AQE.
    """
    t = lambda name: _table(spark, sf_dir, name)
    cust = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = (
        t("orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "c_nationkey", "c_mktsegment")
    )
    line = t("lineitem")
    line = line.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("l_quantity"),
        "l_returnflag", "l_linestatus", _wall_clock_date(line, "l_shipdate", spark).alias("l_shipdate"),
    )
    part = t("part").select("p_partkey", "p_type", "p_size", "p_brand")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        .join(part, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")
    )


def raw_rows(spark: SparkSession, sf_dir: str, lines: DataFrame, dirty: bool = False) -> DataFrame:
    """The raw frame (19 text columns) of :func:`joined_lines`, spoiled by a rule if ``dirty``."""
    t = lambda name: _table(spark, sf_dir, name)
    geo = (
        t("nation")
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    supp = t("supplier").select("s_suppkey", "s_name")
    if supp.count() <= SEND_ROWS:
        supp = F.broadcast(supp)
    joined = (
        lines.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    supp_code = F.col("l_suppkey").cast("string")
    ship = F.col("l_shipdate").cast("string")
    cols = [
        F.lpad(supp_code, 6, "0"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")),
        F.concat(F.lpad(supp_code, 8, "0"), F.lit("000199")),
        F.col("p_type"),
        F.col("r_name"),
        F.col("n_nationkey").cast("string"),
        F.col("n_name"),
        F.col("l_returnflag"),
        _age_band(F.col("p_size")),
        F.col("c_mktsegment"),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
        F.col("p_brand"),
        F.col("l_linestatus"),
        F.col("l_quantity").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("p_size").cast("string"),
        ship,
        F.substring(ship, 1, 7),
    ]
    named = dict(zip(RAW_COLUMNS, cols, strict=True))
    if dirty:
        named = _spoil((F.col("l_orderkey") + F.col("l_linenumber")) % 23, named)
    return joined.select(*[c.alias(n) for n, c in named.items()])


def raw_from_tpch(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """The raw frame (19 text columns) derived from the test tables, spoiled by a rule if ``dirty``."""
    return raw_rows(spark, sf_dir, joined_lines(spark, sf_dir), dirty)


def write_raw_csv(raw: DataFrame, path: str) -> str:
    """Write the raw frame as ``;``-separated, fully quoted, compressed UTF-8 text.

    Each task writes its rows as they are, without a shuffle, in files of
    a bounded number of rows (:data:`DELIVERY_OPTIONS`).
    """
    with small_tasks(raw.sparkSession):
        raw.write.mode("overwrite").options(**DELIVERY_OPTIONS).csv(path)
    return path


def expected_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected leaders for the reference-value checks, straight from the test tables.

    An independent path (no raw file, no layers): the leading supplier,
    age band and nation by summed line quantity, and the number of nations
    with any line. One row with the reference-value columns.
    """
    t = lambda name: _table(spark, sf_dir, name)
    line = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"))
    lead = lambda df, key: df.groupBy(key).agg(F.sum("q").alias("qt"))

    def top(df: DataFrame, order: list[Column], name: Column) -> Column:
        row = df.orderBy(*order).limit(1)
        return row.select(F.struct(name.alias("name"), F.col("qt").cast("long").alias("qt"))).scalar()

    # Lines are summed per part and per order before joining the dimension,
    # so each join sees one row per part / order instead of one per line.
    by_supp = lead(line, "l_suppkey").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    op = top(by_supp, [F.col("qt").desc(), F.col("l_suppkey")], F.trim(F.col("s_name")))
    per_part = lead(line, "l_partkey").withColumnRenamed("qt", "q")
    by_band = lead(
        per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("band", _age_band(F.col("p_size"))),
        "band",
    )
    band = top(by_band, [F.col("qt").desc(), F.col("band")], F.col("band"))
    geo = t("orders").select("o_orderkey", "o_custkey").join(
        t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    per_order = lead(line, "l_orderkey").withColumnRenamed("qt", "q")
    by_nation = (
        lead(per_order.join(geo, F.col("l_orderkey") == F.col("o_orderkey")), "c_nationkey")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    nat = top(by_nation, [F.col("qt").desc(), F.col("c_nationkey").cast("string")], F.col("n_name"))
    # each leader is attached once as a column, then its fields are read
    leaders = by_nation.agg(F.count(F.lit(1)).alias("_n")).select("_n", op.alias("op"), band.alias("band"), nat.alias("nat"))
    return leaders.select(
        F.col("op.name").alias("top_operadora_nome"),
        F.col("op.qt").alias("top_operadora_qt"),
        F.col("band.name").alias("top_faixa"),
        F.col("band.qt").alias("top_faixa_qt"),
        F.col("nat.name").alias("top_muni"),
        F.col("nat.qt").alias("top_muni_qt"),
        F.col("_n").cast("long").alias("qt_municipios"),
    )
