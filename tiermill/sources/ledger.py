"""A ledger of delivered files by content, so that a file delivered again is known under any name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.schemas import RAW_COLUMNS
from tiermill.session import cut_lineage
from tiermill.sources.layers import small_tasks
from tiermill.sources.raw_csv import read_raw

LEDGER = "_ledger/deliveries"
LEDGER_SCHEMA = "arquivo string, n_linhas long, impressao_1 decimal(38,0), impressao_2 decimal(38,0)"
CONTENT = ["n_linhas", "impressao_1", "impressao_2"]


def fingerprints(raw: DataFrame) -> DataFrame:
    """(arquivo, n_linhas, impressao_1, impressao_2) of each file behind a raw frame.

    Two sums of 64-bit row hashes: the order of rows and of splits does not
    matter, repeated rows count each time, and each task sends one row a file.
    """
    row = lambda salt: F.xxhash64(F.lit(salt), *[F.col(c) for c in RAW_COLUMNS]).cast("decimal(38,0)")
    return raw.groupBy(F.col("_metadata.file_path").alias("arquivo")).agg(
        F.count(F.lit(1)).alias("n_linhas"), F.sum(row(1)).cast("decimal(38,0)").alias("impressao_1"),
        F.sum(row(2)).cast("decimal(38,0)").alias("impressao_2"))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every file loaded so far; empty for a lake without any."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root.rstrip('/')}/{LEDGER}")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err) and "Path does not exist" not in str(err):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def sort_out(spark: SparkSession, raw_path: str | list[str], root: str) -> DataFrame:
    """(arquivo, n_linhas, impressao_1, impressao_2, situacao, igual_a) of the delivered files.

    ``situacao`` is ``nova`` or ``repetida``; of equal files in one delivery
    the first by name is new. ``igual_a`` names the file that was first.
    """
    found = fingerprints(read_raw(spark, raw_path))
    known = ledger(spark, root).groupBy(*CONTENT).agg(F.min("arquivo").alias("conhecida"))
    alike = Window.partitionBy(*CONTENT).orderBy("arquivo")
    first = F.first("arquivo").over(alike)
    same = F.coalesce("conhecida", F.when(first != F.col("arquivo"), first))
    return found.join(known, CONTENT, "left").select(
        "arquivo", *CONTENT, F.when(same.isNull(), F.lit("nova")).otherwise(F.lit("repetida")).alias("situacao"), same.alias("igual_a"))


def load_new(spark: SparkSession, raw_path: str | list[str], root: str, load) -> DataFrame:
    """Load the files of a delivery that were not loaded before; returns the report of :func:`sort_out`.

    ``load`` is called with the raw frame of the new files (not at all if there
    is none). The ledger is written after it, so a load that fails is made
    again by the next delivery. One row a file comes to the driver.
    """
    with small_tasks(spark):
        report = cut_lineage(sort_out(spark, raw_path, root))
    new = report.filter(F.col("situacao") == "nova")
    files = [r[0] for r in new.select("arquivo").orderBy("arquivo").collect()]
    if files:
        with small_tasks(spark):
            load(read_raw(spark, files))
        new.select("arquivo", *CONTENT).write.mode("append").parquet(f"{root.rstrip('/')}/{LEDGER}")
    return report
