"""Layer tables: one folder per layer under a lake root, optional catalog entry."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


#: Most files that a task of the ``local`` layout writes at once; rows of further partition values are sorted.
OPEN_FILES = 128
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

#: Most bytes of stored files that a task reads on the way to the next layer. These files are small for the work their
#: rows make, so the usual 128 MB are a few long tasks, unevenly dealt, with more rows than a task can sort in memory.
TASK_BYTES = 32 * 1024 * 1024
_TASK_BYTES = "spark.sql.files.maxPartitionBytes"


def storage_options(fmt: str) -> dict[str, str]:
    """Of tables without partitions, in few large files: their long text codes are left large by a fast codec."""
    return {"compression": "zstd"} if fmt in ("parquet", "orc") else {}


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Inside, a task keeps a file of each partition value open instead of sorting its rows by them."""
    before = spark.conf.get(_OPEN_FILES, "0")
    spark.conf.set(_OPEN_FILES, str(max(OPEN_FILES, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Inside, a task reads at most :data:`TASK_BYTES` of files, or one file that cannot be split."""
    before = spark.conf.get(_TASK_BYTES)
    spark.conf.set(_TASK_BYTES, str(min(TASK_BYTES, _bytes(before))))
    try:
        yield
    finally:
        spark.conf.set(_TASK_BYTES, before)


def _bytes(size: str) -> int:
    """A size setting (``134217728b``, ``128m``, ``128MB``) as a number of bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) * 1024 ** " kmgtp".index((unit or "b")[0].replace("b", " "))


def ensure_layer(spark: SparkSession, root: str, layer: str) -> None:
    """Create the layer namespace in the session catalog if it is missing."""
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{root.rstrip('/')}/{layer}'"
    )


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    *,
    layout: str = "rebalance",
    max_records_per_file: int | None = None,
) -> str:
    """Full-refresh write of a layer table; re-running gives the same state.

    ``layout`` decides how rows reach the writers of a partitioned table:

    * ``"sorted"``: no shuffle; each task sorts its rows by the partition
      columns and writes one file per partition value, one after the other.
      The files are as many as tasks times values; nothing but the table
      itself is written as long as a task's rows fit in its memory (see
      :func:`small_tasks`).
    * ``"local"``: as ``"sorted"``, but without the sort, with
      :data:`OPEN_FILES` files open at once. For few values: the dictionaries
      of many open files do not fit in a processor's cache, and rows that jump
      between them take twice the time.
    * ``"rebalance"`` (default): one shuffle by the partition columns with Spark's
      ``REBALANCE`` hint; adaptive execution splits a partition value that
      holds a third of all rows into advisory-sized tasks and merges small
      ones, so files come out near ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
      whatever the data size.
    * ``"range"``: range-partition on the partition columns plus a row hash
      into ``spark.sql.shuffle.partitions`` tasks; balanced by sampling, but
      the task count is fixed by the session rather than by the data.

    Never point this at a path the same plan reads; Spark refuses that.
    """
    path = layer_path(root, layer, table)
    out = df
    if partition_by:
        if layout == "rebalance":
            out = out.hint("rebalance", *partition_by)
        elif layout == "range":
            n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
            out = out.repartitionByRange(n, *[F.col(c) for c in partition_by], row_hash)
        elif layout not in ("sorted", "local"):
            raise ValueError(f"unknown layout: {layout}")
        if layout != "local":
            out = out.sortWithinPartitions(*partition_by)
    writer = out.write.mode("overwrite").format(fmt).options(**({} if partition_by else storage_options(fmt)))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with unsorted_writes(df.sparkSession) if partition_by and layout == "local" else nullcontext():
        writer.save(path)
    return path


def read_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    table: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    *,
    recursive: bool = False,
) -> DataFrame:
    """Scan a layer table by path, without a catalog.

    ``recursive`` also reads the batch folders of an unpartitioned table that
    a stream appends to (see :mod:`tiermill.streaming`).

    Pass the layer schema for partitioned tables so that a numeric-looking
    partition value (``202508``) keeps its declared STRING type.
    """
    reader = spark.read.format(fmt)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(layer_path(root, layer, table))


def register_table(
    spark: SparkSession,
    root: str,
    layer: str,
    table: str,
    fmt: str = "parquet",
    partitioned: bool = False,
    recursive: bool = False,
) -> str:
    """Expose a written layer table as ``layer.table`` in the session catalog.

    ``recursive`` includes the batch folders of an unpartitioned table.
    """
    ensure_layer(spark, root, layer)
    name = f"`{layer}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    options = {"recursiveFileLookup": "true"} if recursive else {}
    spark.catalog.createTable(f"{layer}.{table}", path=layer_path(root, layer, table), source=fmt, **options)
    if partitioned:
        spark.catalog.recoverPartitions(f"{layer}.{table}")
    return f"{layer}.{table}"


def list_tables(spark: SparkSession, layer: str) -> list[str]:
    """Names of the tables registered in a layer namespace."""
    return sorted(t.name for t in spark.catalog.listTables(layer))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, as a lazy DataFrame."""
    return df.limit(n)


def read_table(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """Scan a layer table through the session catalog (``layer.table``)."""
    return spark.table(f"`{layer}`.`{table}`")
