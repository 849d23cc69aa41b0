"""Incremental bronze ingestion of raw files as they are delivered.

A file-source stream over the delivery folder, run with
``trigger(availableNow=True)``: every run ingests exactly the files that
arrived since the last run (tracked in the checkpoint), then stops. Each
micro-batch overwrites a folder of its own inside the bronze table, named
after the checkpoint and the batch, so a batch that is run again after a
failure replaces itself, and rows written by other loads (a batch load, other
streams) stay readable beside it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiermill.schemas import INGESTED_AT, RAW_SCHEMA, SOURCE_FILE
from tiermill.sources.layers import small_tasks, storage_options
from tiermill.sources.raw_csv import RAW_OPTIONS


def raw_stream(spark: SparkSession, in_dir: str, schema: StructType = RAW_SCHEMA, **options: str) -> DataFrame:
    """Streaming scan of the delivery folder with the raw-file options."""
    opts = {**RAW_OPTIONS, **options}
    return spark.readStream.schema(schema).options(**opts).csv(in_dir)


def stream_ingest(
    spark: SparkSession,
    in_dir: str,
    out_path: str,
    checkpoint: str,
    *,
    schema: StructType = RAW_SCHEMA,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    **source_options: str,
) -> str:
    """Append the newly delivered raw files to a bronze table and stop.

    The table is read with its batch folders (``read_layer(recursive=True)``,
    as ``load_bronze`` does). A full refresh of bronze replaces them all.

    ``archive_dir`` moves each ingested file there once its batch commits
    (``cleanSource=archive``), so the delivery folder the source lists on
    every run stays small however many months have been loaded. Other file
    source options (``latestFirst``, ``maxFileAge``...) pass through.
    """
    opts = dict(source_options)
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if archive_dir:
        opts["cleanSource"] = "archive"
        opts["sourceArchiveDir"] = archive_dir
    stream = raw_stream(spark, in_dir, schema, **opts)
    bronze = stream.select(
        "*",
        F.current_timestamp().alias(INGESTED_AT),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
    )
    tag = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def append(batch: DataFrame, number: int) -> None:
        with small_tasks(batch.sparkSession):
            batch.write.mode("overwrite").format(fmt).options(**storage_options(fmt)).save(f"{out_path.rstrip('/')}/stream-{tag}-{number}")

    query = (
        bronze.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return out_path
