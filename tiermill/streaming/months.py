"""Deliveries that reach silver and gold by stream: each month in a micro-batch replaces the stored one."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiermill.operators.layers import to_silver
from tiermill.plans.medallion import BRONZE, SILVER, _overwrite_partitions, publish, refresh_gold_months
from tiermill.schemas import INGESTED_AT, MONTH, RAW_SCHEMA, SOURCE_FILE
from tiermill.sources.layers import layer_path, small_tasks, storage_options
from tiermill.streaming.ingest import raw_stream


def stream_months(
    spark: SparkSession, in_dir: str, root: str, checkpoint: str, *, out_dir: str | None = None,
    schema: StructType = RAW_SCHEMA, fmt: str = "parquet", max_files_per_trigger: int | None = None,
) -> str:
    """Load the newly delivered files into bronze, silver and gold, and stop.

    A micro-batch goes to a bronze folder of its own, which a repeated batch
    overwrites. Every month that it holds replaces that month in silver
    (other months are not touched or read), and the golds are merged from the
    sums by month, of which only the batch's months are made anew. A month
    must arrive whole in one batch: without ``max_files_per_trigger`` all files
    that are there are one batch, and a later one corrects the month. With
    ``out_dir`` results are published after each batch.
    """
    options = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else {}
    bronze = raw_stream(spark, in_dir, schema, **options).select(
        "*", F.current_timestamp().alias(INGESTED_AT), F.col("_metadata.file_path").alias(SOURCE_FILE))
    tag = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        place = f"{layer_path(root, *BRONZE)}/stream-{tag}-{number}"
        with small_tasks(batch.sparkSession):
            batch.write.mode("overwrite").format(fmt).options(**storage_options(fmt)).save(place)
        rows = to_silver(spark.read.format(fmt).load(place))
        months = [r[0] for r in rows.select(MONTH).distinct().collect()]
        if not months:
            return
        with small_tasks(spark):
            _overwrite_partitions(rows, layer_path(root, *SILVER), [MONTH], fmt)
        refresh_gold_months(spark, root, months, fmt)
        if out_dir:
            publish(spark, root, out_dir, fmt)

    query = (
        bronze.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return layer_path(root, *SILVER)
