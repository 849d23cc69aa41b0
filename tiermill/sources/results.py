"""Named-result files: ordered CSV export and typed, position-aware re-read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Values come back as they were: white space, quotes (doubled, as other readers expect), empty text and NULL.
RESULT_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "emptyValue": "",
}

# Columns used to recover the written order of a multi-part result folder.
_PART = "_tm_file_part"
_BLOCK = "_tm_file_block"
_LINE = "_tm_file_line"


def result_path(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def export_result(
    df: DataFrame, out_dir: str, name: str, *, single_file: bool = False
) -> str:
    """Write a (sorted) result as CSV with a header, keeping its order.

    The write is distributed: a globally sorted frame is range-partitioned,
    so ``part-00000``, ``part-00001``... hold consecutive slices of the order.
    ``single_file=True`` funnels the rows through one writer for a single
    readable file; use it only for results whose size is bounded (top-k).
    """
    out = df.coalesce(1) if single_file else df
    path = result_path(out_dir, name)
    out.write.mode("overwrite").options(**{**RESULT_OPTIONS, "emptyValue": '""'}).csv(path)
    return path


def read_result(
    spark: SparkSession,
    out_dir: str,
    name: str,
    schema: StructType,
    *,
    keep_order_columns: bool = False,
) -> DataFrame:
    """Re-read an exported result with its declared schema.

    The explicit schema keeps codes such as ``006246`` as text (inference
    would turn them into numbers). With ``keep_order_columns`` the frame also
    carries (part number, block start, line id) whose ascending order is the
    order the rows were written in; see :func:`written_order`.
    """
    df = spark.read.schema(schema).options(**RESULT_OPTIONS).csv(result_path(out_dir, name))
    if not keep_order_columns:
        return df
    return df.select(
        "*",
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
        .cast("long")
        .alias(_PART),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_LINE),
    )


def written_order() -> list:
    """Sort key reproducing the written order of a frame from ``read_result``."""
    return [F.col(_PART), F.col(_BLOCK), F.col(_LINE)]


def drop_order_columns(df: DataFrame) -> DataFrame:
    return df.drop(_PART, _BLOCK, _LINE)


def read_result_positions(
    spark: SparkSession, out_dir: str, name: str, schema: StructType, position: str = "posicao"
) -> DataFrame:
    """Re-read an exported result with each row's 1-based position in the file order.

    Lazy and deterministic: the order key is (part number, split start,
    line id) read from the files themselves. Line ids run on inside a file
    split (one split is what one task reads), so a row's place in its split is
    its id less the split's first; per-split counts, one row per split, give
    the splits' offsets.
    """
    df = read_result(spark, out_dir, name, schema, keep_order_columns=True)
    splits = df.groupBy(_PART, _BLOCK).agg(F.count(F.lit(1)).alias("_tm_n"), F.min(_LINE).alias("_tm_first"))
    before = Window.orderBy(_PART, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_tm_n").over(before), F.lit(0)) - F.col("_tm_first") + 1
    return (
        df.join(splits.select(_PART, _BLOCK, shift.alias("_tm_shift")), [_PART, _BLOCK])
        .withColumn(position, (F.col(_LINE) + F.col("_tm_shift")).cast("long"))
        .drop(_PART, _BLOCK, _LINE, "_tm_shift")
    )
