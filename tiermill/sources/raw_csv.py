"""Scan of the raw beneficiary file: header, ``;``, ``"``, UTF-8, all text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# --- fixed values: format of the raw file ---
RAW_OPTIONS = {
    "header": "true",
    "sep": ";",
    "quote": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    # every file's header must name the schema's columns in their order
    "enforceSchema": "false",
}


class SourceNotFound(FileNotFoundError):
    """Raised before any work starts when the raw input path does not exist."""


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    *,
    corrupt_record_column: str | None = None,
    **options: str,
) -> DataFrame:
    """Read the raw delimited file(s) as text columns.

    Without ``schema`` the column names come from the header line and every
    column is a string (no inference pass over the data). Short rows are
    padded with NULL, extra fields are dropped, blank lines are skipped. A
    file whose header differs from the others' (or from ``schema``) is an
    error when it is read, not a swap of columns.
    A missing path raises :class:`SourceNotFound` on any file system.
    """
    reader = spark.read.options(**{**RAW_OPTIONS, **options})
    if corrupt_record_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_record_column)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.csv(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
            raise SourceNotFound(f"raw source not found: {path}") from err
        raise
