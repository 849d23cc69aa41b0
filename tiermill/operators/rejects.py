"""Rows of a delivery that cannot be refined, with the column and the reason.

The rules are those of silver's casts, so what is accepted here has every
value in silver. A missing value is no fault of this kind (the typing checks
count those).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tiermill.functions.text import blank, lenient_date, lenient_int
from tiermill.schemas import QUANTITY_PAIRS, RAW_COLUMNS, RAW_SCHEMA
from tiermill.sources.raw_csv import read_raw

#: Raw line of a row whose number of fields is not that of the header.
BROKEN_LINE = "_linha_quebrada"
DATE = "DT_CARGA"


def read_with_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The raw file(s), and for rows with too few or too many fields the line as it stands."""
    schema = StructType([*RAW_SCHEMA.fields, StructField(BROKEN_LINE, StringType())])
    return read_raw(spark, path, schema, corrupt_record_column=BROKEN_LINE)


def faults(raw: DataFrame) -> Column:
    """Array of (coluna, motivo, valor), empty for a row without fault."""

    def one(when: Column, column: str, why: Column | str, value: str) -> Column:
        fault = F.struct(F.lit(column).alias("coluna"), (F.lit(why) if isinstance(why, str) else why).alias("motivo"), F.col(value).alias("valor"))
        return F.when(when, fault)

    kinds = [F.when(blank(F.col(bronze)), "em branco").otherwise("nao inteiro") for _, bronze in QUANTITY_PAIRS]
    found = [
        one(F.col(bronze).isNotNull() & lenient_int(bronze).isNull(), bronze, why, bronze)
        for (_, bronze), why in zip(QUANTITY_PAIRS, kinds, strict=True)
    ]
    why = F.when(blank(F.col(DATE)), "em branco").otherwise("nao e data")
    found.append(one(F.col(DATE).isNotNull() & lenient_date(DATE).isNull(), DATE, why, DATE))
    if BROKEN_LINE in raw.columns:
        found.append(one(F.col(BROKEN_LINE).isNotNull(), "*", "numero de campos", BROKEN_LINE))
    return F.array_compact(F.array(*found))


def split(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of one pass over the raw rows.

    Accepted rows have the raw columns; rejected ones as well, and a row for
    each fault with ``coluna``, ``motivo`` and ``valor``.
    """
    marked = raw.withColumn("_faults", faults(raw))
    accepted = marked.filter(F.size("_faults") == 0).select(*RAW_COLUMNS)
    rejected = marked.select(*RAW_COLUMNS, F.inline("_faults"))
    return accepted, rejected
