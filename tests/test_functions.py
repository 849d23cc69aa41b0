import datetime

from pyspark.sql import functions as F

from tiermill.functions import (
    accent_insensitive_equal,
    blank,
    format_percent,
    format_thousands,
    lenient_date,
    lenient_int,
    mask_id,
    visible_digits,
)


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_mask_keeps_root_and_propagates_null(spark):
    out = one_col(spark, ["12345678000199", "123", None], mask_id)
    assert out == ["12345678******", "123******", None]


def test_lenient_int_edge_rows(spark):
    out = one_col(spark, ["", "abc", "99999999999", "12.7", " 12 ", "7", None], lenient_int)
    assert out == [None, None, None, None, 12, 7, None]


def test_lenient_date(spark):
    out = one_col(spark, ["2025-08-31", "31/08/2025", "2025-08", None], lenient_date)
    assert out == [datetime.date(2025, 8, 31), None, datetime.date(2025, 8, 1), None]


def test_blank_and_trim_keeps_tabs(spark):
    assert one_col(spark, ["", "  ", None, " x "], blank) == [True, True, True, False]
    assert one_col(spark, ["  x\t"], F.trim) == ["x\t"]


def test_visible_digits(spark):
    assert one_col(spark, ["12345678******", "1a2******", None], visible_digits) == [8, 2, None]


def test_format_thousands_and_percent(spark):
    df = spark.createDataFrame([(1524135, 31.254), (0, 0.0), (999, 100.0), (12, 31.25), (7, 0.15)], "n long, p double")
    rows = df.select(format_thousands("n"), format_percent("p", 2), format_percent("p", 1)).collect()
    assert [tuple(r) for r in rows] == [
        ("1.524.135", "31,25%", "31,3%"),
        ("0", "0,00%", "0,0%"),
        ("999", "100,00%", "100,0%"),
        ("12", "31,25%", "31,2%"),  # a tie goes to the even digit
        ("7", "0,15%", "0,1%"),  # 0.15 is a little less in binary
    ]


def test_accent_insensitive_equal_keeps_case(spark):
    df = spark.createDataFrame([("São Paulo", "Sao Paulo"), ("São Paulo", "sao paulo")], "a string, b string")
    assert [r[0] for r in df.select(accent_insensitive_equal("a", "b")).collect()] == [True, False]
