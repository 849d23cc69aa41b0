"""Every registered query against its DuckDB oracle on the smallest tables.

The same contract the driver checks at sf0.01: equal column names, column
types, row counts and (order-insensitive) values.
"""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.support import SF_SMALL

TABLES = sorted(f[: -len(".parquet")] for f in os.listdir(SF_SMALL) if f.endswith(".parquet"))
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    assert len(got) == len(expected)
    assert _rows(df.columns, got) == _rows(cols, expected)
