"""Every query against its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from quillmark.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows(spark, sql, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    if name not in ORACLES:
        return
    found = sql.sql(ORACLES[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in at) for r in found.fetchall()]
    assert sorted(map(str, rows)) == sorted(map(str, want))
