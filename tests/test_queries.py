"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sentinela.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    from decimal import Decimal
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def rows(cols, it):
    return sorted((tuple(norm(r[c]) for c in cols) for r in it), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pct_fraude" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = rows(cols, [r.asDict() for r in df.collect()])
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    want = rows(cols, [dict(zip(rel.columns, r)) for r in rel.fetchall()])
    assert got == want
