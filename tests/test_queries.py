"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import decimal
import datetime as dt

import duckdb
import pytest

import __spark_entry__ as se
from bundleflow.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float | decimal.Decimal):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "NULL" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["resourceType", "cnt"] and df.count() == 3


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    oracle = se.oracle_sql().get(name)
    if oracle is None:
        assert got is not None
        return
    res = con.execute(oracle)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())
