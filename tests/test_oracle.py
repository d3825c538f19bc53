"""Every registered query with oracle SQL equals DuckDB on sf0.001."""

import collections
import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from txnlake.plans.oracle import ORACLE_SQL

TABLES = ["customer", "orders", "lineitem", "part", "supplier", "events", "nation", "region"]
KEYS = sorted(ORACLE_SQL)


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 48


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, duck, key):
    df = E.queries()[key](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, rows) == _bag(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["day_utc", "currency", "tx_count", "total_amount"]
    assert df.count() > 0
