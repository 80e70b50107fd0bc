"""Driver contract: entry() smoke run and every oracle query on sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "last_test_result" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = _digest(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want
