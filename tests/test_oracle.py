"""Every registered query against its DuckDB twin on the smallest driver tables."""

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = sorted(set(E.catalog.queries()) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("key", sorted(E.catalog.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    temporal = [c for c, t in df.dtypes if t == "date" or t.startswith("timestamp")]
    assert temporal == [], f"add {temporal} to catalog.TEMPORAL"
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns
