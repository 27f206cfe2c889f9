"""Every query with SQL gives DuckDB's rows; every other runs. Small tables here, the driver uses larger ones."""

import datetime
import os

import pytest

from eventloom.plans import queries as plain

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(plain.queries()))
def test_query(spark, duck, name):
    df = plain.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    rows = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
    sql = plain.oracle_sql().get(name)
    if not sql:
        assert rows
        return
    got = duck.sql(sql)
    assert sorted(got.columns) == cols
    at = [got.columns.index(c) for c in cols]
    assert rows == sorted(repr([norm(r[i]) for i in at]) for r in got.fetchall())
