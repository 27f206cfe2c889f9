"""Queries on tables whose values repeat, or are null, as they do in larger copies."""

import pytest

from eventloom.plans import queries as plain


def against_sql(spark, tmp_path, name, table, rows, schema):
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.sql(plain.oracle_sql()[name])
    got = plain.queries()[name](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall())) and got


def test_null_out_failed_with_shared_addresses(spark, tmp_path):
    rows = [(i, f"https://h.example/{i % 3}" if i % 7 else None, "") for i in range(24)]
    against_sql(spark, tmp_path, "null_out_failed", "pages", rows, "page_id long, url string, html string")


def test_page_tags_with_other_references(spark, tmp_path):
    titles = ["a &amp;&lt;b&gt; &amp;lt;", "cut &amp", "token = &quot;73ab", "&#65; &nbsp; &eacute;", "&", "", "&amp;amp; &ampx;"]
    rows = [(i, "u", f"<html><title>{t}</title><a href=\"/x?a=1&amp;b=2\">&lt;</a><a href=\"/&y\">y</a></html>") for i, t in enumerate(titles)]
    against_sql(spark, tmp_path, "page_tags", "pages", [*rows, (90, "u", None), (91, "u", ""), (92, "u", "no title")], "page_id long, url string, html string")
