from datetime import datetime

import pytest

from eventloom.operators import graph
from eventloom.sources import pages
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


def test_pages(spark, tmp_path):
    rows = [("a", "A & <b>", "d", datetime(2026, 8, 2, 12), "music", ["https://x.y"]), ("b", "B", None, datetime(2026, 8, 3, 12), "music", ["https://x.y"]), ("bad id", "C", None, datetime(2026, 8, 3), "music", ["u"]), ("c", "C", None, datetime(2026, 8, 3), "talk", [])]
    e = spark.createDataFrame(rows, "id string, title string, description string, starts_at timestamp, category string, action_links array<string>")
    got = {r.path: r.html for r in pages.event_pages(e).collect()}
    assert set(got) == {"events/a/index.html", "events/b/index.html"}
    assert "A &amp; &lt;b&gt;" in got["events/a/index.html"] and "2026-08-02 21:00 JST" in got["events/a/index.html"] and "/events/a/" in got["events/b/index.html"]
    hubs = pages.hub_pages(e, "category", 2)
    assert [r.path for r in hubs.collect()] == ["category/music/index.html"]
    edges = graph.link_edges(pages.event_pages(e), F.col("path"), "html", F.lit("https://s"))
    assert {r.dst for r in edges.collect()} == {"https://x.y", "https://s/events/a/", "https://s/events/b/"}
    pages.write_pages(hubs, str(tmp_path / "out"))
    assert (tmp_path / "out/category/music/index.html").read_text() == hubs.first().html
    with pytest.raises(PySparkException):
        pages.write_pages(spark.createDataFrame([("../x.html", "h")], "path string, html string"), str(tmp_path / "out"))
    assert not (tmp_path / "x.html").exists()
    assert [r.id for r in pages.preview(e, 2).collect()] == ["a", "bad id"]
