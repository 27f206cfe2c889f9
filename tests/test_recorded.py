"""Paged responses, dated reports, calendars in splits."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.sources import readers, recorded, reports, sinks


def put(folder, request, pages):
    (folder / request).mkdir(parents=True, exist_ok=True)
    for k, (asked, response) in pages.items():
        (folder / request / f"{k:04d}.json").write_text(json.dumps({"request": asked, "response": response}))


def cursor_pages(n, per=3):
    return {k: ({"nextCursor": f"c{k}"} if k else {}, {"results": [{"id": f"{k}-{i}"} for i in range(per)] + ["no object"], "nextCursor": f"c{k + 1}" if k < n - 1 else ""}) for k in range(n)}


def rows(spark, folder, **options):
    recorded.register(spark)
    return [(r.request, r.page, r.place, json.loads(r.item)) for r in spark.read.format("recorded_pages").options(path=str(folder), **options).load().orderBy("request", "page", "place").collect()]


def test_pages_of_requests(spark, tmp_path):
    put(tmp_path, "a", cursor_pages(3))
    put(tmp_path, "b", cursor_pages(1, 1))
    (tmp_path / "a" / "_note.json").write_text("no page")
    want = [("a", k, i, {"id": f"{k}-{i}"}) for k in range(3) for i in range(3)] + [("b", 0, 0, {"id": "0-0"})]
    assert rows(spark, tmp_path) == want
    df = spark.read.format("recorded_pages").option("path", str(tmp_path)).load()
    assert df.rdd.getNumPartitions() == 2


def test_offsets_and_rows(spark, tmp_path):
    put(tmp_path / "o", "t", {0: ({"n": 2}, {"results": [{"i": 0}, {"i": 1}], "hasNext": True}), 1: ({"n": 2, "offset": 2}, {"results": [{"i": 2}], "hasNext": True})})
    assert [r[3]["i"] for r in rows(spark, tmp_path / "o", chain="offset")] == [0, 1, 2]
    put(tmp_path / "r", "q", {0: ({"startRow": 0, "rowLimit": 2}, {"rows": [{"i": 0}, {"i": 1}]}), 1: ({"startRow": 2, "rowLimit": 2}, {})})
    assert [r[3]["i"] for r in rows(spark, tmp_path / "r", chain="rows", items="rows")] == [0, 1]


@pytest.mark.parametrize("case", ["gap", "open end", "after the end", "too many", "no list", "no object"])
def test_broken_chains_raise(spark, tmp_path, case):
    pages = cursor_pages(3)
    options = {}
    if case == "gap":
        del pages[1]
    elif case == "open end":
        del pages[2]
    elif case == "after the end":
        pages[3] = ({"nextCursor": "c3"}, {"results": []})
    elif case == "too many":
        options = {"max_pages": "2"}
    elif case == "no list":
        pages[2] = (pages[2][0], {"results": {"a": 1}})
    else:
        pages[2] = (pages[2][0], [])
    put(tmp_path, "a", pages)
    with pytest.raises(PySparkException):
        rows(spark, tmp_path, **options)


def test_pages_as_a_stream(spark, tmp_path):
    recorded.register(spark)
    put(tmp_path / "in", "a", dict(list(cursor_pages(3).items())[:1]))
    at = str(tmp_path / "checkpoint")

    def run():
        q = spark.readStream.format("recorded_pages").option("path", str(tmp_path / "in")).load().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", at).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        return spark.read.schema(recorded.SCHEMA).parquet(str(tmp_path / "out")).count()

    assert run() == 3
    put(tmp_path / "in", "a", cursor_pages(3))
    put(tmp_path / "in", "b", cursor_pages(1, 2))
    assert run() == 11
    assert run() == 11


def test_dated_and_latest_report(spark, tmp_path):
    df = spark.range(10).select("id", F.concat(F.lit("é"), "id").alias("name"), F.array("id").alias("list")).repartition(3)
    path = str(tmp_path)
    reports.write_report(df, path, "2026-08-20")
    assert (tmp_path / "2026-08-20.json").read_bytes() == (tmp_path / "latest.json").read_bytes()
    m = reports.manifest(path)
    assert m["rows"] == 10 and sum(f["rows"] for f in m["files"]) == 10
    import hashlib

    assert all(hashlib.sha256((tmp_path / f["name"]).read_bytes()).hexdigest() == f["sha256"] for f in m["files"])
    assert sorted(tuple(r) for r in reports.read_report(spark, path).collect()) == [(i, f"é{i}", [i]) for i in range(10)]
    reports.write_report(df.limit(0), path, "2026-08-21")
    assert reports.read_report(spark, path).count() == 0 and reports.read_report(spark, path, "2026-08-20").count() == 10


def test_a_failing_task_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    reports.write_report(spark.range(4), path, "a")
    before = {p: p.read_bytes() for p in tmp_path.rglob("*.json")}
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        reports.write_report(bad, path, "b")
    assert {p: p.read_bytes() for p in tmp_path.rglob("*.json")} == before
    for stamp in ("", "latest", "../x"):
        with pytest.raises((PySparkException, ValueError)):
            reports.write_report(spark.range(1), path, stamp)


def test_calendar_in_splits(spark, tmp_path):
    events = "".join(f"BEGIN:VEVENT\r\nUID:u{i}\r\nSUMMARY:Title {i}\\, x\r\n and more\r\nDTSTART:202608{i % 28 + 1:02d}T120000Z\r\nEND:VEVENT\r\n" for i in range(5000))
    (tmp_path / "a.ics").write_bytes(f"BEGIN:VCALENDAR\r\nX-WR-CALNAME:Nights\r\nX-WR-TIMEZONE:Asia/Tokyo\r\n{events}END:VCALENDAR\r\n".encode())
    (tmp_path / "b.ics").write_bytes(b"BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:w\r\nDTSTART;VALUE=DATE:20260801\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nUID:none\r\nEND:VEVENT\r\nEND:VCALENDAR")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        records = readers.ics_records(spark, str(tmp_path))
        assert spark.read.option("lineSep", "END:VEVENT").text(str(tmp_path)).rdd.getNumPartitions() > 4
        got = readers.ics_events(records.drop("file"), "value")
        plain = readers.ics_events(spark.read.text(str(tmp_path), wholetext=True), "value")
        assert sorted(map(repr, got.drop("calendar_name", "calendar_zone").collect())) == sorted(map(repr, plain.collect()))
        assert {(r.calendar_name, r.calendar_zone, r.n) for r in got.groupBy("calendar_name", "calendar_zone").agg(F.count("*").alias("n")).collect()} == {("Nights", "Asia/Tokyo", 5000), (None, None, 1)}
        assert records.agg(F.max(F.length("value"))).first()[0] < 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_calendar_of_one_event(spark):
    rows = [("a1", "T, x", "é" * 60, "2026-08-01 12:00:00", "2026-08-01 13:00:00"), ("b", "U", " ", "2026-08-02 12:00:00", None)]
    e = spark.createDataFrame(rows, "id string, title string, description string, s string, e string").withColumns({"starts_at": F.col("s").cast("timestamp"), "ends_at": F.col("e").cast("timestamp")})
    text = {r.id: r.t for r in e.select("id", sinks.event_calendar(e, "https://h.example", "h.example", "-//x//EN", F.lit("2026-07-01 00:00:00").cast("timestamp")).alias("t")).collect()}
    assert text["b"].split("\r\n") == ["BEGIN:VCALENDAR", "VERSION:2.0", "PRODID:-//x//EN", "CALSCALE:GREGORIAN", "BEGIN:VEVENT", "UID:b@h.example", "DTSTAMP:20260701T000000Z", "DTSTART:20260802T120000Z", "SUMMARY:U", "URL:https://h.example/events/b/", "END:VEVENT", "END:VCALENDAR", ""]
    assert all(len(line.encode()) <= 75 for line in text["a1"].split("\r\n")) and "\r\n é" in text["a1"]
    back = readers.ics_events(spark.createDataFrame([(text["a1"],)], "value string"), "value").first()
    assert (back.uid, back.title, back.description) == ("a1@h.example", "T, x", "é" * 60)


def test_sources_read_whole_files(spark, tmp_path):
    """Pages and calendars of many lines, by their configuration."""
    (tmp_path / "p.html").write_text('<html>\n<script type="application/ld+json">\n{"@type": "Event",\n "name": "N", "startDate": "2026-08-02T21:30:00+09:00"}\n</script>\n<script id="__NEXT_DATA__">\n{"id": "12",\n "text": "t"}</script>')
    (tmp_path / "c.ics").write_bytes(b"BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:w\r\nSUMMARY:S\r\nDTSTART:20260801T000000Z\r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    got = {kind: readers.collect(spark, {"type": kind, "name": "n", "path": str(tmp_path / name)}).first() for kind, name in (("jsonld", "p.html"), ("posts", "p.html"), ("ics", "c.ics"))}
    assert (got["jsonld"].title, got["posts"].status_id, got["ics"].title, got["ics"].source) == ("N", "12", "S", "n")
