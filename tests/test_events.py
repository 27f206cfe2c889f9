"""Events, links, ledger re-evaluation, read model and command line."""

import json
from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from eventloom import cli
from eventloom.operators import events as ev
from eventloom.operators import ledger, links, rules
from eventloom.readmodel import ReadModel


def test_build(spark):
    raw = spark.createDataFrame([("1", "  A　b ", "2026-08-02T21:00:00", "2026-08-02T20:00:00", ("Org",), ["x", " x", ""]), ("2", None, "2026-08-02T21:00:00", None, None, None), ("3", "t", "soon", None, None, None)], "uid string, name string, start string, end string, host struct<name:string>, tags array<string>")
    got = {r.source_id: r for r in ev.build(raw, "s", F.lit("2026-08-01").cast("timestamp")).collect()}
    a = got["1"]
    assert (a.title, str(a.starts_at), a.organizer, a.tags, a.confidence, a.review_required, a.error) == ("A b", "2026-08-02 12:00:00", "Org", ["x"], 0.3, True, None)
    assert got["2"].error == "event has no title" and got["3"].error == "event has no start time"


def test_posts(spark):
    posts = spark.createDataFrame([("9", "8/19 22:30 event", datetime(2026, 8, 1), "me"), ("8", "1月5日 21時 event", datetime(2026, 12, 20), None), ("7", "no date", datetime(2026, 8, 1), None)], "id string, text string, created_at timestamp, author string")
    got = {r.id: r for r in ev.posts_to_events(posts).collect()}
    assert str(got["9"].starts_at) == "2026-08-19 13:30:00" and got["9"].url == "https://x.com/me/status/9"
    assert str(got["8"].starts_at) == "2027-01-05 12:00:00" and "7" not in got


def test_public_calendar(spark):
    schema = "id string, title string, startsAt string, endsAt string, ownerId string, description string, imageUrl string, category string, tags array<string>, languages array<string>, platforms array<string>, featured boolean, isDraft boolean, deletedAt string, accessType string"
    rows = [("cal_1", "t", "2026", None, "o", None, None, "music", ["a"], ["ja"], None, True, False, None, "public"), ("cal_2", "t", "2026", None, None, None, None, None, None, None, None, None, True, None, "public"), ("x", "t", "2026", None, None, None, None, None, None, None, None, None, False, None, "public")]
    got = ev.public_calendar(spark.createDataFrame(rows, schema)).collect()
    assert [r.source_id for r in got] == ["cal_1"] and "featured" in got[0].tags and "ja" in got[0].tags


def test_links(spark):
    e = spark.createDataFrame([(1, "https://x.com/a/status/1", "see https://forms.gle/q). and https://t.co/z https://example.org/w")], "id int, url string, description string")
    u = links.resolved(links.source_urls(e, "id", ["url"], ["description"]), spark.createDataFrame([("https://t.co/z", "https://discord.gg/k")], "url string, target string"))
    r = links.summary(links.ranked(u, "id"), "id").first()
    assert [x.kind for x in r.official_links] == ["application", "announcement"] and [x.kind for x in r.related_links] == ["community", "related_web"]
    assert r.primary_action_url == "https://forms.gle/q"


def test_reevaluate(spark):
    old = str((1785000000000 - 1288834974657) << 22)  # posted 2026-07-25
    new = str((1785542400000 - 1288834974657) << 22)  # posted 2026-08-01
    h = spark.createDataFrame([(old, "VRChat 集会 本日 22:30 開催します", 10, datetime(2026, 7, 26)), (new, "VRChat 集会 8月19日22:30 開催します", 10, datetime(2026, 8, 1))], "status_id string, text string, retweet_count bigint, first_seen timestamp")
    now = F.lit("2026-08-02 08:00:00").cast("timestamp")
    got = {r.status_id: (r.last_decision, r.last_reason) for r in ledger.reevaluate(h, now, rules.RuleSet()).collect()}
    assert got[old] == ("rejected", "past_event_now") and got[new] == ("accepted", None)
    kept = {r.status_id: (r.last_decision, r.temporal_status, r.is_archived) for r in ledger.archive(h.withColumn("retweet_count", F.lit(0)), now, rules.RuleSet()).collect()}
    assert kept[old] == ("accepted", "past", True) and kept[new] == ("accepted", "upcoming", False)


def test_occurrence_id(spark):
    a = lambda *x: F.array(*(F.lit(v) for v in x)).cast("array<string>")
    make = lambda **k: ev.occurrence_id(F.lit("s"), k.get("urls", a()), k.get("texts", a()), k.get("orgs", a()), k.get("nth", a()), k.get("why", a()), a("m2", "m1"), k.get("existing", a()))
    r = spark.range(1).select(make(existing=a("occ_x")).alias("a"), make(urls=a("u"), why=a("same_canonical_url")).alias("b"), make(urls=a("u")).alias("c"), make(orgs=a("o"), nth=a("4")).alias("d")).first()
    assert r.a == "occ_x" and len({r.b, r.c, r.d}) == 3 and all(x.startswith("occ_") and len(x) == 24 for x in (r.b, r.c, r.d))


def test_read_model(spark):
    e = spark.createDataFrame([("a", "Song night", "music", "s1", datetime(2026, 8, 2, 16)), ("b", "Talk", "talk", None, datetime(2026, 8, 2, 10))], "id string, title string, category string, ontology_id string, starts_at timestamp")
    series = spark.createDataFrame([("s1", "Song")], "canonical_id string, canonical_name string")
    health = spark.createDataFrame([("x", 2)], "name string, count long")
    m = ReadModel(e, series, health, health, datetime(2026, 8, 1, tzinfo=UTC), datetime(2026, 8, 1, 0, 1, tzinfo=UTC))
    assert [x["id"] for x in m.search_events("SONG")["items"]] == ["a"]
    assert m.search_events(series_id="s1")["total"] == 1 and m.search_events(end_at=datetime(2026, 8, 2, 16))["total"] == 1
    assert [x["id"] for x in m.get_tonight_events(date(2026, 8, 3))["items"]] == ["a"]
    assert m.get_event("b")["read_model_provenance"]["null_reasons"]["ontology_id"] and m.get_event("zz") is None
    assert m.get_event("a")["read_model_provenance"]["freshness_seconds"] == 60
    assert m.get_data_quality()["event_count_matches_health"] and m.get_series("s1")["canonical_name"] == "Song"


def test_cli(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps([{"id": "1", "title": "A", "start": "2026-08-02T21:00:00"}, {"id": "1", "title": "A", "start": "2026-08-02T21:00:00"}, {"id": "2", "title": "Old", "start": "2020-01-01T00:00:00"}]))
    config = {"sources": [{"name": "m", "type": "manual_json", "path": str(tmp_path / "in.json")}, {"name": "gone", "type": "manual_json", "path": str(tmp_path / "none.json")}]}
    assert cli.problems(config) == [] and len(cli.problems({"sources": [{"type": "?"}, 3, {"name": "a", "type": "ics"}, {"name": "a", "type": "ics"}]})) == 4
    now = datetime(2026, 8, 1, tzinfo=UTC)
    assert cli.run(spark, config, str(tmp_path / "out"), now) == 0
    assert cli.run(spark, config, str(tmp_path / "out2"), now, strict=True) == 2
    assert spark.read.json(str(tmp_path / "out/events")).count() == 1
    assert "BEGIN:VCALENDAR" in "\n".join(r.value for r in spark.read.text(str(tmp_path / "out/calendar")).collect())
