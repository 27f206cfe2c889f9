"""Posts, plans, schedules: what SQL doesn't show."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.operators import ledger, metrics, posts, recurrence, search


def titles(spark, rows):
    df = spark.createDataFrame(rows, "text string, category string")
    return [r.t for r in df.select(posts.post_title(F.col("text"), F.col("category")).alias("t")).collect()]


def test_titles(spark):
    e, r = "event", "recruitment_deadline"
    rows = [("📅 8/1\n9:00 open\n「 夜会 」", e), ("📅 8/1\n8/2 x\nplain", e), ("8/1 only", e), ("#a\n #b", e), (None, e), ("x\n募集します", r), ("x\ny", r), ("", r), ("『』\nnext", e), ("a" * 97, e), ("a" * 96, e)]
    assert titles(spark, rows) == [" 夜会 ", "plain", "8/1 only", "VRChatイベント", "VRChatイベント", "募集します", "x", "VRChat関連募集", "『』", "a" * 96 + "…", "a" * 96]


def test_posts_need_retweets_or_a_strong_marker(spark):
    at = datetime(2026, 8, 1)
    rows = [(1, "イベント 8/20 21:00", at, "u", 2), (2, "イベント 8/20 21:00", at, "u", 3), (3, "開催 8/20 21:00", at, None, None), (4, "開催 no date", at, "u", 9), (5, "8/20 21:00", at, "u", 9), (6, None, at, "u", 9), (7, "開催 8/20 21:00", None, "u", 9), (8, "テスター 応募 締切 8/20 21:00", at, "u", 0), (9, "募集 応募 8/20 21:00", at, "u", 0)]
    got = {r.source_id: r for r in posts.post_events(spark.createDataFrame(rows, "id long, text string, created_at timestamp, author string, retweet_count long"), 3).collect()}
    assert set(got) == {"x:2", "x:3", "x:8"}
    assert (got["x:3"].url, got["x:3"].organizer, got["x:8"].category, got["x:8"].location, got["x:2"].tags[-1]) == ("https://x.com/i/web/status/3", None, "recruitment_deadline", "オンライン", "イベント")


def test_small_texts(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(T.search_text_cleaned(F.lit(" START a\tSTART\tb\tEND\tc &amp; d END "))) == "a b c & d"
    assert one(T.search_text_cleaned(F.lit("RESTART and END."))) == "RESTART and END."
    assert one(T.title_key(F.lit("Ｎight！ №1 — 夜会 é"))) == "nightno1夜会é" and one(T.title_key(F.lit(None).cast("string"))) == ""
    page = '<meta content=" https://h.example/i.png " property="og:image">'
    assert one(T.group_image(F.lit(page))) == "https://h.example/i.png" and one(T.group_image(F.lit(page.replace("https", "http")))) is None


def test_plan_is_large_enough(spark):
    groups = spark.createDataFrame([(0, "core", ["VRC night", " ", "Vrc Night"]), (1, "noise", ["x"])], "ord int, group string, terms array<string>")
    with pytest.raises(ValueError):
        search.best_plan(groups)
    rows = search.best_plan(groups, 1).orderBy("place").collect()
    assert [r.group for r in rows] == ["ablation_winner"] + ["ablation_complement"] * 2 + ["lexical_high_precision"] * 3 + ["structured_core", "platform_fallback_core"]
    assert [r.place for r in rows] == list(range(8)) and rows[-1].key == "best-fallback-000"


TEMPLATE = "series_id string, title string, frequency string, start_time string, end_time string, weekdays array<int>, interval_weeks int, anchor_date date, weekday int, nth int, days array<int>"
ONE_OFF = "source_id string, title string, starts_at timestamp, ends_at timestamp"


def made(spark, templates, single=()):
    at = lambda s: F.lit(s).cast("timestamp")
    return recurrence.materialize(spark.createDataFrame(templates, TEMPLATE), spark.createDataFrame(list(single), ONE_OFF), at("2026-08-01 00:00:00"), at("2026-08-31 00:00:00"))


def test_materialize_refuses(spark):
    good = ("s", "t", "weekly", "21:00", None, [0], None, None, None, None, None)
    assert made(spark, [good]).count() == 5
    for k, v in ((2, "yearly"), (2, None), (5, []), (5, None), (6, 0)):
        with pytest.raises(ValueError):
            made(spark, [good[:k] + (v,) + good[k + 1 :]])
    for nth in (0, 6, None):
        with pytest.raises(ValueError):
            made(spark, [("s", "t", "monthly_nth_weekday", "21:00", None, None, None, None, 1, nth, None)])
    for days in ([], None, [0], [32]):
        with pytest.raises(ValueError):
            made(spark, [("s", "t", "monthly_days", "21:00", None, None, None, None, None, None, days)])
    with pytest.raises(ValueError, match="duplicate source_id: s:2026-08-03"):
        made(spark, [good], [("s:2026-08-03", "x", datetime(2026, 8, 9), None)])
    assert made(spark, [good], [("s:2026-08-03", "x", datetime(2027, 8, 9), None)]).count() == 5


def test_resolution_audit_of_nothing(spark):
    schema = "source_id string, starts_at timestamp, date_resolution_method string, date_resolution_anchor string, date_resolution_evidence string"
    none = spark.createDataFrame([], schema)
    counts, methods, moved = ledger.resolution_audit(none, none)
    assert tuple(counts.first()) == (0, 0, 0, 0) and methods.count() == 0 and moved.count() == 0


def test_snapshots_fill_what_a_run_lacks(spark):
    runs = spark.createDataFrame([("a", 5), ("b", 7)], "generated_at string, calendar_event_count long").withColumns({c: F.lit(None).cast("long") for c in metrics.SNAPSHOT[1:]})
    sources = spark.createDataFrame([("a", "x", 2), ("b", "y", 3)], "generated_at string, name string, count long")
    kept, by = metrics.registration_snapshots(runs, sources, 2)
    b, a = kept.collect()
    assert (b.normalized_event_count, b.normalized_event_count_delta, a.calendar_event_count_delta, b.yahoo_queries_failed) == (7, 2, None, 0)
    assert {tuple(r) for r in by.select("generated_at", "name", "count", "delta").collect()} == {("a", "x", 2, None), ("b", "x", 0, -2), ("b", "y", 3, 3)}
