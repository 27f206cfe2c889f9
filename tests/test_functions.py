"""Golden rows of the text and time functions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.functions import times


def one(spark, column, **values):
    row = [tuple(values.values())] if values else [(1,)]
    schema = ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame(row, schema).select(column.alias("v")).first().v


def utc(s):
    return F.lit(s).cast("timestamp")


@pytest.mark.parametrize(
    "text, anchor, expected, method",
    [
        ("来週月曜 22:00", "2026-08-07 03:00:00", "2026-08-10 13:00:00", "next_calendar_week_weekday"),
        ("来週土曜日 21:00", "2026-08-09 03:00:00", "2026-08-15 12:00:00", "next_calendar_week_weekday"),
        ("来週の金曜日 20:30", "2026-08-03 00:00:00", "2026-08-14 11:30:00", "next_calendar_week_weekday"),
        ("今週月曜 22:00", "2026-08-04 03:00:00", None, None),
        ("水曜 21:00", "2026-08-03 00:00:00", "2026-08-05 12:00:00", "next_occurrence_unprefixed"),
        ("次の月曜 19:00", "2026-08-03 00:00:00", "2026-08-10 10:00:00", "next_occurrence_explicit"),
        ("来週月曜 00:30", "2026-08-09 14:59:00", "2026-08-09 15:30:00", "next_calendar_week_weekday"),
        ("月曜 21:00", "2026-08-03 09:00:00", "2026-08-03 12:00:00", "next_occurrence_unprefixed"),
        ("月曜 12:00", "2026-08-03 09:00:00", "2026-08-10 03:00:00", "next_occurrence_unprefixed"),
    ],
)
def test_relative_weekday(spark, text, anchor, expected, method):
    at, how = times.relative_weekday(F.lit(text), utc(anchor))
    row = spark.range(1).select(at.cast("string").alias("at"), how.alias("how")).first()
    assert (row.at, row.how) == (expected, method)


@pytest.mark.parametrize(
    "text, anchor, expected",
    [
        ("8月19日22:30 開演", "2026-08-02 08:00:00", "2026-08-19 13:30:00"),
        ("2026年8月15日22時", "2026-08-02 08:00:00", "2026-08-15 13:00:00"),
        ("1月5日 21:00", "2026-12-20 00:00:00", "2027-01-05 12:00:00"),
        ("2026/13/40 10:00", "2026-08-02 08:00:00", None),
        ("本日 ２１:００", "2026-08-02 08:00:00", None),
        ("明日 21:00", "2026-08-02 08:00:00", "2026-08-03 12:00:00"),
        ("いつか", "2026-08-02 08:00:00", None),
    ],
)
def test_event_datetime(spark, text, anchor, expected):
    assert one(spark, times.event_datetime(F.lit(text), utc(anchor)).cast("string")) == expected


def test_snowflake(spark):
    assert one(spark, times.snowflake_time(F.col("i")), i="2081995073290666478") == datetime(2026, 7, 28, 6, 48, 1, 727000)
    assert one(spark, times.snowflake_time(F.col("i")), i="0") is None
    assert one(spark, times.snowflake_time(F.col("i")), i="no") is None


def test_instants(spark):
    assert one(spark, times.parse_instant(F.lit("2026-08-02T21:00:00"), "Asia/Tokyo").cast("string")) == "2026-08-02 12:00:00"
    assert one(spark, times.parse_instant(F.lit("2026-08-02T21:00:00+09:00"), "UTC").cast("string")) == "2026-08-02 12:00:00"
    assert one(spark, times.parse_instant(F.lit("soon"), "UTC")) is None


@pytest.mark.parametrize("text, ok", [("VRCイベント", True), ("VRC初心者", True), ("#VRC_EDU", True), ("VRC2年", True), ("VRChatイベント", False), ("VRCSDK", False)])
def test_marker_boundary(spark, text, ok):
    assert one(spark, T.marker(F.lit(text), "vrc")) is ok


def test_urls(spark):
    s, n = (lambda u: one(spark, T.canonical_url_strict(F.lit(u)))), (lambda u: one(spark, T.canonical_url_lenient(F.lit(u))))
    assert s("https://Twitter.com/a/?utm_source=x&b=1#f") == "https://x.com/a?b=1"
    assert s("http://a.b/c") is None
    assert n("HTTP://A.b/?ref=x&source=y&k=1") == "http://a.b/?k=1"
    assert n("mailto:a@b") is None
    assert one(spark, T.link_kind(F.lit("https://docs.google.com/forms/d/1"))) == "application"
    assert one(spark, T.link_kind(F.lit("https://x.com/a/status/1"))) == "announcement"


def test_text(spark):
    assert one(spark, T.clean_text(F.lit("　a \n\t b　"))) == "a b"
    assert one(spark, T.has_any(F.lit(None).cast("string"), ["a"])) is False
    assert one(spark, T.sensitive(F.lit("call +81 90-1234-5678"))) is True
    assert one(spark, T.sensitive(F.lit("events 2026"))) is False
    assert one(spark, T.event_ordinal(F.lit("第 １２ 回"))) == "12"
    assert one(spark, T.truncate(F.lit("abcdef"), 4)) == "abc…"
    assert one(spark, T.dedup_key(F.lit("ＡＢＣ https://x.y/z 集会！"))) == "abc集会"
    assert one(spark, T.ratcliff(F.lit("abcd"), F.lit("bcde"))) == 0.75
    assert one(spark, T.meta_content(F.lit('<meta content="v" property="og:image">'), "og:image")) == "v"


def test_month_conflict(spark):
    assert one(spark, times.month_conflict(F.lit("次回3月のイベント 日時：2026/08/01"))) is True
    assert one(spark, times.month_conflict(F.lit("次回8月のイベント 日時：2026/08/01"))) is False
