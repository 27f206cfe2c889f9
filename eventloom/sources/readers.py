"""Readers over files and text columns: JSON, iCalendar, JSON-LD and embedded JSON in pages, JSON lines, recurring rules.

Live collection is out of scope: a collector leaves files, and these read them. Everything but the JSON walkers and
recurrence rules is a column expression.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from datetime import datetime, timedelta
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup, times

ICS_FIELDS = ("UID", "SUMMARY", "DESCRIPTION", "LOCATION", "URL", "STATUS", "CATEGORIES", "RRULE")


def json_array(spark: SparkSession, path: str, items: str | None = None) -> DataFrame:
    """Rows of a JSON array, or of the array under a dotted path."""
    if not items:
        return spark.read.option("multiLine", True).json(path)
    whole = spark.read.option("multiLine", True).json(path)
    return whole.select(F.explode(F.col(items)).alias("item")).select("item.*")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Each line an object, blank lines skipped; a bad line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def unfold(c: Column) -> Column:
    return F.regexp_replace(c, "\r?\n[ \t]", "")


def unescape(c: Column) -> Column:
    out = c
    for a, b in ((r"\\n", "\n"), (r"\\N", "\n"), (r"\\,", ","), (r"\;", ";"), (r"\\\\", "\\\\")):
        out = F.regexp_replace(out, a, b)
    return out


def ics_value(event: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(event, rf"(?im)^{name}(?:;[^:\r\n]*)?:([^\r\n]*)", 1), F.lit(""))


def ics_params(event: Column, name: str) -> Column:
    return F.regexp_extract(event, rf"(?im)^{name}((?:;[^:\r\n]*)?):", 1)


def ics_instant(event: Column, name: str, zone: str) -> Column:
    """Dates are midnight, Z is UTC, else TZID or the default zone; unreadable is null."""
    v = ics_value(event, name)
    tz = F.coalesce(F.nullif(F.regexp_extract(ics_params(event, name), r"(?i)TZID=\"?([^;\":]+)", 1), F.lit("")), F.lit(zone))
    day = F.to_utc_timestamp(F.try_to_timestamp(v, F.lit("yyyyMMdd")), zone)
    utc = F.try_to_timestamp(F.rtrim(v, F.lit("Z")), F.lit("yyyyMMdd'T'HHmmss"))
    return F.when(F.length(v) == 8, day).when(F.endswith(v, F.lit("Z")), utc).otherwise(F.to_utc_timestamp(utc, tz))


def ics_events(files: DataFrame, text: str, zone: str = times.TOKYO) -> DataFrame:
    """One row a VEVENT that has a start: the file's columns, uid, title, description, location, url, status, tags, rrule, starts_at, ends_at."""
    blocks = F.regexp_extract_all(unfold(F.col(text)), F.lit(r"(?s)BEGIN:VEVENT(.*?)END:VEVENT"), F.lit(1))
    e = files.withColumn("_e", F.explode(blocks)).drop(text)
    v = lambda n: unescape(ics_value(F.col("_e"), n))
    out = e.withColumns(
        {
            "uid": v("UID"), "title": v("SUMMARY"), "description": v("DESCRIPTION"), "location": v("LOCATION"), "url": v("URL"),
            "status": F.lower(F.coalesce(v("STATUS"), F.lit("confirmed"))), "tags": F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(v("CATEGORIES"), F.lit("")), ","), lambda x: x != ""))),
            "rrule": ics_value(F.col("_e"), "RRULE"), "starts_at": ics_instant(F.col("_e"), "DTSTART", zone), "ends_at": ics_instant(F.col("_e"), "DTEND", zone),
        }
    )
    return out.where(F.col("starts_at").isNotNull()).drop("_e")


def ics_records(spark: SparkSession, path: str) -> DataFrame:
    """file, value (the text of one VEVENT with what stands before it), calendar_name, calendar_zone of each event in the files.

    Files are read in splits, with END:VEVENT as the end of a record, so a large calendar serves many tasks and no row has
    a whole file. What is said once, in the head of a file, is joined back by file; a file has one calendar. A file
    that ends inside an event gives that event.
    """
    rows = spark.read.option("lineSep", "END:VEVENT").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    head = rows.where(F.contains("value", F.lit("BEGIN:VCALENDAR")))
    said = lambda n: F.max(unescape(ics_value(F.substring_index(unfold(F.col("value")), "BEGIN:VEVENT", 1), n)))
    named = head.groupBy("file").agg(said("X-WR-CALNAME").alias("calendar_name"), said("X-WR-TIMEZONE").alias("calendar_zone"))
    events = rows.where(F.contains("value", F.lit("BEGIN:VEVENT"))).withColumn("value", F.concat("value", F.lit("END:VEVENT")))
    return events.join(named, "file", "left")


def _begun_later(rule, first: datetime):
    """A rule without its occurrences long before `first`: begun whole intervals later, at least two days before it.

    A rule with a count, of another frequency than days to years, or begun on a day that not all months have, stays as it is.
    """
    from dateutil.rrule import DAILY, MONTHLY, WEEKLY, YEARLY, rrule

    if not isinstance(rule, rrule) or rule._count is not None or rule._freq not in (DAILY, WEEKLY, MONTHLY, YEARLY):
        return rule
    begin, every = rule._dtstart, rule._interval
    gap = (first.astimezone(begin.tzinfo).replace(tzinfo=None) - begin.replace(tzinfo=None)).days - 2
    if gap <= 0 or every < 1:
        return rule
    if rule._freq in (DAILY, WEEKLY):
        step = every * (7 if rule._freq == WEEKLY else 1)
        return rule.replace(dtstart=begin + timedelta(days=gap // step * step))
    if begin.day > 28:
        return rule
    step = every * (12 if rule._freq == YEARLY else 1)
    months = begin.year * 12 + begin.month - 1 + gap // 31 // step * step  # no month has more than 31 days
    return rule.replace(dtstart=begin.replace(year=months // 12, month=months % 12 + 1))


def expand_rrule(events: DataFrame, window_start: datetime, window_end: datetime, zone: str = times.TOKYO) -> DataFrame:
    """Events with a rule become their occurrences between the window's ends (UTC, both included), however old the start is.

    Rules are RFC 5545's, read by dateutil; one that can't be read leaves the start. Events without a rule stay as they are.
    Equal rules with one start are expanded once in a batch, and those begun long before the window from near it on.
    """
    from dateutil.rrule import rrulestr
    from zoneinfo import ZoneInfo

    utc, local = ZoneInfo("UTC"), ZoneInfo(zone)
    first, last = window_start.replace(tzinfo=utc), window_end.replace(tzinfo=utc)

    def occurrences(rule: str, start: datetime) -> list[datetime]:
        at = start.replace(tzinfo=utc).astimezone(local)
        try:
            found = _begun_later(rrulestr(rule, dtstart=at), first).between(first, last, inc=True)
        except (TypeError, ValueError, OverflowError):
            found = [at] if first <= at <= last else []
        return [x.astimezone(utc).replace(tzinfo=None) for x in found]

    @F.arrow_udf("array<timestamp_ntz>")
    def expanded(rule: pa.Array, start: pa.Array) -> pa.Array:
        met: dict[tuple, list[datetime]] = {}
        out = []
        for of in zip(rule.to_pylist(), start.to_pylist(), strict=True):
            if of not in met:
                met[of] = occurrences(*of) if of[0] else [of[1]]
            out.append(met[of])
        return pa.array(out, pa.list_(pa.timestamp("us")))

    length = F.col("ends_at") - F.col("starts_at")
    one = events.withColumn("_len", length).withColumn("_at", F.explode(expanded("rrule", F.col("starts_at").cast("timestamp_ntz"))))
    at = F.col("_at").cast("timestamp")
    return one.withColumns({"starts_at": at, "ends_at": at + F.col("_len")}).drop("_at", "_len")


def apply_exceptions(occurrences: DataFrame, exdates: DataFrame, overrides: DataFrame) -> DataFrame:
    """Occurrences without the excluded (uid, starts_at), and with overridden ones replaced (uid, recurrence_id, and the columns)."""
    kept = occurrences.join(exdates.select("uid", "starts_at").distinct(), ["uid", "starts_at"], "left_anti")
    o = overrides.select(F.col("uid"), F.col("recurrence_id").alias("starts_at")).distinct()
    return kept.join(o, ["uid", "starts_at"], "left_anti").unionByName(overrides.drop("recurrence_id"), allowMissingColumns=True)


def _walk(node):
    yield node
    for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
        if isinstance(child, (dict, list)):
            yield from _walk(child)


def _trees(bodies: list[str] | None):
    """The JSON texts that can be read."""
    for body in bodies or ():
        try:
            yield json.loads(body)
        except (ValueError, RecursionError):
            continue


def _text(v) -> str | None:
    if isinstance(v, dict):
        v = v.get("name") or v.get("url")
    if isinstance(v, list):
        v = v[0] if v else None
        return _text(v) if isinstance(v, dict) else v
    return None if v is None else str(v)


def jsonld_events(pages: DataFrame, page: str, url: str, zone: str = times.TOKYO) -> DataFrame:
    """The pages' columns and title, description, start, end, location, organizer, event_url, image of each node whose type ends in Event."""
    keys = ("title", "description", "start", "end", "location", "organizer", "event_url", "image")

    @F.arrow_udf("array<struct<" + ",".join(f"{k}:string" for k in keys) + ">>")
    def found(scripts: pa.Array, base: pa.Array) -> pa.Array:
        out = []
        for bodies, b in zip(scripts.to_pylist(), base.to_pylist(), strict=True):
            rows = []
            for tree in _trees(bodies):
                for n in _walk(tree):
                    kinds = n.get("@type") if isinstance(n, dict) else None
                    if any(str(k).lower().endswith("event") for k in (kinds if isinstance(kinds, list) else [kinds])):
                        rows.append({"title": _text(n.get("name")), "description": _text(n.get("description")), "start": _text(n.get("startDate")), "end": _text(n.get("endDate")), "location": _text(n.get("location")), "organizer": _text(n.get("organizer")), "event_url": urljoin(b or "", _text(n.get("url")) or ""), "image": urljoin(b or "", _text(n.get("image")) or "") if n.get("image") else None})
            out.append(rows)
        return pa.array(out, pa.list_(pa.struct([(k, pa.string()) for k in keys])))

    kind = lambda a: F.lower(F.trim(F.substring_index(F.element_at(a, F.lit("type")), ";", 1))) == "application/ld+json"
    df = pages.withColumn("_n", F.explode(found(markup.scripts_of(markup.tags(page), kind), url))).drop(page)
    return df.select("*", "_n.*").drop("_n").withColumns({"starts_at": times.parse_instant(F.col("start"), zone), "ends_at": times.parse_instant(F.col("end"), zone)}).drop("start", "end")


#: The keys that embedded posts use, first hit wins, whatever the case.
POST_KEYS = {
    "status_id": ("id", "tweetId", "statusId", "id_str", "rest_id"),
    "text": ("displayText", "full_text", "fullText", "tweetText", "text"),
    "url": ("url", "tweetUrl", "statusUrl", "permalink"),
    "author": ("screenName", "screen_name", "username", "userName", "handle"),
    "retweet_count": ("rtCount", "retweet_count", "retweetCount", "repost_count", "repostCount"),
}


def embedded_posts(pages: DataFrame, page: str) -> DataFrame:
    """status_id, url, text, author, retweet_count of posts in the pages' embedded JSON; the richest row of each id (of equals the earlier on its page, then the greater text)."""

    def pick(node: dict, names) -> str | None:
        low = {str(k).lower(): v for k, v in node.items()}
        for k in names:
            v = low.get(k.lower())
            if v is not None and not isinstance(v, (dict, list, bool)):
                return html.unescape(str(v))
        return None

    @F.arrow_udf("array<struct<" + ",".join(f"{k}:string" for k in POST_KEYS) + ">>")
    def found(c: pa.Array) -> pa.Array:
        out = []
        for bodies in c.to_pylist():
            rows = []
            for tree in _trees(bodies):
                for n in _walk(tree):
                    if isinstance(n, dict):
                        row = {k: pick(n, names) for k, names in POST_KEYS.items()}
                        if row["status_id"] and row["status_id"].isdigit() and row["text"]:
                            rows.append(row)
            out.append(rows)
        return pa.array(out, pa.list_(pa.struct([(k, pa.string()) for k in POST_KEYS])))

    low = lambda a, k: F.lower(F.coalesce(F.element_at(a, F.lit(k)), F.lit("")))
    wanted = lambda a: F.contains(low(a, "type"), F.lit("json")) | low(a, "id").isin("__next_data__", "__initial_state__")
    rows = pages.select(F.posexplode(found(markup.scripts_of(markup.tags(page), wanted))).alias("_at", "_p")).select("_at", "_p.*")
    count = F.replace("retweet_count", F.lit(","), F.lit("")).try_cast("long")
    best = F.max_by(F.struct("url", "text", "author", count.alias("retweet_count")), F.struct(count.isNotNull(), F.length("text"), -F.col("_at"), "text", "url", "author")).alias("b")
    return rows.groupBy("status_id").agg(best).select("status_id", "b.*")


REGISTRY: dict[str, Callable[[SparkSession, dict], DataFrame]] = {}


def source(kind: str):
    def add(fn):
        REGISTRY[kind] = fn
        return fn

    return add


@source("manual_json")
def _manual(spark: SparkSession, cfg: dict) -> DataFrame:
    return json_array(spark, cfg["path"])


@source("json")
def _json(spark: SparkSession, cfg: dict) -> DataFrame:
    return json_array(spark, cfg["path"], cfg.get("items_path"))


@source("ics")
def _ics(spark: SparkSession, cfg: dict) -> DataFrame:
    return ics_events(ics_records(spark, cfg["path"]).drop("file"), "value", cfg.get("timezone", times.TOKYO))


@source("jsonld")
def _jsonld(spark: SparkSession, cfg: dict) -> DataFrame:
    pages = spark.read.text(cfg["path"], wholetext=True).withColumn("page_url", F.lit(cfg.get("url", "")))
    return jsonld_events(pages, "value", "page_url", cfg.get("timezone", times.TOKYO))


@source("posts")
def _posts(spark: SparkSession, cfg: dict) -> DataFrame:
    return embedded_posts(spark.read.text(cfg["path"], wholetext=True), "value")


def collect(spark: SparkSession, cfg: dict) -> DataFrame:
    """Reads a source by its type; an unknown type is an error."""
    if cfg.get("type") not in REGISTRY:
        raise ValueError(f"unknown source type: {cfg.get('type')}")
    return REGISTRY[cfg["type"]](spark, cfg).withColumn("source", F.lit(cfg["name"]))


def with_stale(fresh: DataFrame, previous: DataFrame, failed: list[str]) -> DataFrame:
    """Fresh rows, and the previous rows of the sources that failed."""
    return fresh.unionByName(previous.where(F.col("source").isin(failed) if failed else F.lit(False)), allowMissingColumns=True)


def posts_with_users(posts: DataFrame, users: DataFrame) -> DataFrame:
    return posts.join(users.select(F.col("id").alias("author_id"), F.col("username").alias("author")), "author_id", "left")
