"""Curated entries: what is wrong with them, their links and profiles, and what they add to an event's description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: What an entry must say about itself.
REVIEWED, SCHEDULES = "human_reviewed", ("recurring", "irregular", "one_off")
#: The label of an event's own announcement, and of a link without a label.
ANNOUNCEMENT, OFFICIAL = "公式告知・参加方法", "公式リンク"
#: What a description is supplemented with, in this order.
DETAILS = {"participation_method": "参加方法", "event_format": "開催形式", "audience": "対象"}
#: Highlights of a profile.
HIGHLIGHTS = 6
LINKS = "array<struct<label:string,url:string,kind:string>>"


def secure(url: Column) -> Column:
    """Whether an address is https with a host."""
    return F.coalesce(F.trim(url).rlike(r"^https://[^/\s@:]+"), F.lit(False))


def _blank(c: Column) -> Column:
    return F.coalesce(T.clean_text(c), F.lit("")) == ""


def invalid_entries(entries: DataFrame) -> DataFrame:
    """row, canonical_id, problem: everything that an entry lacks; of entries with one id all but the first are repeated.

    entries: row (order), canonical_id, canonical_name, status, reviewed_at, sources (array), schedule_type, schedule_label, cadence,
    introduction, highlights (array), first_time_guide, official_links (array of structs with url).
    """
    none = F.array().cast("array<string>")
    problems = F.array_compact(
        F.array(
            F.when(_blank(F.col("canonical_id")) | _blank(F.col("canonical_name")), "identity"),
            F.when(F.coalesce(F.col("status"), F.lit("")) != REVIEWED, "status"),
            F.when(_blank(F.col("reviewed_at")), "reviewed_at"),
            F.when(~F.exists(F.coalesce("sources", none), secure), "sources"),
            F.when(~F.coalesce(F.col("schedule_type").isin(*SCHEDULES), F.lit(False)), "schedule_type"),
            F.when(_blank(F.col("schedule_label")) | _blank(F.col("cadence")), "schedule"),
            F.when(_blank(F.col("introduction")), "introduction"),
            F.when(~F.exists(F.coalesce("highlights", none), lambda h: ~_blank(h)), "highlights"),
            F.when(_blank(F.col("first_time_guide")), "first_time_guide"),
            F.when(F.exists(F.coalesce(F.col("official_links").cast(LINKS), F.array().cast(LINKS)), lambda x: ~secure(x["url"])), "official_links"),
        )
    )
    own = entries.select("row", "canonical_id", F.explode(problems).alias("problem"))
    first = entries.where(~_blank(F.col("canonical_id"))).groupBy("canonical_id").agg(F.min("row").alias("_first"))
    again = entries.join(first, "canonical_id").where(F.col("row") > F.col("_first")).select("row", "canonical_id", F.lit("repeated").alias("problem"))
    return own.unionByName(again)


def require_valid(entries: DataFrame) -> None:
    """Raises ValueError at the first problem. An action, so it can't be optimized away."""
    bad = invalid_entries(entries).orderBy("row", "problem").first()
    if bad:
        raise ValueError(f"{bad.canonical_id or bad.row}: {bad.problem}")


def official_links(url: Column, links: Column) -> Column:
    """The event's own announcement, then the entry's links, each address once: in the place of its first, with the words of its last."""
    own = F.when(secure(url), F.array(F.struct(F.lit(ANNOUNCEMENT).alias("label"), F.trim(url).alias("url"), F.lit("announcement").alias("kind"))))
    given = F.transform(
        F.filter(F.coalesce(links, F.array().cast(LINKS)), lambda x: secure(x["url"])),
        lambda x: F.struct(F.coalesce(F.nullif(x["label"], F.lit("")), F.lit(OFFICIAL)).alias("label"), F.trim(x["url"]).alias("url"), F.coalesce(F.nullif(x["kind"], F.lit("")), F.lit("official")).alias("kind")),
    )
    every = F.concat(F.coalesce(own.cast(LINKS), F.array().cast(LINKS)), given.cast(LINKS))
    distinct = F.array_distinct(F.transform(every, lambda x: x["url"]))
    return F.transform(distinct, lambda u: F.element_at(F.filter(every, lambda x: x["url"] == u), -1))


def series_profile() -> Column:
    """A struct of an entry's texts, cleaned: name, schedule, introduction, highlights, guide, curation."""
    text = lambda c: F.nullif(T.clean_text(F.col(c)), F.lit(""))
    highlights = F.filter(F.transform("highlights", lambda h: T.clean_text(h)), lambda h: h != "")
    schedule = F.struct(text("schedule_type").alias("type"), text("schedule_label").alias("label"), text("cadence").alias("cadence"))
    curation = F.struct(text("status").alias("status"), text("reviewed_at").alias("reviewed_at"))
    return F.struct(
        F.col("canonical_id").alias("ontology_id"), F.col("canonical_name").alias("name"), schedule.alias("schedule"), text("introduction").alias("introduction"),
        F.slice(highlights, 1, HIGHLIGHTS).alias("highlights"), text("first_time_guide").alias("first_time_guide"), curation.alias("curation"),
    )


def supplemented(description: Column, details: dict[str, Column]) -> Column:
    """The description and, unless it says so already, how to take part, the format and the audience."""
    lines = [F.concat(F.lit(f"{DETAILS[k]}: "), F.nullif(F.trim(details[k]), F.lit(""))) for k in DETAILS if k in details]
    more, plain = F.concat_ws(" / ", *lines), F.trim(F.coalesce(description, F.lit("")))
    return F.when((more == "") | F.contains(plain, more), plain).otherwise(F.trim(F.concat(plain, F.lit(" "), more)))


def link_sources(entries: DataFrame, kinds: list[str], blocked: list[str]) -> DataFrame:
    """url: the entries' official links of these kinds, canonical, but for blocked hosts; each once."""
    one = entries.select(F.explode("official_links").alias("_l")).where(F.col("_l.kind").isin(*kinds)).select(T.canonical_url_lenient(F.col("_l.url")).alias("url"))
    host = F.regexp_replace(F.lower(T.url_host(F.col("url"))), r"^www\.", "")
    return one.where(F.col("url").isNotNull() & ~host.isin(*blocked)).distinct()


def without_known(found: DataFrame, known: DataFrame) -> DataFrame:
    """Found events (title, starts_at) but for those whose title, blanks and case aside, and start are known."""
    title = lambda t: F.lower(F.trim(F.regexp_replace(F.coalesce(t, F.lit("")), r"\s+", " ")))
    at = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    k = known.select(title(F.col("title")).alias("_t"), at(F.col("starts_at")).alias("_s")).distinct()
    return found.join(k, (title(found["title"]) == k["_t"]) & (at(found["starts_at"]) == k["_s"]), "left_anti")
