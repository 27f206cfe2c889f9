"""From source rows to normalized events: field aliases, cleaning, identity, calendar and post readers' rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times

#: Fixed: the names that sources use for a field, the first filled one counts.
ALIASES = {
    "source_id": ("source_id", "id", "uid"),
    "starts_at": ("starts_at", "start", "start_time", "startsAt"),
    "ends_at": ("ends_at", "end", "end_time", "endsAt"),
    "title": ("title", "name"),
    "organizer": ("organizer", "host", "owner"),
    "location": ("location", "venue", "world"),
    "description": ("description", "text"),
    "url": ("url", "event_url"),
    "image_url": ("image_url", "imageUrl"),
}


def _pick(df: DataFrame, names: tuple[str, ...]) -> Column:
    kinds = dict(df.dtypes)
    found = []
    for n in names:
        if n in kinds:
            c = F.col(f"{n}.name") if kinds[n].startswith("struct") else F.col(n)
            found.append(F.nullif(c.cast("string"), F.lit("")))
    return F.coalesce(*found, F.lit(None).cast("string")) if found else F.lit(None).cast("string")


def build(raw: DataFrame, source: str, fetched_at: Column, zone: str = times.TOKYO) -> DataFrame:
    """Normalized events; rows without a start or a title carry an `error` and are for the caller to set apart.

    Text is cleaned, blank is null, tags are distinct and sorted, times are instants; an end before the start asks for
    review and lowers the confidence to 0.3 at most.
    """
    kinds = dict(raw.dtypes)
    f = {k: _pick(raw, names) for k, names in ALIASES.items()}
    has = lambda c, kind, default: F.coalesce(F.col(c).cast(kind), F.lit(default)) if c in kinds else F.lit(default)
    tags = F.col("tags") if kinds.get("tags") == "array<string>" else F.array().cast("array<string>")
    df = raw.select(
        F.lit(source).alias("source"), T.blank_to_null(f["source_id"]).alias("source_id"), T.clean_text(f["title"]).alias("title"),
        times.parse_instant(f["starts_at"], zone).alias("starts_at"), times.parse_instant(f["ends_at"], zone).alias("ends_at"),
        *(T.blank_to_null(f[k]).alias(k) for k in ("organizer", "location", "description", "url", "image_url")),
        T.blank_to_null(has("category", "string", "")).alias("category"), F.lower(T.clean_text(has("status", "string", "scheduled"))).alias("status"), fetched_at.alias("fetched_at"),
        F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), T.clean_text), lambda x: x != ""))).alias("tags"),
        has("confidence", "double", 1.0).alias("confidence"), has("review_required", "boolean", False).alias("review_required"),
    )
    late = F.coalesce(F.col("ends_at") < F.col("starts_at"), F.lit(False))
    return df.withColumns(
        {
            "id": T.event_identity(F.col("source"), F.col("source_id"), F.col("organizer"), F.col("title"), times.iso_z(F.col("starts_at")), F.col("location")),
            "confidence": F.when(late, F.least("confidence", F.lit(0.3))).otherwise(F.col("confidence")),
            "review_required": F.col("review_required") | late,
            "error": F.when(F.col("starts_at").isNull(), "event has no start time").when(F.coalesce("title", F.lit("")) == "", "event has no title"),
        }
    )


def public_calendar(items: DataFrame) -> DataFrame:
    """Public entries of the discovery calendar: no drafts, nothing deleted, ids that start with cal_; tags united."""
    kept = items.where(~F.coalesce("isDraft", F.lit(False)) & F.col("deletedAt").isNull() & (F.col("accessType") == "public") & F.startswith("id", F.lit("cal_")) & (F.coalesce(F.trim("title"), F.lit("")) != "") & F.col("startsAt").isNotNull())
    empty = F.array().cast("array<string>")
    tags = F.concat(F.array(F.lit("VRChat"), F.lit("公式カレンダー"), F.coalesce("category", F.lit(""))), *(F.coalesce(c, empty) for c in ("tags", "languages", "platforms")), F.when(F.col("featured"), F.array(F.lit("featured"))).otherwise(empty))
    return kept.select(
        F.col("id").alias("source_id"), F.trim("title").alias("title"), F.col("startsAt").alias("starts_at"), F.col("endsAt").alias("ends_at"), F.col("ownerId").alias("organizer"), F.lit("VRChat Public Calendar").alias("location"),
        "description", F.col("imageUrl").alias("image_url"), "category", F.lit("scheduled").alias("status"), F.array_sort(F.array_distinct(F.filter(F.transform(tags, lambda x: F.trim(x)), lambda x: x != ""))).alias("tags"), F.lit(1.0).alias("confidence"),
    )


def group_calendar(items: DataFrame) -> DataFrame:
    """Entries of a group's calendar: drafts left out, deleted ones cancelled."""
    return items.where(~F.coalesce("isDraft", F.lit(False))).withColumn("status", F.when(F.col("deletedAt").isNotNull(), "cancelled").otherwise("scheduled"))


def posts_to_events(posts: DataFrame, zone: str = times.TOKYO) -> DataFrame:
    """Posts with a date and a clock anywhere: starts_at (next year if 45 days past), title of 72 characters. posts: id, text, created_at, author."""
    t = T.clean_text(F.col("text"))
    date, clock = r"(?:([0-9]{4})[./年-])?([0-9]{1,2})[./月-]([0-9]{1,2})日?", r"(?<![0-9])([01]?[0-9]|2[0-3])[:時]([0-9]{2})?"
    num = lambda p, i: F.regexp_extract(t, p, i).try_cast("int")
    near = times.local(F.col("created_at"), zone)

    def at(year: Column) -> Column:
        return F.to_utc_timestamp(F.try_make_timestamp(years=year, months=num(date, 2), days=num(date, 3), hours=num(clock, 1), mins=F.coalesce(num(clock, 2), F.lit(0)), secs=F.lit(0)), zone)

    own = num(date, 1)
    first = at(F.coalesce(own, F.year(near)))
    start = F.when(own.isNull() & (first < F.col("created_at") - F.expr("interval 45 days")), at(F.year(near) + 1)).otherwise(first)
    url = F.concat(F.lit("https://x.com/"), F.coalesce("author", F.lit("i/web")), F.lit("/status/"), F.col("id"))
    return posts.withColumns({"starts_at": start, "title": T.truncate(t, 73), "url": url, "organizer": F.concat(F.lit("@"), "author"), "confidence": F.lit(0.72)}).where(t.rlike(date) & t.rlike(clock) & F.col("starts_at").isNotNull())


def text_search(events: DataFrame, needle: str, fields: tuple[str, ...] = ("title", "description", "organizer", "location", "source_id")) -> Column:
    return F.contains(F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in fields if c in events.columns))), F.lit(needle.lower().strip()))


def valid_cached(text: Column, starts_at: Column, now: Column, still: Column) -> Column:
    """Whether a cached event may stay: one day back to 180 ahead, 12 to 1200 characters, still accepted by the rules."""
    return starts_at.between(now - F.expr("interval 1 day"), now + F.expr("interval 180 days")) & F.length(text).between(12, 1200) & still


def merge_cache(cached: DataFrame, fresh: DataFrame, key: str = "source_id") -> DataFrame:
    return fresh.unionByName(cached.join(fresh.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def occurrence_id(start: Column, urls: Column, descriptions: Column, organizers: Column, ordinals: Column, reasons: Column, members: Column, existing: Column) -> Column:
    """An occurrence's id from its members' distinct values (arrays without nulls): a lone existing one, else by url, text, organizer and ordinal, or members."""
    payload = (
        F.when((F.size(urls) == 1) & F.array_contains(reasons, "same_canonical_url"), F.concat_ws("|", F.lit("url"), start, F.get(urls, F.lit(0))))
        .when((F.size(descriptions) == 1) & F.array_contains(reasons, "exact_text_same_start"), F.concat_ws("|", F.lit("text"), start, F.get(descriptions, F.lit(0))))
        .when((F.size(organizers) == 1) & (F.size(ordinals) == 1), F.concat_ws("|", F.lit("organizer-ordinal"), start, F.get(organizers, F.lit(0)), F.get(ordinals, F.lit(0))))
        .otherwise(F.concat_ws("|", F.lit("members"), start, F.array_join(F.array_sort(members), "|")))
    )
    return F.when(F.size(existing) == 1, F.get(existing, F.lit(0))).otherwise(F.concat(F.lit("occ_"), T.short_hash(payload)))
