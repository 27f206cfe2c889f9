"""Official assets of events: images and websites from a post's payload, links that events get from them, failed images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: The image host whose addresses say format and size, and hosts that are no website of an organizer.
IMAGE_HOST = "pbs.twimg.com"
NO_WEBSITE = ("x.com", "www.x.com", "twitter.com", "www.twitter.com", "t.co", "search.yahoo.co.jp", "vrchat.com", "www.vrchat.com", IMAGE_HOST)
#: Evidence of what a payload says, labels of the links that it adds.
EVIDENCE, OWN_EVIDENCE = "x_syndication_token_v2", "source_record"
ADDED = (("announcement", "公式告知"), ("official_x", "公式X"), ("official_web", "公式Web"))
#: Image fields of an event, each with the field of its kind.
IMAGE_FIELDS = {"preferred_image_url": "preferred_image_kind", "vrchat_group_image_url": None, "image_url": "image_kind"}
LINK = "struct<url:string,label:string,kind:string,evidence:string>"
MOST_LINKS = 6


def https(url: Column) -> Column:
    """https with a host, the host in lower case, no parameters or fragment; otherwise null."""
    raw = F.trim(url)
    query = T.url_query(raw)
    rest = F.concat(F.regexp_replace(T.url_path(raw), ";[^/]*$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.startswith(raw, F.lit("https://")) & T.url_host(raw).isNotNull(), F.concat(F.lit("https://"), F.lower(F.regexp_extract(raw, "^https://([^/?#]*)", 1)), rest))


def webp(url: Column, profile: bool = False) -> Column:
    """An image's address as WebP: the image host is asked for that format and a small size, of others only WebP files count.

    A profile image loses the size in its name. Parameters keep their places; other parameters stay as they are.
    """
    u = https(url)
    path = T.url_path(u)
    if profile:
        path = F.regexp_replace(path, r"_(?:normal|bigger|mini)(\.[A-Za-z0-9]+)$", "$1")
    wanted = {"format": "format=webp", "name": f"name={'200x200' if profile else 'small'}"}
    given = F.filter(F.split(F.coalesce(T.url_query(u), F.lit("")), "&"), lambda p: p != "")
    asked = lambda p: F.when(F.startswith(p, F.lit("format=")), wanted["format"]).when(F.startswith(p, F.lit("name=")), wanted["name"]).otherwise(p)
    query = F.array_join(F.array_union(F.transform(given, asked), F.array(*(F.lit(v) for v in wanted.values()))), "&")
    own = F.concat(F.lit(f"https://{IMAGE_HOST}"), path, F.lit("?"), query)
    return F.when(T.url_host(u) == IMAGE_HOST, own).when(F.endswith(F.lower(T.url_path(u)), F.lit(".webp")), u)


def website(payload: Column) -> Column:
    """The first https address of user, entities and card whose host may be a website, at any depth of the JSON text."""
    at = r'"(?:expanded_url|unwound_url|url)"\s*:\s*"((?:[^"\\]|\\.)*)"'
    roots = F.concat_ws("\n", *(F.get_json_object(payload, f"$.{root}") for root in ("user", "entities", "card")))
    found = F.transform(F.regexp_extract_all(roots, F.lit(at), F.lit(1)), lambda x: https(F.replace(x, F.lit("\\/"), F.lit("/"))))
    return F.get(F.filter(found, lambda x: x.isNotNull() & ~F.coalesce(T.url_host(x).isin(*NO_WEBSITE), F.lit(True))), F.lit(0))


def from_payload(payload: Column, handle: Column) -> Column:
    """struct of official_x_url, official_website_url, image_url, image_kind, evidence of a post's JSON text.

    The first image of the post counts (media, photos, the video's poster), else the organizer's profile image. Text that
    isn't JSON has no images and no website.
    """

    def addresses(path: str, *names: str) -> Column:
        rows = F.from_json(F.get_json_object(payload, path), f"array<struct<{','.join(f'{n}:string' for n in names)}>>")
        return F.transform(rows, lambda r: webp(F.coalesce(*(F.nullif(r[n], F.lit("")) for n in names))))

    none = F.array().cast("array<string>")
    text = lambda path: F.nullif(F.get_json_object(payload, path), F.lit(""))
    every = F.concat(F.coalesce(addresses("$.mediaDetails", "media_url_https", "media_url"), none), F.coalesce(addresses("$.photos", "url"), none), F.array(webp(text("$.video.poster"))))
    media = F.get(F.array_compact(every), F.lit(0))
    profile = webp(F.coalesce(text("$.user.profile_image_url_https"), text("$.user.profile_image_url")), profile=True)
    return F.struct(
        F.concat(F.lit("https://x.com/"), handle).alias("official_x_url"),
        website(payload).alias("official_website_url"),
        F.coalesce(media, profile).alias("image_url"),
        F.when(media.isNotNull(), "post_media").when(profile.isNotNull(), "organizer_profile").alias("image_kind"),
        F.lit(EVIDENCE).alias("evidence"),
    )


def post_identity(url: Column, links: Column, organizer: Column) -> Column:
    """struct of handle and status_id: of the first address of a post, else the organizer if that is a handle."""
    post = r"(?i)https://(?:www\.)?(?:x|twitter)\.com/([^/?#]+)/status/([0-9]+)"
    every = F.concat(F.array(url), F.coalesce(F.transform(links, lambda x: x["url"]), F.array().cast("array<string>")))
    first = F.get(F.filter(every, lambda u: F.coalesce(u.rlike(post), F.lit(False))), F.lit(0))
    name = F.nullif(F.regexp_extract(F.trim(organizer), "^@?([A-Za-z0-9_]{1,15})$", 1), F.lit(""))
    return F.struct(F.coalesce(F.regexp_extract(first, post, 1), name).alias("handle"), F.regexp_extract(first, post, 2).alias("status_id"))


def with_assets(events: DataFrame, cache: DataFrame) -> DataFrame:
    """The events with official_links (six at most), official_x_url, official_website_url, image_url, image_kind, asset_status, asset_evidence.

    events: url, organizer, official_links (array of LINK), image_url. cache: status_id and `assets` (see from_payload); one
    row a status is taken. Events without a post or without a row of the cache keep what they say themselves.
    """
    known = cache.where("status_id is not null").groupBy("status_id").agg(F.max("assets").alias("_assets"))
    df = events.withColumn("_post", post_identity(F.col("url"), F.col("official_links"), F.col("organizer")))
    df = df.join(known, F.col("_post.status_id") == F.col("status_id"), "left").drop("status_id")
    x_url = F.coalesce("_assets.official_x_url", F.concat(F.lit("https://x.com/"), F.col("_post.handle")))
    own = F.filter(F.coalesce(F.col("official_links"), F.array().cast(f"array<{LINK}>")), lambda x: https(x["url"]).isNotNull())
    df = df.withColumns({"_x": x_url, "_web": F.col("_assets.official_website_url"), "_at": https(F.col("url")), "_own": own})
    evidence = F.coalesce("_assets.evidence", F.lit(OWN_EVIDENCE))
    added = F.array(*(F.struct(F.col(c).alias("url"), F.lit(label).alias("label"), F.lit(kind).alias("kind"), evidence.alias("evidence")) for (kind, label), c in zip(ADDED, ("_at", "_x", "_web"), strict=True)))
    df = df.withColumn("_new", F.filter(added, lambda x: x["url"].isNotNull()))
    new = F.filter(F.col("_new"), lambda x, i: ~F.exists(F.concat("_own", F.slice("_new", 1, i)), lambda y: y["url"] == x["url"]))
    image = F.coalesce("_assets.image_url", webp(F.col("image_url")))
    some = F.coalesce(F.col("_x"), F.col("_web"), image).isNotNull()
    out = df.withColumns(
        {
            "official_links": F.slice(F.concat("_own", new.cast(f"array<{LINK}>")), 1, MOST_LINKS),
            "official_x_url": F.col("_x"),
            "official_website_url": F.col("_web"),
            "image_url": image,
            "image_kind": F.when(image.isNotNull(), F.col("_assets.image_kind")),
            "asset_status": F.when(some, "enriched").otherwise("unresolved"),
            "asset_evidence": F.coalesce("_assets.evidence", F.when(F.col("_at").isNotNull(), OWN_EVIDENCE)),
        }
    )
    return out.drop("_post", "_assets", "_x", "_web", "_at", "_own", "_new")


def _probed(events: DataFrame, row_id: str, probes: DataFrame) -> DataFrame:
    """row, field, url, ok, reason of each https image; one that wasn't probed failed. Rows of one address meet one row of it."""
    fields = [f for f in IMAGE_FIELDS if f in events.columns]
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("url")) for f in fields))
    each = events.select(F.col(row_id), F.inline(pairs)).where(F.startswith("url", F.lit("https://")))
    p = probes.groupBy(F.col("url")).agg(F.bool_and("ok").alias("ok"), F.min(F.when(~F.col("ok"), F.col("reason"))).alias("reason"))
    return each.join(p, "url", "left").select(row_id, "field", "url", F.coalesce("ok", F.lit(False)).alias("ok"), F.when(F.col("ok").isNull(), "not_checked").otherwise(F.col("reason")).alias("reason"))


def sanitized(events: DataFrame, row_id: str, probes: DataFrame) -> DataFrame:
    """The events without images that failed or weren't probed, nor the kinds of these. probes: url, ok, reason."""
    failed = _probed(events, row_id, probes).where("not ok").groupBy(F.col(row_id).alias("_row")).agg(F.collect_set("field").alias("_failed"))
    df = events.join(failed, events[row_id] == failed["_row"], "left")
    out = {}
    for field, kind in IMAGE_FIELDS.items():
        gone = F.coalesce(F.array_contains("_failed", field), F.lit(False))
        out |= {c: F.when(~gone, F.col(c)) for c in (field, kind) if c and field in events.columns and c in events.columns}
    return df.withColumns(out).drop("_row", "_failed")


def image_audit(events: DataFrame, row_id: str, probes: DataFrame) -> DataFrame:
    """what, n: checked, reachable and failed addresses, failures by reason, events that lost an image, fields that were cleared."""
    p = _probed(events, row_id, probes)
    urls = p.groupBy("url").agg(F.min("ok").alias("ok"), F.min("reason").alias("reason"))
    what = F.array_compact(F.array(F.lit("checked"), F.when(F.col("ok"), "reachable").otherwise("failed"), F.when(~F.col("ok"), F.concat(F.lit("failed:"), F.col("reason")))))
    rows = p.where("not ok").groupBy(row_id).agg(F.count("*").alias("fields"))
    return urls.select(F.explode(what).alias("what")).groupBy("what").agg(F.count("*").alias("n")).unionByName(
        rows.agg(F.count("*").alias("events_degraded"), F.coalesce(F.sum("fields"), F.lit(0)).alias("stripped_fields")).select(F.inline(F.array(*(F.struct(F.lit(c).alias("what"), F.col(c).alias("n")) for c in ("events_degraded", "stripped_fields")))))
    )
