"""Links of events: where they come from, what kind they are, which one to act on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Fixed: order of kinds, kinds that count as official, kinds to act on, and hosts that shorten addresses.
PRIORITY = ("application", "vrchat_group", "vrchat_world", "join", "announcement", "official_web", "official_x", "community", "stream", "related_web")
OFFICIAL = ("application", "vrchat_group", "vrchat_world", "announcement", "official_web", "official_x")
ACTION = ("application", "vrchat_group", "vrchat_world", "join", "announcement", "official_web")
SHORTENERS = ("t.co", "bit.ly", "tinyurl.com", "goo.gl")


def source_urls(events: DataFrame, row_id: str, fields: list[str], texts: list[str]) -> DataFrame:
    """row, url, evidence: https addresses in fields and inside texts."""
    pieces = [F.struct(F.array(F.col(f)).alias("urls"), F.lit(f"field:{f}").alias("evidence")) for f in fields]
    pieces += [F.struct(F.regexp_extract_all(F.coalesce(F.col(t), F.lit("")), F.lit(r"https?://[^\s\"'<>]+"), F.lit(0)).alias("urls"), F.lit(f"text:{t}").alias("evidence")) for t in texts]
    each = events.select(F.col(row_id), F.explode(F.array(*pieces)).alias("p")).select(row_id, F.explode("p.urls").alias("raw"), "p.evidence")
    return each.select(row_id, T.canonical_https(F.col("raw")).alias("url"), "evidence").where("url is not null")


def resolved(urls: DataFrame, targets: DataFrame) -> DataFrame:
    """Shortened addresses take their known target; the others and unknown ones stay. targets: url, target."""
    t = targets.select(F.col("url").alias("_u"), F.col("target").alias("_t")).dropDuplicates(["_u"])
    df = urls.join(t, urls["url"] == F.col("_u"), "left")
    short = T.url_host(F.col("url")).isin(*SHORTENERS)
    return df.withColumns({"resolution": F.when(~short, "direct").when(F.col("_t").isNotNull(), "redirect").otherwise("unresolved_shortener"), "url": F.when(short, F.coalesce("_t", "url")).otherwise(F.col("url"))}).drop("_u", "_t")


def _order(kind: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(k) for k in PRIORITY)), kind), F.lit(0)), F.lit(99))


def ranked(urls: DataFrame, row_id: str) -> DataFrame:
    """row, url, kind, evidence, rank: each address once with its first evidence, by kind, then address."""
    each = urls.withColumn("kind", T.link_kind(F.col("url"))).groupBy(row_id, "url").agg(F.min("kind").alias("kind"), F.min("evidence").alias("evidence"))
    return each.withColumn("rank", F.row_number().over(Window.partitionBy(row_id).orderBy(_order(F.col("kind")), "url")))


def summary(links: DataFrame, row_id: str, most: int = 10) -> DataFrame:
    """row, official_links, related_links (at most ten each, in order) and primary_action_url."""
    row = F.struct("rank", "url", "kind", "evidence")
    pick = lambda inside: F.slice(F.array_sort(F.collect_list(F.when(inside, row))), 1, most)
    official = F.col("kind").isin(*OFFICIAL)
    return links.groupBy(row_id).agg(pick(official).alias("official_links"), pick(~official).alias("related_links"), F.min_by("url", F.when(F.col("kind").isin(*ACTION), F.col("rank"))).alias("primary_action_url"), F.count("*").alias("links"))


def action_links(primary: Column, official: Column, fallback: Column, most: int = 5) -> Column:
    """Primary first, then the distinct official ones, the event's own address last."""
    every = F.concat(F.array(primary), F.coalesce(official, F.array().cast("array<string>")), F.array(fallback))
    return F.slice(F.array_distinct(F.filter(every, lambda x: F.startswith(x, F.lit("https://")))), 1, most)
