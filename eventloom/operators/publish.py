"""What readers see: the list's filter, labels of actions, series with their coming events, profiles by name, gates before publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .curation import LINKS, secure

#: Labels by what a kind contains, the first that fits counts; kinds that count as taking part.
ACTION_LABELS = {"registration": "応募・登録", "entry": "応募・登録", "participation": "参加方法", "join": "参加方法", "group": "グループ", "announcement": "公式告知", "official": "公式情報"}
ACTION_ELSE = "公式情報"
TAKING_PART = ("particip", "join", "entry", "registration")
#: Labels and kinds of a series' links that say none, how many links count, what a series' id may be.
LINK_LABEL, LINK_KIND, MOST_LINKS, SAFE_ID = "公式情報", "official", 8, r"^[A-Za-z0-9._-]{1,128}$"


def listed(starts_at: Column, first: Column, last: Column, fields: list[Column], text: str = "", chosen: tuple[tuple[Column, str], ...] = (), deadline: Column | None = None) -> Column:
    """Whether an event is in the list: no start or one in the range, the words in one of its fields, the chosen values, no deadline.

    deadline: what says that an event is a deadline, where those are to be left out.
    """
    wanted = T.nfkc_folded(F.lit(text.strip()))
    body = T.nfkc_folded(F.concat_ws(" ", *fields))
    ok = (starts_at.isNull() | starts_at.between(first, last)) & (F.lit(True) if not text.strip() else F.contains(body, wanted))
    for column, value in chosen:
        ok &= column.eqNullSafe(F.lit(value))
    return F.coalesce(ok if deadline is None else ok & ~F.coalesce(deadline, F.lit(False)), F.lit(False))


def action_label(kind: Column) -> Column:
    low = F.lower(F.coalesce(F.nullif(kind, F.lit("")), F.lit(LINK_KIND)))
    out = F.lit(ACTION_ELSE)
    for token, label in reversed(ACTION_LABELS.items()):
        out = F.when(F.contains(low, F.lit(token)), label).otherwise(out)
    return out


def click_name(kind: Column) -> Column:
    low = F.lower(F.coalesce(kind, F.lit("")))
    return F.when(T.any_of(F.contains(low, F.lit(t)) for t in TAKING_PART), "participation_link_click").otherwise("official_link_click")


def series_links(links: Column) -> Column:
    """The distinct https links, the first of each address, eight at most."""
    kept = F.filter(F.coalesce(links.cast(LINKS), F.array().cast(LINKS)), lambda x: secure(x["url"]))
    once = F.filter(kept, lambda x, i: ~F.exists(F.slice(kept, 1, i), lambda y: F.trim(y["url"]) == F.trim(x["url"])))
    return F.transform(F.slice(once, 1, MOST_LINKS), lambda x: F.struct(F.trim(x["url"]).alias("url"), F.coalesce(F.nullif(x["label"], F.lit("")), F.lit(LINK_LABEL)).alias("label"), F.coalesce(F.nullif(x["kind"], F.lit("")), F.lit(LINK_KIND)).alias("kind")))


def recurring(entries: DataFrame) -> DataFrame:
    """The entries of recurring series that a person curated, with a safe id, a name and a link.

    entries: canonical_id, canonical_name, schedule_type, curation_status, official_links. An id that stands twice is for
    `quality.require_unique` to refuse.
    """
    df = entries.withColumn("official_links", series_links(F.col("official_links")))
    ok = F.col("canonical_id").rlike(SAFE_ID) & (F.trim("canonical_name") != "") & (F.col("schedule_type") == "recurring") & (F.col("curation_status") == "human_curated")
    return df.where(ok & (F.size("official_links") > 0))


def series(entries: DataFrame, observations: DataFrame, events: DataFrame, categories: DataFrame, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Pages of series, and their coming events in order.

    observations: canonical_id, observed_at. events: canonical_id, id, starts_at of those to be shown. categories: category,
    of those with a page. Pages: canonical_id, category, observations, latest, upcoming, category_page; events: canonical_id,
    id, starts_at, place. Events stay rows, so a series may have any number of them.
    """
    seen = observations.groupBy("canonical_id").agg(F.count("*").alias("observations"), F.max("observed_at").alias("latest")).where(F.col("observations") >= least)
    known = recurring(entries).select("canonical_id", "category").join(seen, "canonical_id")
    coming = events.select("canonical_id", "id", "starts_at").join(known.select("canonical_id"), "canonical_id", "left_semi")
    counts = coming.groupBy("canonical_id").agg(F.count("*").alias("upcoming"))
    with_page = categories.select("category").distinct().withColumn("_page", F.lit(True))
    pages = known.join(counts, "canonical_id", "left").join(with_page, "category", "left")
    by = Window.partitionBy("canonical_id").orderBy("starts_at", "id")
    return pages.select("canonical_id", "category", "observations", "latest", F.coalesce("upcoming", F.lit(0)).alias("upcoming"), F.coalesce("_page", F.lit(False)).alias("category_page")), coming.withColumn("place", F.row_number().over(by))


def profile_index(events: DataFrame, order: str) -> DataFrame:
    """name, id: the first event with a profile for each normalized name. events: id, canonical_name, title, has_profile, and the order."""
    names = F.array_distinct(F.filter(F.array(*(F.trim(T.nfkc_folded(F.coalesce(c, F.lit("")))) for c in ("canonical_name", "title"))), lambda n: n != ""))
    return events.where("has_profile").select(F.explode(names).alias("name"), "id", order).groupBy("name").agg(F.min_by("id", order).alias("id"))


def pinned(url: Column, host: str, path: str) -> Column:
    """Whether an address is https on that host and path."""
    return F.coalesce(F.startswith(url, F.lit("https://")) & (T.url_host(url) == host) & (T.url_path(url) == path), F.lit(False))


def require_healthy(health: DataFrame, names: list[str]) -> None:
    """Raises ValueError unless each name has rows and all of these are ok. health: name, status. An action."""
    good = health.where(F.col("name").isin(*names)).groupBy("name").agg(F.bool_and(F.coalesce(F.col("status") == "ok", F.lit(False))).alias("ok")).where("ok")
    missing = set(names) - {r["name"] for r in good.collect()}
    if missing:
        raise ValueError(f"not healthy: {', '.join(sorted(missing))}")


def published_health(health: DataFrame, published: DataFrame) -> DataFrame:
    """Counts of what is published in place of the counts before deduplication, which are kept aside. health: name, event_count; published: name, n."""
    before = F.coalesce("normalized_event_count", "event_count") if "normalized_event_count" in health.columns else F.col("event_count")
    p = published.groupBy("name").agg(F.sum("n").alias("_n"))
    return health.join(p, "name", "left").withColumns({"normalized_event_count": before, "event_count": F.coalesce("_n", F.lit(0))}).drop("_n")
