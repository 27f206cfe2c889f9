"""Search analytics (query, page, clicks, impressions, position) and plans of search queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import metrics, resolve


def pair_rows(rows: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(one row a query and page, the last by order; one row with the number left out for personal data). rows: keys (array) and measures."""
    df = rows.where(F.size("keys") >= 2).withColumns({"query": F.trim(F.col("keys")[0]), "page": F.trim(F.col("keys")[1])}).where("query <> '' and page <> ''").drop("keys")
    private = T.sensitive(F.col("query"))
    kept = resolve.best_by(df.where(~private), ["query", "page"], [F.col(order)])
    return kept, df.agg(F.count_if(private).alias("redacted"))


def windows(latest: date, days: int = 28) -> tuple[date, date, date, date]:
    """Two windows of equal length that end at the latest final day: previous start and end, current start and end."""
    if days <= 0:
        raise ValueError("a window has one day at least")
    start = latest - timedelta(days=days - 1)
    return start - timedelta(days=days), start - timedelta(days=1), start, latest


def in_window(day: Column, start: date, end: date) -> Column:
    """Closed range; a text that is no date lies outside."""
    return F.coalesce(F.try_to_date(day).between(F.lit(start), F.lit(end)), F.lit(False))


def is_brand(query: Column, terms: list[str]) -> Column:
    return T.has_any(T.clean_text(query), [t for t in terms if t.strip()])


def growth(current: DataFrame, previous: DataFrame, brand_terms: list[str], least: int = 20) -> DataFrame:
    """query, page, measures of both periods with deltas, band, benchmark and estimated missed clicks (null where there is no gap)."""
    both = metrics.compare_periods(current, previous, ["query", "page"], ["clicks", "impressions"])
    place = current.select(F.col("query").alias("_q"), F.col("page").alias("_p"), T.position_band(F.col("position")).alias("band"))
    both = both.join(place, (F.col("query") == F.col("_q")) & (F.col("page") == F.col("_p")), "left").drop("_q", "_p")
    bench = both.where("band is not null").groupBy("band").agg(F.coalesce(F.try_divide(F.sum("clicks").cast("double"), F.sum("impressions").cast("double")), F.lit(0.0)).alias("benchmark"))
    ctr = F.coalesce(F.try_divide(F.col("clicks").cast("double"), F.col("impressions").cast("double")), F.lit(0.0))
    missed = F.when((F.col("impressions") >= least) & (ctr < F.col("benchmark")), (F.col("benchmark") - ctr) * F.col("impressions"))
    return both.join(bench, "band", "left").withColumns({"brand": is_brand(F.col("query"), brand_terms), "missed": missed})


#: Fixed: groups that are only audited, and what their queries look like.
AUDIT_GROUPS = ("commerce_noise", "temporal_audit")
PLATFORM = "(VRChat OR VRC)"
CONTEXT = "(開催 OR 告知 OR 日時 OR OPEN OR オープン OR 開場 OR 開始 OR 営業 OR 本日 OR 今日 OR 明日 OR 今夜 OR 参加 OR JOIN OR リクイン OR Group+)"
RECRUITING = "(締切 OR 〆切 OR 応募期限 OR 面接 OR 募集)"


def query_text(group: Column, term: Column) -> Column:
    around = F.when(group == "recruitment", RECRUITING).when(group.isin(*AUDIT_GROUPS), "").otherwise(CONTEXT)
    return F.regexp_replace(F.concat(F.lit("("), term, F.lit(") "), around, F.lit(f" {PLATFORM}")), "  +", " ")


def plan(groups: DataFrame, least: int = 50) -> DataFrame:
    """key, group, term, query of the groups' terms in order, the first of each query whatever its case. groups: ord, group, terms (array).

    Fewer than `least` queries is an error.
    """
    t = groups.select("ord", "group", F.posexplode("terms").alias("i", "term")).withColumn("term", F.trim("term")).where("term <> ''")
    t = t.withColumn("query", query_text(F.col("group"), F.col("term")))
    slug = F.lower(F.regexp_replace(F.regexp_replace("term", "[^0-9A-Za-zぁ-んァ-ヶ一-龠]+", "-"), "^-+|-+$", ""))
    key = F.concat(F.col("group"), F.lit("-"), F.lpad(F.col("i").cast("string"), 3, "0"), F.lit("-"), F.when(slug == "", "query").otherwise(F.left(slug, F.lit(40))))
    out = resolve.latest(t.withColumn("_k", F.lower("query")), ["_k"], F.col("ord"), F.col("i")).select("ord", "i", key.alias("key"), "group", "term", "query")
    if out.count() < least:
        raise ValueError(f"a plan has at least {least} queries")
    return out


#: Groups of the best plan and its queries that have proved good, as (key, group, term, query).
BEST_STRUCTURED = ("core", "access", "venues", "activities", "communities", "recruitment")
BEST_FALLBACK = ("activities", "communities", "venues", "core")
_ACCESS = '(JOIN OR ジョイン OR リクイン OR reqin OR リクエストインバイト OR "request invite" OR Group+ OR グループインスタンス OR フレンドインスタンス OR 参加方法)'
_ANNOUNCED = "(イベント告知 OR 営業告知 OR 通常営業 OR 開催決定 OR OPEN OR オープン)"
_WHEN = "(開催 OR 告知 OR 日時 OR OPEN OR オープン OR 開場 OR 開始 OR 営業 OR 本日 OR 今日 OR 明日 OR 今夜)"
BEST_PROVEN = (
    ("best-000-abc-full", "ablation_winner", "A+B+C", f"{_ANNOUNCED} {_ACCESS} {PLATFORM}"),
    ("best-001-ac-complement", "ablation_complement", "A+C", f"{_ANNOUNCED} {PLATFORM}"),
    ("best-002-bc-complement", "ablation_complement", "B+C", f"{_ACCESS} {PLATFORM}"),
    ("best-003-event-announcement-access", "lexical_high_precision", "イベント告知系", f"(イベント告知 OR 開催決定 OR 集会 OR 交流会 OR 公演 OR ライブイベント) {_ACCESS} {PLATFORM}"),
    ("best-004-business-open-access", "lexical_high_precision", "営業・OPEN系", f"(営業告知 OR 通常営業 OR OPEN OR オープン OR カフェ営業 OR バー営業) {_ACCESS} {PLATFORM}"),
    ("best-005-participation-method", "lexical_high_precision", "参加方法系", f"(参加方法 OR JOIN制 OR リクイン OR Group+ instance OR グループインスタンス) {_WHEN} {PLATFORM}"),
)


def best_plan(groups: DataFrame, least: int = 100) -> DataFrame:
    """key, group, term, query, place: the proven queries, then those of the plan's structured groups, then single terms of the
    fallback groups; the first of each query whatever its case. groups: as for plan. Fewer than `least` queries is an error.
    """
    spark = groups.sparkSession
    proven = spark.createDataFrame([(0, 0, i, *row) for i, row in enumerate(BEST_PROVEN)], "kind int, ord int, i int, key string, group string, term string, query string")
    own = plan(groups, 0).where(F.col("group").isin(*BEST_STRUCTURED))
    own = own.select(F.lit(1).alias("kind"), "ord", "i", F.concat(F.lit("best-structured-"), "key").alias("key"), F.concat(F.lit("structured_"), "group").alias("group"), "term", "query")
    rank = F.array_position(F.array(*(F.lit(g) for g in BEST_FALLBACK)), F.col("group")).cast("int")
    terms = groups.where(F.col("group").isin(*BEST_FALLBACK)).select(rank.alias("ord"), "group", F.posexplode("terms").alias("i", "term")).withColumn("term", F.trim("term")).where("term <> ''")
    number = F.row_number().over(Window.orderBy("ord", "i")) - 1  # a configuration's terms
    single = terms.select(F.lit(2).alias("kind"), "ord", "i", F.concat(F.lit("best-fallback-"), F.lpad(number.cast("string"), 3, "0")).alias("key"), F.concat(F.lit("platform_fallback_"), "group").alias("group"), "term", F.concat(F.lit("("), "term", F.lit(f") {PLATFORM}")).alias("query"))
    rows = proven.unionByName(own).unionByName(single).withColumn("_k", F.lower("query"))
    out = resolve.latest(rows, ["_k"], F.col("kind"), F.col("ord"), F.col("i"))
    out = out.withColumn("place", (F.row_number().over(Window.orderBy("kind", "ord", "i")) - 1).cast("long")).select("key", "group", "term", "query", "place")
    n = out.count()
    if n < least:
        raise ValueError(f"a plan has at least {least} queries, this one {n}")
    return out


def ablation_plan(blocks: dict[str, str], variants: list[dict], full: str) -> list[dict]:
    """Variants as whole queries; empty or repeated keys and queries, unknown blocks and a missing full variant are errors."""
    out, keys, queries = [], set(), set()
    for v in variants:
        key = (v.get("key") or "").strip()
        missing = [b for b in v.get("blocks", []) if b not in blocks]
        query = (v.get("query") or " ".join(blocks[b].strip() for b in v.get("blocks", []) if b in blocks)).strip()
        if not key or key in keys or missing or not query or query.lower() in queries:
            raise ValueError(f"bad variant: {v}")
        keys.add(key)
        queries.add(query.lower())
        out.append({"key": key, "label": v.get("label") or key, "kind": v.get("kind") or "unspecified", "query": query})
    if full not in keys:
        raise ValueError("the full variant is missing")
    return out


def variant_metrics(found: DataFrame, accepted: DataFrame, ledger: DataFrame) -> DataFrame:
    """variant, candidates, accepted, new_to_ledger and both rates. found: variant, status_id."""
    a = accepted.select("status_id").distinct().withColumn("_a", F.lit(1))
    k = ledger.select("status_id").distinct().withColumn("_k", F.lit(1))
    df = found.distinct().join(a, "status_id", "left").join(k, "status_id", "left")
    out = df.groupBy("variant").agg(F.count("*").alias("candidates"), F.count("_a").alias("accepted"), F.count_if(F.col("_k").isNull()).alias("new_to_ledger"))
    return out.withColumns({"acceptance_rate": F.round(F.col("accepted") / F.col("candidates"), 6), "new_rate": F.round(F.col("new_to_ledger") / F.col("candidates"), 6)})


def exact_target(rows: DataFrame, plan_order: DataFrame, target: int) -> DataFrame:
    """The first `target` candidates by their earliest query in the plan, retweets, id. rows: status_id, query_keys, retweet_count; plan_order: key, index."""
    p = plan_order.select(F.col("key"), F.col("index"))
    first = rows.select("status_id", F.explode_outer("query_keys").alias("key")).join(p, "key", "left").groupBy("status_id").agg(F.min("index").alias("_first"))
    return rows.join(first, "status_id", "left").orderBy(F.asc_nulls_last("_first"), F.desc(F.coalesce("retweet_count", F.lit(0))), "status_id").limit(target).drop("_first")


def observed_entities(events: DataFrame) -> DataFrame:
    """entity, n, latest start, five sample ids, three titles, categories with counts. events: official_x_url, organizer, id, title, category, starts_at."""
    x = F.when(F.startswith("official_x_url", F.lit("https://")), F.lower(F.rtrim(F.col("official_x_url"), F.lit("/"))))
    df = events.withColumn("entity", F.coalesce(x, F.nullif(F.lower(F.trim("organizer")), F.lit("")))).where("entity is not null")
    base = df.groupBy("entity").agg(F.count("*").alias("n"), F.max("starts_at").alias("latest"))
    firsts = resolve_top(df, "id", 5).withColumnRenamed("id", "sample_ids").join(resolve_top(df, "title", 3).withColumnRenamed("title", "titles"), "entity")
    kinds = df.where("category is not null").groupBy("entity", "category").agg(F.count("*").alias("k")).groupBy("entity").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "k")))).alias("categories"))
    return base.join(firsts, "entity").join(kinds, "entity", "left")


def resolve_top(df: DataFrame, column: str, k: int) -> DataFrame:
    from . import rank

    d = df.select("entity", column).where(F.col(column).isNotNull()).distinct()
    return rank.top_k(d, ["entity"], k, F.col(column)).groupBy("entity").agg(F.array_sort(F.collect_list(column)).alias(column))


def observation_counts(entities: DataFrame) -> DataFrame:
    """series, n, latest of entities that match one series; an entity of several is an error. entities: entity, matched (map to long), latest."""
    m = entities.select("entity", "latest", F.explode("matched").alias("series", "k")).where("k > 0")
    twice = m.groupBy("entity").count().where("count > 1").select("entity").limit(5).collect()
    if twice:
        raise ValueError("ambiguous series: " + ", ".join(sorted(r.entity for r in twice)))
    return m.groupBy("series").agg(F.sum("k").alias("n"), F.max("latest").alias("latest"))
