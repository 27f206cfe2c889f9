"""Queries of posts, links, search analytics and the events built from sources: the library's operators on generated cases, and the SQL for the same rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import events as E
from ..operators import graph, ledger, links, rank, recurrence, rules, search
from ..sources import readers
from .curation_queries import _pick
from .registry import query, read

_S = lambda c: F.col(c).cast("string")
_AT = lambda s: F.lit(s).cast("timestamp")


def _say(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


@query("""SELECT s_suppkey, left(sha256('src:' || s_suppkey), 20) AS id, CASE WHEN s_suppkey % 5 <> 0 THEN 'a ' || s_suppkey END AS title, TIMESTAMP '2024-05-01 12:00:00' AS starts_at, s_name AS organizer,
 CASE WHEN s_suppkey % 3 = 0 THEN 0.3 ELSE 1.0 END::DOUBLE AS confidence, s_suppkey % 3 = 0 AS review_required, CASE WHEN s_suppkey % 5 = 0 THEN 'event has no title' END AS error FROM supplier""")
def built_events(spark, d) -> DataFrame:
    """Raw rows with other field names: some without a title, some whose end lies before the start."""
    k = F.col("s_suppkey")
    raw = read(spark, d, "supplier").select(_S("s_suppkey").alias("uid"), F.when(k % 5 != 0, _say(" a 　", _S("s_suppkey"))).otherwise("").alias("name"), F.lit("2024-05-01T21:00:00+09:00").alias("start"), F.when(k % 3 == 0, "2024-05-01T11:00:00Z").otherwise("2024-05-01T13:00:00Z").alias("ends_at"), F.col("s_name").alias("host"))
    out = E.build(raw, "src", _AT("2024-01-01 00:00:00"))
    return out.select(F.col("source_id").cast("long").alias("s_suppkey"), "id", "title", F.col("starts_at").cast("timestamp_ntz").alias("starts_at"), "organizer", "confidence", "review_required", "error")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN (p_partkey % 1000)::VARCHAR END AS ordinal, CASE WHEN p_partkey % 2 = 0 THEN '第' || (p_partkey % 1000) || '回 party' ELSE 'first line' END AS title FROM part""")
def ordinals_and_titles(spark, d) -> DataFrame:
    n = (F.col("p_partkey") % 1000).cast("string")
    text = F.when(F.col("p_partkey") % 2 == 0, _say("intro\n第", F.translate(n, "0123456789", "０１２３４５６７８９"), "回 party\nend")).otherwise("\n first  line\nsecond")
    plain = F.when(F.col("p_partkey") % 2 == 0, _say("intro\n第", n, "回  party\nend")).otherwise(text)
    return read(spark, d, "part").select("p_partkey", T.event_ordinal(text).alias("ordinal"), T.title_line(plain, "party").alias("title"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN '10' || s_suppkey END AS status_id, CASE WHEN s_suppkey % 4 < 2 THEN 'u' || s_suppkey END AS author FROM supplier")
def post_ids(spark, d) -> DataFrame:
    s = _S("s_suppkey")
    url = _pick(F.col("s_suppkey"), [_say("https://x.com/u", s, "/status/10", s, "?s=1"), _say("https://www.twitter.com/u", s), _say("https://other.example/u/status/1"), F.lit(None).cast("string")])
    return read(spark, d, "supplier").select("s_suppkey", T.status_id(url).alias("status_id"), T.author_of(url).alias("author"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 1000 + p_partkey % 1000 WHEN 1 THEN p_partkey END::BIGINT AS n, p_partkey % 5 IN (0, 4) AS marked FROM part")
def counts_and_markers(spark, d) -> DataFrame:
    """Counts written with commas, or not numbers; markers that letters follow, and that none follow."""
    k, s = F.col("p_partkey"), _S("p_partkey")
    count = _pick(k, [_say("1,", F.lpad((k % 1000).cast("string"), 3, "0")), s, F.lit("many"), F.lit(None).cast("string")])
    marked = _pick(k, [F.lit(v) for v in ("#VRCイベント", "a vrchat2", "VRCSDK", "none", "VRC_EDU x")])
    return read(spark, d, "part").select(k, T.guarded_long(count).alias("n"), T.marker(marked, "vrc").alias("marked"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'event' WHEN 1 THEN 'recruitment_deadline' END AS category,
 CASE o_orderkey % 6 WHEN 2 THEN 'product_only' WHEN 3 THEN 'giveaway_only' WHEN 4 THEN 'not_vrchat' WHEN 5 THEN 'missing_event_marker' END AS reason FROM orders""")
def classify_simple(spark, d) -> DataFrame:
    texts = ("VRChat イベント 開催", "VRChat キャスト募集 締切 あり", "VRChat booth 販売", "VRChat プレゼント", "party イベント", "VRChat こんにちは")
    category, reason = rules.simple(_pick(F.col("o_orderkey"), [F.lit(t) for t in texts]), rules.RuleSet())
    return read(spark, d, "orders").select("o_orderkey", category.alias("category"), reason.alias("reason"))


@query("SELECT s_suppkey, 'https://a.example/' || s_suppkey AS url, 'field:url' AS evidence FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'https://b.example/' || s_suppkey, 'text:body' FROM supplier")
def link_evidence(spark, d) -> DataFrame:
    s = _S("s_suppkey")
    e = read(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, _say("https://a.example/", s, "#top")).alias("url"), _say("see https://b.example/", s, "). or http://c.example/x").alias("body"))
    return links.source_urls(e, "s_suppkey", ["url"], ["body"])


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'https://long.example/' WHEN 1 THEN 'https://bit.ly/' ELSE 'https://x.example/' END || s_suppkey AS url,
 CASE s_suppkey % 3 WHEN 0 THEN 'redirect' WHEN 1 THEN 'unresolved_shortener' ELSE 'direct' END AS resolution FROM supplier""")
def shorteners(spark, d) -> DataFrame:
    k, s = F.col("s_suppkey"), _S("s_suppkey")
    urls = read(spark, d, "supplier").select(k, F.concat(_pick(k, [F.lit("https://t.co/"), F.lit("https://bit.ly/"), F.lit("https://x.example/")]), s).alias("url"))
    targets = read(spark, d, "supplier").where(k % 3 == 0).select(_say("https://t.co/", s).alias("url"), _say("https://long.example/", s).alias("target"))
    return links.resolved(urls, targets).select(k, "url", "resolution")


@query("""SELECT s_suppkey, 'https://forms.gle/' || s_suppkey || ' https://x.com/a/status/' || s_suppkey AS official, 'https://youtu.be/' || s_suppkey AS related, 'https://forms.gle/' || s_suppkey AS primary_action_url, 3::BIGINT AS links,
 'https://forms.gle/' || s_suppkey || ' https://own.example/' || s_suppkey AS actions FROM supplier""")
def link_summaries(spark, d) -> DataFrame:
    s = _S("s_suppkey")
    made = F.array(*(_say(p, s) for p in ("https://youtu.be/", "https://x.com/a/status/", "https://forms.gle/", "https://forms.gle/")))
    urls = read(spark, d, "supplier").select("s_suppkey", F.explode(made).alias("url")).withColumn("evidence", F.lit("field:url"))
    out = links.summary(links.ranked(urls, "s_suppkey"), "s_suppkey")
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["url"]), " ")
    first = F.transform(F.slice("official_links", 1, 1), lambda x: x["url"])
    actions = links.action_links(F.col("primary_action_url"), first, _say("https://own.example/", s))
    return out.select("s_suppkey", joined("official_links").alias("official"), joined("related_links").alias("related"), "primary_action_url", "links", F.array_join(actions, " ").alias("actions"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-13 00:00:00'")
def retained_rows(spark, d) -> DataFrame:
    rows = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("last_seen"))
    return ledger.retained(rows, _AT("2024-01-20 00:00:00"), 7).select("event_id")


@query("SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def history_cap(spark, d) -> DataFrame:
    """The hundred rows seen last: the cap is the feature."""
    return ledger.capped(read(spark, d, "events").select("event_id", F.col("ts").alias("last_seen")), 100, "event_id").select("event_id")


@query("""SELECT s_suppkey, 's' || (s_suppkey % 3) AS source, 'new' AS run FROM supplier WHERE s_nationkey < 12 UNION ALL SELECT s_suppkey, 's1', 'old' FROM supplier WHERE s_suppkey % 3 = 1""")
def stale_sources(spark, d) -> DataFrame:
    s = read(spark, d, "supplier").withColumn("source", _say("s", (F.col("s_suppkey") % 3).cast("string")))
    fresh, old = s.where("s_nationkey < 12").select("s_suppkey", "source", F.lit("new").alias("run")), s.select("source", "s_suppkey", F.lit("old").alias("run"))
    return readers.with_stale(fresh, old, ["s1"])


@query("SELECT s_suppkey, 'new' AS run FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'old' FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 2 <> 0")
def cache_union(spark, d) -> DataFrame:
    s = read(spark, d, "supplier").select("s_suppkey")
    return E.merge_cache(s.where("s_suppkey % 3 = 0").withColumn("run", F.lit("old")), s.where("s_suppkey % 2 = 0").withColumn("run", F.lit("new")), "s_suppkey")


_MADE = "make_timestamp({y}, month(o_orderdate), least(day(o_orderdate), 28), 12, 0, 0)"


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN {_MADE.format(y="2026")} WHEN {_MADE.format(y="2024")} < TIMESTAMP '2024-05-01 00:00:00' THEN {_MADE.format(y="2025")} ELSE {_MADE.format(y="2024")} END AS starts_at,
 'https://x.com/u/status/' || o_orderkey AS url FROM orders WHERE o_orderkey % 3 < 2""")
def post_events(spark, d) -> DataFrame:
    """Posts of 2024-06-15 with a year, with the next year where the day is more than 45 days past, and without a date."""
    day = _say(F.month("o_orderdate").cast("string"), "月", F.least(F.dayofmonth("o_orderdate"), F.lit(28)).cast("string"), "日")
    text = _pick(F.col("o_orderkey"), [_say("show 2026年", day, " 21時 open"), _say("show ", day, " 21:00 open"), F.lit("show soon, 21:00")])
    p = read(spark, d, "orders").select("o_orderkey", _S("o_orderkey").alias("id"), text.alias("text"), _AT("2024-06-15 00:00:00").alias("created_at"), F.lit("u").alias("author"))
    return E.posts_to_events(p).select("o_orderkey", F.col("starts_at").cast("timestamp_ntz").alias("starts_at"), "url")


_DAY = "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)"


@query(f"""SELECT o_orderkey, {_DAY} + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 14 HOUR ELSE INTERVAL 11 HOUR END AS starts_at, {_DAY} + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 16 HOUR ELSE INTERVAL 810 MINUTE END AS ends_at FROM orders""")
def local_times(spark, d) -> DataFrame:
    """Days with local clocks; an end before the start lies on the next day."""
    even = F.col("o_orderkey") % 2 == 0
    start, end = recurrence.at_local_time(F.col("o_orderdate").cast("date"), F.when(even, "23:00").otherwise("20:00"), F.when(even, "01:00").otherwise("22:30"))
    return read(spark, d, "orders").select("o_orderkey", start.cast("timestamp_ntz").alias("starts_at"), end.cast("timestamp_ntz").alias("ends_at"))


@query("""SELECT o_orderkey, o_orderkey % 7 <> 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-03' AND DATE '1996-01-30' AS before, o_orderkey % 7 <> 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-31' AND DATE '1996-02-27' AS now,
 contains(lower(o_orderpriority), 'urgent') AS brand FROM orders""")
def comparison_windows(spark, d) -> DataFrame:
    a, b, c, e = search.windows(date(1996, 2, 27))
    day = F.when(F.col("o_orderkey") % 7 == 0, "no date").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return read(spark, d, "orders").select("o_orderkey", search.in_window(day, a, b).alias("before"), search.in_window(day, c, e).alias("now"), search.is_brand(F.col("o_orderpriority"), ["Urgent", " "]).alias("brand"))


@query("SELECT p_brand AS query, p_name AS page, max(p_partkey) AS ord FROM part WHERE p_partkey % 10 > 1 GROUP BY 1, 2")
def query_pages(spark, d) -> DataFrame:
    """One row a query and page, the last one's; queries with an address of a person and rows with one key are left out."""
    k = F.col("p_partkey")
    keys = F.when(k % 10 == 0, F.array(F.lit("mail a@b.example"), F.col("p_name"))).when(k % 10 == 1, F.array("p_brand")).otherwise(F.array(_say(" ", F.col("p_brand")), F.col("p_name")))
    return search.pair_rows(read(spark, d, "part").select(keys.alias("keys"), k.alias("ord")), "ord")[0].select("query", "page", "ord")


@query("""WITH f AS (SELECT DISTINCT 'v' || l_linenumber AS variant, l_orderkey FROM lineitem)
 SELECT variant, count(*) AS candidates, count(*) FILTER (o_orderstatus = 'F') AS accepted, count(*) FILTER (f.l_orderkey % 2 <> 0) AS new_to_ledger, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS acceptance_rate
 FROM f LEFT JOIN orders ON o_orderkey = f.l_orderkey GROUP BY variant""")
def variant_counts(spark, d) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("status_id"), "o_orderstatus")
    found = read(spark, d, "lineitem").select(_say("v", _S("l_linenumber")).alias("variant"), F.col("l_orderkey").alias("status_id"))
    known = found.select("status_id").where("status_id % 2 = 0")
    return search.variant_metrics(found, o.where("o_orderstatus = 'F'"), known).select("variant", "candidates", "accepted", "new_to_ledger", "acceptance_rate")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'occ_kept' ELSE 'occ_' || left(sha256(CASE s_suppkey % 5 WHEN 1 THEN 'url|t|https://a.example/' || s_suppkey WHEN 2 THEN 'text|t|body' || s_suppkey
 WHEN 3 THEN 'organizer-ordinal|t|o|' || s_suppkey ELSE 'members|t|src_a|src_b' || s_suppkey END), 20) END AS id FROM supplier""")
def occurrence_ids(spark, d) -> DataFrame:
    """Ids kept, by address, by text, by organizer and ordinal, by members."""
    k, s = F.col("s_suppkey") % 5, _S("s_suppkey")
    none = F.array().cast("array<string>")
    some = lambda when, *values: F.when(when, F.array(*values)).otherwise(none)
    made = E.occurrence_id(
        F.lit("t"), some(k == 1, _say("https://a.example/", s)), some(k == 2, _say("body", s)), some(k.isin(3, 4), F.lit("o")), some(k == 3, s),
        F.when(k == 1, F.array(F.lit("same_canonical_url"))).otherwise(F.array(F.lit("exact_text_same_start"))), F.array(_say("src_b", s), F.lit("src_a")), some(k == 0, F.lit("occ_kept")),
    )
    return read(spark, d, "supplier").select("s_suppkey", made.alias("id"))


@query("SELECT o_orderkey AS src, o_custkey AS dst FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12)")
def broken_links(spark, d) -> DataFrame:
    edges = read(spark, d, "orders").select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    return graph.broken(edges, read(spark, d, "customer").where("c_nationkey < 12"), "c_custkey").select("src", "dst")


@query("""SELECT p_partkey, 'group:' || lower(p_brand) AS key, 2.6::DOUBLE AS weight FROM part UNION ALL SELECT p_partkey, 'organizer:' || lower(trim(p_name)), 2.15 FROM part WHERE p_partkey % 2 = 0
 UNION ALL SELECT p_partkey, 'tag:t' || (p_partkey % 3), 1.35 FROM part UNION ALL SELECT p_partkey, 'tag:all', 1.35 FROM part""")
def feature_keys(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    tags = F.array(_say("T", (k % 3).cast("string")), F.lit(" all "), F.lit(""), F.lit("ALL"))
    rows = rank.event_features({"group": F.col("p_brand"), "organizer": F.when(k % 2 == 0, F.col("p_name")).otherwise(" ")}, tags)
    return read(spark, d, "part").select(k, F.inline(rows))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 0.83::DOUBLE * a + 0.13::DOUBLE * u + 0.04::DOUBLE * 0.5::DOUBLE - 0.18::DOUBLE * seen ELSE 0.82::DOUBLE * u + 0.18::DOUBLE * 0.5::DOUBLE END AS score
 FROM (SELECT event_id, (event_id % 10)::DOUBLE / 10::DOUBLE AS a, (event_id % 3 = 0)::INTEGER::DOUBLE AS seen, CASE WHEN event_id % 200 BETWEEN 20 AND 140 THEN 1::DOUBLE / (1::DOUBLE + (event_id % 200 - 20)::DOUBLE / 12::DOUBLE) ELSE 0::DOUBLE END AS u FROM events)""")
def recommendation_scores(spark, d) -> DataFrame:
    i = F.col("event_id")
    soon = rank.start_utility((i % 200 - 20).cast("double"))
    score = rank.recommendation_score(F.when(i % 2 == 0, (i % 10) / 10), soon, F.lit(0.5), (i % 3 == 0).cast("int"))
    return read(spark, d, "events").select(i, score.alias("score"))
