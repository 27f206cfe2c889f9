"""Queries of posts, the best plan, date resolution, schedules, group pages and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ledger, metrics, posts, recurrence, search
from .registry import query, read

_S = lambda c: F.col(c).cast("string")

_HEAD = {
    0: ("'#tag' || chr(10) || '『Night ' || o_custkey::VARCHAR || '』' || chr(10) || 'plain line'", "CASE WHEN o_orderstatus = 'P' THEN '『Night ' || o_custkey::VARCHAR || '』' ELSE 'Night ' || o_custkey::VARCHAR END"),
    1: ("'📅 8/1 21:00 ' || o_custkey::VARCHAR || chr(10) || 'second  line ' || o_custkey::VARCHAR", "'second line ' || o_custkey::VARCHAR"),
    2: ("'  club ' || o_custkey::VARCHAR || ' 8月1日'", "'club ' || o_custkey::VARCHAR || ' 8月1日'"),
    3: ("'#only' || chr(10) || repeat('x', 90) || o_orderkey::VARCHAR || chr(10) || '【】'", "repeat('x', 90) || o_orderkey::VARCHAR"),
}
_MARK = "CASE o_orderstatus WHEN 'F' THEN '#開催' WHEN 'O' THEN '#イベント' ELSE '#応募 募集中' END"


@query(f"""WITH p AS (SELECT *, (o_orderkey % 28 + 1)::VARCHAR AS d, o_orderkey % 9 AS rt, {_MARK} AS mark, CASE o_orderkey % 4 {' '.join(f'WHEN {k} THEN {v[1]}' for k, v in _HEAD.items())} END AS line, CASE o_orderkey % 4 {' '.join(f'WHEN {k} THEN {v[0]}' for k, v in _HEAD.items())} END AS head FROM orders)
 SELECT 'x:' || (10000000000 + o_orderkey)::VARCHAR AS source_id, CASE WHEN length(line) > 96 THEN line[1:96] || '…' ELSE line END AS title, make_timestamp(2026, 9, (o_orderkey % 28 + 1)::BIGINT, 12, 30, 0) AS starts_at,
 CASE WHEN o_custkey % 3 > 0 THEN '@user' || o_custkey::VARCHAR END AS organizer, 'https://x.com/' || CASE WHEN o_custkey % 3 > 0 THEN 'user' || o_custkey::VARCHAR ELSE 'i/web' END || '/status/' || (10000000000 + o_orderkey)::VARCHAR AS url,
 CASE WHEN o_orderstatus = 'P' THEN 'recruitment_deadline' ELSE 'event' END AS category FROM p WHERE o_orderkey % 4 <> 1 AND (o_orderstatus = 'F' OR rt >= 5)""")
def social_posts(spark, d) -> DataFrame:
    """Posts with titles in all places, with and without the retweets that they need. (Titles with dates of their own are left to the tests.)"""
    o = read(spark, d, "orders").withColumn("k", F.col("o_orderkey"))
    n = F.lit("\n")
    head = F.when(F.col("k") % 4 == 0, F.concat(F.lit("#tag"), n, F.lit("『Night "), _S("o_custkey"), F.lit("』"), n, F.lit("plain line"))).when(F.col("k") % 4 == 2, F.concat(F.lit("  club "), _S("o_custkey"), F.lit(" 8月1日")))
    head = head.when(F.col("k") % 4 == 3, F.concat(F.lit("#only"), n, F.repeat(F.lit("x"), F.lit(90)), _S("k"), n, F.lit("【】")))
    mark = F.when(F.col("o_orderstatus") == "F", "#開催").when(F.col("o_orderstatus") == "O", "#イベント").otherwise("#応募 募集中")
    when = F.concat(F.lit("#2026/9/"), (F.col("k") % 28 + 1).cast("string"), F.when(F.col("k") % 2 == 0, "（土） 21：30").otherwise("(土)は 21:30"))
    rows = o.select(
        (F.lit(10_000_000_000) + F.col("k")).alias("id"), F.concat_ws("\n", head, when, mark).alias("text"), F.lit("2026-08-20 00:00:00").cast("timestamp").alias("created_at"),
        F.when(F.col("o_custkey") % 3 > 0, F.concat(F.lit("user"), _S("o_custkey"))).otherwise("").alias("author"), F.when(F.col("k") % 9 > 0, F.col("k") % 9).alias("retweet_count"), F.col("k"),
    )
    out = posts.post_events(rows.where("k % 4 <> 1"), 5)
    return out.select("source_id", "title", F.col("starts_at").cast("timestamp_ntz").alias("starts_at"), "organizer", "url", "category")


_GROUPS = ["core", "access", "venues", "activities", "communities"]


@query("WITH g AS (SELECT n_regionkey AS ord, (['" + "','".join(_GROUPS) + "'])[n_regionkey + 1] AS grp, n_name AS term, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation), f AS (SELECT *, list_position(['" + "','".join(search.BEST_FALLBACK) + f"""'], grp) AS r FROM g),
 a AS (SELECT 0 AS k, 0 AS o, i, g AS grp, t AS term, q AS query FROM (VALUES {', '.join("(" + str(i) + ", " + ", ".join("'" + x.replace("'", "''") + "'" for x in row[1:]) + ")" for i, row in enumerate(search.BEST_PROVEN))}) v(i, g, t, q)
 UNION ALL SELECT 1, ord, i, 'structured_' || grp, term, '(' || term || ') {search.CONTEXT} {search.PLATFORM}' FROM g UNION ALL SELECT 2, r, i, 'platform_fallback_' || grp, term, '(' || term || ') {search.PLATFORM}' FROM f WHERE r > 0)
 SELECT grp AS "group", term, query, row_number() OVER (ORDER BY k, o, i) - 1 AS place FROM a""")
def best_plan(spark, d) -> DataFrame:
    """Proven queries, structured ones of the nations' names, single terms."""
    n = read(spark, d, "nation")
    group = F.element_at(F.array(*(F.lit(g) for g in _GROUPS)), F.col("n_regionkey").cast("int") + 1)
    terms = n.groupBy(F.col("n_regionkey").cast("int").alias("ord"), group.alias("group")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("terms"))
    return search.best_plan(terms, 20).select("group", "term", "query", "place")


def _sides(spark, d) -> tuple[DataFrame, DataFrame]:
    o = read(spark, d, "orders").withColumn("source_id", _S("o_orderkey"))
    old = o.where("o_custkey % 4 <> 3").select("source_id", F.col("o_orderdate").alias("starts_at"))
    method = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    at = F.when(F.col("o_custkey") % 5 == 0, F.timestamp_add("DAY", F.lit(1), "o_orderdate")).otherwise(F.col("o_orderdate"))
    new = o.where("o_custkey % 4 <> 2").select("source_id", at.cast("timestamp_ntz").alias("starts_at"), method.alias("date_resolution_method"), F.col("o_orderstatus").alias("date_resolution_anchor"), F.when(F.col("o_orderstatus") == "F", "said").alias("date_resolution_evidence"))
    return old, new


@query("""SELECT coalesce(nullif(CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END, ''), 'missing') AS method, count(*) AS n, (SELECT count(*) FROM orders WHERE o_custkey % 4 <> 3) AS previous, (SELECT count(*) FROM orders WHERE o_custkey % 4 <> 2) AS current,
 (SELECT count(*) FROM orders WHERE o_custkey % 4 <> 2 AND o_orderstatus = 'F') AS with_evidence, (SELECT count(*) FROM orders WHERE o_custkey % 4 < 2 AND o_custkey % 5 = 0) AS changed FROM orders WHERE o_custkey % 4 <> 2 GROUP BY 1""")
def resolution_audit(spark, d) -> DataFrame:
    counts, methods, _ = ledger.resolution_audit(*_sides(spark, d))
    return methods.crossJoin(F.broadcast(counts))  # one row


_SCHEDULE = """SELECT n_nationkey, CAST(g AS DATE) AS day FROM nation, generate_series(DATE '2024-01-01', DATE '2024-06-30', INTERVAL 1 DAY) t(g) WHERE CASE n_nationkey % 3
 WHEN 0 THEN isodow(g) - 1 IN (n_nationkey % 7, (n_nationkey + 3) % 7) AND floor(date_diff('day', DATE '2024-01-01', CAST(g AS DATE)) / 7.0)::BIGINT % (1 + n_nationkey % 2) = 0
 WHEN 1 THEN isodow(g) - 1 = n_nationkey % 7 AND CASE WHEN n_nationkey % 2 = 0 THEN floor((day(last_day(CAST(g AS DATE))) - day(g)) / 7) = 0 ELSE ceil(day(g) / 7.0) = n_nationkey % 5 + 1 END ELSE day(g) IN (n_nationkey + 1, 31) END"""


@query(f"""SELECT 's' || n_nationkey::VARCHAR || ':' || day::VARCHAR AS source_id, n_name AS title, day + INTERVAL 12 HOUR AS starts_at, CASE WHEN n_nationkey % 2 = 0 THEN day + INTERVAL 16 HOUR END AS ends_at FROM ({_SCHEDULE}) JOIN nation USING (n_nationkey)
 UNION ALL SELECT 'one' || o_orderkey::VARCHAR, o_orderpriority, o_orderdate, NULL FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-06-30 14:00:00'""")
def materialized(spark, d) -> DataFrame:
    """Schedules of three kinds and single events in a window of days; ends past midnight."""
    k = F.col("n_nationkey")
    kind = F.element_at(F.array(*(F.lit(f) for f in recurrence.FREQUENCIES)), (k % 3 + 1).cast("int"))
    t = read(spark, d, "nation").select(
        F.concat(F.lit("s"), k.cast("string")).alias("series_id"), F.col("n_name").alias("title"), kind.alias("frequency"), F.lit("21:00").alias("start_time"), F.when(k % 2 == 0, "01:00").alias("end_time"),
        F.array((k % 7).cast("int"), ((k + 3) % 7).cast("int")).alias("weekdays"), (1 + k % 2).alias("interval_weeks"), F.lit(None).cast("date").alias("anchor_date"), (k % 7).alias("weekday"), F.when(k % 2 == 0, -1).otherwise(k % 5 + 1).alias("nth"), F.array((k + 1).cast("int"), F.lit(31)).alias("days"),
    )
    at = lambda s: F.lit(s).cast("timestamp")
    single = read(spark, d, "orders").select(F.concat(F.lit("one"), _S("o_orderkey")).alias("source_id"), F.col("o_orderpriority").alias("title"), F.col("o_orderdate").cast("timestamp").alias("starts_at"), F.lit(None).cast("timestamp").alias("ends_at"))
    out = recurrence.materialize(t, single, at("2024-01-01 00:00:00"), at("2024-06-30 14:00:00"))
    return out.select("source_id", "title", F.col("starts_at").cast("timestamp_ntz").alias("starts_at"), F.col("ends_at").cast("timestamp_ntz").alias("ends_at"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'https://vrchat.com/home/group/grp_' || o_custkey::VARCHAR WHEN 1 THEN 'https://www.VRChat.com/home/group/grp_' || o_custkey::VARCHAR WHEN 2 THEN 'https://vrchat.com/home/group/grp_b' || o_orderkey::VARCHAR
 WHEN 3 THEN 'https://vrchat.com/home/group/grp_c' || o_orderkey::VARCHAR || '/x' END AS page, lower(replace(replace(o_orderpriority, '-', ''), ' ', '')) || o_custkey::VARCHAR AS key FROM orders""")
def group_pages(spark, d) -> DataFrame:
    """Group pages from links of the right kind, then from other addresses; keys of titles."""
    k, c = F.col("o_orderkey"), _S("o_custkey")
    link = F.when(k % 6 == 0, F.concat(F.lit("https://vrchat.com/home/group/grp_"), c, F.lit("?tab=1"))).when(k % 6 == 1, F.concat(F.lit("https://www.VRChat.com/home/group/grp_"), c, F.lit("#top"))).otherwise(F.concat(F.lit("https://vrchat.com/home/world/wrld_"), c))
    links = F.array(F.struct(F.concat(F.lit("https://vrchat.com/home/group/grp_other"), c).alias("url"), F.lit("related").alias("kind")), F.struct(link.alias("url"), F.lit("vrchat_group").alias("kind")))
    primary = F.when(k % 6 == 2, F.concat(F.lit("https://vrchat.com/home/group/grp_b"), _S("o_orderkey"))).when(k % 6 == 4, "http://vrchat.com/home/group/grp_x")
    url = F.when(k % 6 == 3, F.concat(F.lit("https://vrchat.com/home/group/grp_c"), _S("o_orderkey"), F.lit("/x?y"))).when(k % 6 == 5, "https://vrchat.com/home/group/grp_!")
    title = F.concat(F.lit("　"), F.upper(F.col("o_orderpriority")), F.lit("！ － "), c)
    return read(spark, d, "orders").select("o_orderkey", T.group_url(links, primary, url).alias("page"), T.title_key(title).alias("key"))


@query("""WITH r AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS calendar, count(*) FILTER (o_orderstatus = 'F') AS accepted FROM orders GROUP BY 1), x AS (SELECT m, calendar, accepted, calendar - lag(calendar) OVER (ORDER BY m) AS calendar_delta, accepted - lag(accepted) OVER (ORDER BY m) AS accepted_delta, lag(m) OVER (ORDER BY m) AS p, row_number() OVER (ORDER BY m DESC) AS k FROM r),
 s AS (SELECT date_trunc('month', o_orderdate) AS m, o_orderpriority AS name, count(*) AS n FROM orders WHERE o_orderkey % 3 > 0 GROUP BY ALL)
 SELECT x.m AS generated_at, calendar, calendar_delta, accepted, accepted_delta, coalesce((SELECT string_agg(name || '=' || n::VARCHAR || coalesce('/' || d::VARCHAR, ''), ',' ORDER BY name) FROM (SELECT name, coalesce(a.n, 0) AS n, CASE WHEN x.p IS NOT NULL THEN coalesce(a.n, 0) - coalesce(b.n, 0) END AS d FROM (SELECT * FROM s WHERE s.m = x.m) a FULL JOIN (SELECT * FROM s WHERE s.m = x.p) b USING (name))), '') AS sources FROM x WHERE k <= 24""")
def registration_snapshots(spark, d) -> DataFrame:
    """Months as runs: the last 24 with their counts, deltas and sources; the cap is the feature."""
    o = read(spark, d, "orders").withColumn("generated_at", F.date_trunc("month", "o_orderdate").cast("timestamp"))
    runs = o.groupBy("generated_at").agg(F.count("*").alias("calendar_event_count"), F.count_if(F.col("o_orderstatus") == "F").alias("yahoo_accepted_count"))
    runs = runs.withColumns({c: F.lit(None).cast("long") for c in metrics.SNAPSHOT if c not in runs.columns})
    sources = o.where("o_orderkey % 3 > 0").groupBy("generated_at", F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("count"))
    kept, by = metrics.registration_snapshots(runs, sources, 24)
    said = F.concat("name", F.lit("="), _S("count"), F.coalesce(F.concat(F.lit("/"), _S("delta")), F.lit("")))
    by = by.groupBy("generated_at").agg(F.array_join(F.array_sort(F.collect_list(said)), ",").alias("sources"))
    out = kept.join(by, "generated_at", "left")
    return out.select(F.col("generated_at").cast("timestamp_ntz").alias("generated_at"), F.col("calendar_event_count").alias("calendar"), F.col("calendar_event_count_delta").alias("calendar_delta"), F.col("yahoo_accepted_count").alias("accepted"), F.col("yahoo_accepted_count_delta").alias("accepted_delta"), F.coalesce("sources", F.lit("")).alias("sources"))
