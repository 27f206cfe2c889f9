"""Golden rows of the event operators."""

import pytest
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.operators import graph, ledger, metrics, ontology, quality, rank, recurrence, resolve, rules, scoring
from eventloom.sources import readers, sinks
from eventloom.streaming import ledger as live


def test_accept_reject(spark):
    rows = [
        ("1000000001", "VRChat 朗読ミュージカル 8月19日22:30 遊びに来てください", 10),
        ("1000000002", "VRChat 商品プレゼント フォローとリポストで応募 8月19日22:30", 10),
        ("1000000003", "VRChat 集会 8月19日22:30 開催します", 2),
        ("1000000004", "VRChat キャスト募集 締切 8月19日22:30 まで", 10),
        ("1000000005", "VRChat 配信枠 8月19日22:30 です", 10),
        ("1000000006", "VRChat 誕生日インスタンス開催 8月19日22:30 イベント", 10),
        ("1000000007", "次回3月のVRChat集会 日時：2026/08/19 22:30", 10),
        ("1000000008", "VRChat 集会 8月19日22:30 開催します", None),
        ("1000000009", "VRChat 集会 8月19日22:30 開催します", 10),
        ("12", "VRChat 集会 8月19日22:30 開催します", 10),
        ("1000000010", "short", 10),
        ("1000000011", "今日の集会は8月19日22:30 開催します", 10),
    ]
    df = spark.createDataFrame(rows, "status_id string, text string, retweet_count bigint")
    known = spark.createDataFrame([("1000000009",)], "id string")
    got = {r.status_id: (r.category if r.accepted else r.reason) for r in rules.accept_or_reject(df, F.lit("2026-08-02 08:00:00").cast("timestamp"), rules.RuleSet(), known).collect()}
    assert got == {
        "1000000001": "event", "1000000002": "giveaway_only", "1000000003": "retweet_below_threshold", "1000000004": "recruitment_deadline", "1000000005": "missing_event_marker",
        "1000000006": "missing_participation_method", "1000000007": "conflicting_date_context", "1000000008": "retweet_count_missing", "1000000009": "duplicate_x_source", "12": "invalid_status_id",
        "1000000010": "missing_text", "1000000011": "not_vrchat",
    }


def test_wilson(spark):
    r = spark.range(1).select(metrics.wilson_lower(F.lit(0), F.lit(40)).alias("a"), metrics.wilson_lower(F.lit(14), F.lit(40)).alias("b"), metrics.wilson_lower(F.lit(0), F.lit(0)).alias("c")).first()
    assert r.a == 0.0 and 0.19 < r.b < 0.35 and r.c == 0.0


def test_category_decision(spark):
    cats = [{"id": "music", "priority": 2, "strong_keywords": ["live"], "keywords": ["dj"]}, {"id": "talk", "priority": 1, "strong_keywords": ["seminar"], "keywords": []}]
    df = spark.createDataFrame([(1, "DJ live", None), (2, "hello", None), (3, "live seminar", None), (4, "hello", "talk")], "id int, title string, curated string")
    got = {r.id: (r.category, r.score, r.confidence, r.ambiguous_with, r.decided_by) for r in scoring.category_decision(df, [(F.col("title"), 4)], cats, curated=F.col("curated")).collect()}
    assert got[1] == ("music", 13, 0.935, [], "keyword_rules")
    assert got[2] == ("other", 0, 0.25, [], "fallback")
    assert got[3] == ("music", 8, 0.58, ["talk"], "keyword_rules")
    assert got[4] == ("talk", 100, 0.99, [], "curated_ontology")


def test_organizer_prior(spark):
    rows = [("a", "x", 1), ("a", "x", 2), ("a", "x", 3), ("a", "y", 4), ("b", "x", 5), ("b", "y", 6), (None, "x", 7)]
    got = scoring.organizer_prior(spark.createDataFrame(rows, "o string, category string, i int"), "o", "category", "i").collect()
    assert [(r.o, r.category, r.seed_events, r.dominance) for r in got] == [("a", "x", 3, 0.75)]


def test_first_of_any_key_is_sequential(spark):
    rows = [(1, "k1", None), (2, "k1", "k2"), (3, "k2", None), (4, None, None), (5, "k9", None)]
    known = spark.createDataFrame([("k9",)], "k string")
    got = resolve.first_of_any_key(spark.createDataFrame(rows, "i int, a string, b string"), [F.col("a"), F.col("b")], "i", known).collect()
    assert sorted(r.i for r in got) == [1, 3, 4]


def test_pairs_components_merge(spark):
    rows = [
        ("a", "s", "Org", "第4回 歌の集会を開催します 参加自由", "2026-08-01"), ("b", "s", "org", "第4回 歌の集会を開催いたします 参加自由です", "2026-08-01"),
        ("c", "s", "Org", "第5回 歌の集会を開催します 参加自由", "2026-08-01"), ("d", "s", "Other", "第4回 歌の集会を開催します 参加自由", "2026-08-01"), ("e", "s", "Org", "第4回 歌の集会を開催します 参加自由", "2026-08-02"),
    ]
    df = spark.createDataFrame(rows, "id string, source string, organizer string, description string, starts_at string").withColumn("title", F.lit("t"))
    pairs = resolve.similar_pairs(df)
    assert [(r.a, r.b, r.reason) for r in pairs.collect()] == [("a", "b", "same_organizer_same_start_ordinal")]
    comps = {r.v: r.component for r in resolve.connected_components(spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")).collect()}
    assert comps == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    m = spark.createDataFrame([(1, "p", None, ["x"], 2.0), (1, "q", "u", ["y", "x"], 1.0)], "g int, title string, url string, tags array<string>, c double")
    r = resolve.merge_members(m, "g", [F.col("c")], ["title", "url"], ["tags"], ["title"]).first()
    assert (r.title, r.url, r.tags, r.merged_source_count) == ("p", "u", ["x", "y"], 2)


def test_ledger(spark):
    schema = "status_id string, text string, first_seen string, last_seen string, retweets int, observations int, query_keys array<string>"
    old = spark.createDataFrame([("1", "a", "2026-01-01", "2026-01-02", 8, 1, ["core-001"]), ("2", "b", "2026-01-01", "2026-01-01", 1, 1, [])], schema)
    new = spark.createDataFrame([("1", "a2", "2026-01-05", "2026-01-05", 5, 1, ["access-001"]), ("3", "c", "2026-01-05", "2026-01-05", 0, 1, [])], schema)
    got = {r.status_id: r for r in ledger.merge(old, new).collect()}
    r = got["1"]
    assert (r.text, r.first_seen, r.last_seen, r.retweets, r.observations, r.query_keys) == ("a2", "2026-01-01", "2026-01-05", 8, 2, ["access-001", "core-001"])
    assert sorted(got) == ["1", "2", "3"]
    again = {x.status_id: x.text for x in ledger.merge(ledger.merge(old, new), new.limit(0)).collect()}
    assert again == {"1": "a2", "2": "b", "3": "c"}


def test_recurrence(spark):
    s, e = F.lit("2024-02-01").cast("date"), F.lit("2024-02-29").cast("date")
    w = spark.createDataFrame([(1, [0], 2, "2024-01-29")], "id int, weekdays array<int>, interval_weeks int, a string").withColumn("anchor_date", F.col("a").cast("date"))
    assert [str(r.day) for r in recurrence.weekly(w, s, e).orderBy("day").collect()] == ["2024-02-12", "2024-02-26"]
    n = spark.createDataFrame([(1, 3, 5), (2, 3, -1), (3, 4, 5)], "id int, weekday int, nth int")
    assert [(r.id, str(r.day)) for r in recurrence.monthly_nth(n, s, e).orderBy("id").collect()] == [(1, "2024-02-29"), (2, "2024-02-29")]
    d = spark.createDataFrame([(1, [1, 30])], "id int, days array<int>")
    assert [str(r.day) for r in recurrence.monthly_days(d, s, e).collect()] == ["2024-02-01"]


def test_graph(spark):
    pages = spark.createDataFrame([("p", '<a href="/a?x">1</a><a download href="/z">2</a><a class="q" href="https://o/b#c">3</a>')], "u string, h string")
    edges = graph.link_edges(pages, F.col("u"), "h", F.lit("https://s"))
    assert {r.dst for r in edges.collect()} == {"https://s/a", "https://o/b"}
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6)], "src int, dst int")
    assert {r.node: r.depth for r in graph.bfs(e, spark.createDataFrame([(1,)], "n int")).collect()} == {1: 0, 2: 1, 3: 2}
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 5)], "n int")
    assert {r.n: r.in_degree for r in graph.in_degree(e, nodes, "n").collect()} == {1: 1, 2: 1, 5: 0}
    assert {r.dst for r in graph.broken(e, nodes, "n").collect()} == {3, 6}


def test_bfs_reaches_the_end_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(60)], "src int, dst int")
    assert {r.node: r.depth for r in graph.bfs(e, spark.createDataFrame([(0,)], "n int")).collect()} == {i: i for i in range(61)}


def test_graph_bfs_query_has_no_depth_cap(spark, tmp_path):
    from eventloom.plans import queries as plain

    pages = [(i, f"https://h{i:02}/", f'<a href="https://u{i:02}/a">x</a><a href="https://u{i + 1:02}/a">y</a>') for i in range(8)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.node: r.depth for r in plain.queries()["graph_bfs"](spark, str(tmp_path)).collect()}
    assert got == {f"h{i:02}": 2 * i for i in range(8)} | {f"https://u{i:02}/a": max(1, 2 * i - 1) for i in range(9)}


def test_ontology(spark):
    ev = spark.createDataFrame([("1", "alpha night", "org"), ("2", "pattern only", "x"), ("3", "beta", "y")], "event_id string, body string, organizer string")
    en = spark.createDataFrame([("A", ["alpha"], ["org"], ["night"]), ("B", ["zzz"], ["q"], ["pattern"]), ("C", ["beta"], [], []), ("D", ["beta"], [], [])], "entry_id string, aliases array<string>, organizers array<string>, patterns array<string>")
    got = {r.event_id: (r.status, r.entry_id, r.score) for r in ontology.unique_best(ontology.match_scores(ev, en), ev).collect()}
    assert got == {"1": ("matched", "A", 10), "2": ("unmatched", None, None), "3": ("ambiguous", None, 5)}


def test_rank(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "i int, g int")
    with pytest.raises(ValueError):
        rank.page(df, 0, 0, F.col("i"))
    assert [r.i for r in rank.page(df, 2, 3, F.col("i")).collect()] == [3, 4]
    nxt = {r.i: r.next for r in rank.circular_next(df, "g", "i", "i").collect()}
    assert nxt[0] == 3 and nxt[6] == 0
    c = spark.createDataFrame([("u", 1, 0.9, {"a": 1.0}), ("u", 2, 0.89, {"a": 1.0}), ("u", 3, 0.8, {"b": 1.0})], "user string, item int, score double, features map<string,double>")
    assert [r.item for r in rank.mmr(c, "user", 2).orderBy("rank").collect()] == [1, 3]


def test_mmr_ranks_the_whole_table(spark):
    """The second choice is the 71st by score; random tables against a plain loop over all items."""
    import random

    def plain(items, k, trade=0.82):
        def like(a, b):
            top = sum(max(a.get(x, 0.0), b.get(x, 0.0)) for x in a | b)
            return sum(min(a[x], b[x]) for x in a.keys() & b.keys()) / top if top else 0.0

        chosen, rest = [], list(items)
        while rest and len(chosen) < k:
            best = max(rest, key=lambda r: (trade * r[1] - (1 - trade) * max((like(r[2], c[2]) for c in chosen), default=0.0), -r[0]))
            rest.remove(best)
            chosen.append(best)
        return [c[0] for c in chosen]

    rng = random.Random(4)
    tables = {"late": [(i, 0.9 - i / 10000, {"a": 1.0}) for i in range(70)] + [(70, 0.85, {"b": 1.0})]}
    tables |= {None: [(i, rng.randrange(64) / 64, {x: 1.0 for x in rng.sample("abcdefg", rng.randrange(5))}) for i in range(150)], "few": [(1, 0.5, {}), (2, 0.5, {"a": 2.0})]}
    rows = [(u, *r) for u, t in tables.items() for r in t]
    got = {}
    for r in rank.mmr(spark.createDataFrame(rows, "user string, item int, score double, features map<string,double>"), "user").orderBy("rank").collect():
        got.setdefault(r.user, []).append(r.item)
    assert got == {u: plain(t, 6) for u, t in tables.items()} and got["late"][1] == 70


def test_quality(spark):
    df = spark.createDataFrame([("a", "t"), ("a", "")], "id string, title string").withColumn("row", F.monotonically_increasing_id())
    with pytest.raises(ValueError):
        quality.require_unique(df, "id")
    codes = sorted(r.code for r in quality.feed_audit(df, "row", F.col("id"), F.col("title"), F.lit("x"), F.lit("")).collect())
    assert codes == ["duplicate_identity", "invalid_datetime", "invalid_datetime", "missing_title"]


def test_ics(spark):
    text = "BEGIN:VEVENT\r\nUID:1\r\nSUMMARY:A\\, b\\n c\r\n d\r\nDTSTART;TZID=Asia/Tokyo:20260802T210000\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nUID:2\r\nSUMMARY:bad\r\nEND:VEVENT"
    got = readers.ics_events(spark.createDataFrame([(text,)], "value string"), "value").collect()
    assert [(r.uid, r.title, str(r.starts_at)) for r in got] == [("1", "A, b\n cd", "2026-08-02 12:00:00")]
    from datetime import datetime

    e = spark.createDataFrame([("1", "FREQ=WEEKLY;COUNT=3", datetime(2026, 8, 4, 13), datetime(2026, 8, 4, 14))], "uid string, rrule string, starts_at timestamp, ends_at timestamp")
    x = readers.expand_rrule(e, datetime(2026, 8, 1), datetime(2026, 12, 1)).orderBy("starts_at").collect()
    assert [str(r.starts_at) for r in x] == ["2026-08-04 13:00:00", "2026-08-11 13:00:00", "2026-08-18 13:00:00"] and str(x[0].ends_at) == "2026-08-04 14:00:00"
    folded = spark.createDataFrame([("é" * 60,)], "v string").select(sinks.ics_folded("v").alias("v")).first().v
    assert all(len(line.encode()) <= 75 for line in folded.split("\r\n")) and folded.replace("\r\n ", "") == "é" * 60


def test_jsonld_and_posts(spark):
    page = '<script type="application/ld+json">{"@graph":[{"@type":"MusicEvent","name":"N","startDate":"2026-08-02T21:30:00+09:00","url":"/e","image":["/i.png"]}]}</script>'
    r = readers.jsonld_events(spark.createDataFrame([(page, "https://s/x")], "h string, u string"), "h", "u").first()
    assert (r.title, r.event_url, r.image, str(r.starts_at)) == ("N", "https://s/e", "https://s/i.png", "2026-08-02 12:30:00")
    page = '<script id="__NEXT_DATA__">{"posts":[{"id":"123","displayText":"a &amp; b","rtCount":"1,200"},{"id":"123","displayText":"longer text here"},{"id":"x","text":"n"}]}</script>'
    r = readers.embedded_posts(spark.createDataFrame([(page,)], "h string"), "h").collect()
    assert [(x.status_id, x.text, x.retweet_count) for x in r] == [("123", "a & b", 1200)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "t", "2026-01-02"), ("a", "u", "2026-01-01")], "id string, title string, starts_at string")
    sinks.write_bundle(df, str(tmp_path / "out"), ["title"])
    assert [r.id for r in spark.read.option("header", True).csv(str(tmp_path / "out/table")).orderBy("starts_at").collect()] == ["a", "b"]
    for _ in range(2):
        sinks.append_once(df.select("id"), str(tmp_path / "log"), "id")
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_source_registry(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"id": "1"}, {"id": "2"}]')
    assert readers.collect(spark, {"type": "manual_json", "path": str(tmp_path / "x.json"), "name": "m"}).count() == 2
    with pytest.raises(ValueError):
        readers.collect(spark, {"type": "nope", "name": "m"})


def test_streaming_ledger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "status_id string, text string, seen timestamp, retweets int"
    for i in range(2):
        (tmp_path / f"in/{i}.json").write_text('{"status_id": "1", "text": "t%d", "seen": "2026-01-0%d 00:00:00", "retweets": %d}\n' % (i, i + 1, 5 - i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = live.maintain(stream, str(tmp_path / "ledger"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    r = live.current(spark, str(tmp_path / "ledger")).collect()
    assert len(r) == 1 and (r[0].retweets, r[0].observations) == (5, 2)


def test_similar_pairs_against_plain(spark):
    import difflib
    import itertools

    titles = ["open mic night one", "open mic night two", "open mic nigth one", "reading club", "readings club", "dance"]
    rows = [(str(i), f"t{i % 2}", f"org{i % 3 // 2}", "", titles[i % len(titles)]) for i in range(36)]
    got = {(r.a, r.b) for r in resolve.similar_pairs(spark.createDataFrame(rows, "id string, starts_at string, organizer string, description string, title string")).collect()}
    key = {r.id: r.k for r in spark.createDataFrame(rows, "id string, starts_at string, organizer string, description string, title string").select("id", T.dedup_key(F.col("title")).alias("k")).collect()}
    want = {(a[0], b[0]) for a, b in itertools.permutations(rows, 2) if a[0] < b[0] and a[1:3] == b[1:3] and difflib.SequenceMatcher(None, key[a[0]], key[b[0]]).ratio() >= 0.75}
    assert got == want and want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.v: r.component for r in resolve.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
