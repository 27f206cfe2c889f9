"""Components, alike texts, merging: against plain versions."""

import difflib
import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.operators import durable, graph, likeness, resolve, similarity


def plain_components(edges):
    parent = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {v: find(v) for v in list(parent)}


def grid(n):
    return [(i * n + j, i * n + j + 1) for i in range(n) for j in range(n - 1)] + [(i * n + j, (i + 1) * n + j) for i in range(n - 1) for j in range(n)]


SHAPES = {
    "chain of 40": ([(i, i + 1) for i in range(40)], 20), "chain of 1,000": ([(i, i + 1) for i in range(1000)], 20), "chain of 10,000": ([(i + 1, i) for i in range(10_000)], 20),
    "grid": (grid(30), 12), "loops": ([(3, 3), (4, 4), (4, 5)], 2), "nothing": ([], 0),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_components(spark, shape):
    edges, most = SHAPES[shape]
    found, rounds = resolve._components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.v: r.component for r in found.collect()} == plain_components(edges)
    assert rounds <= most


def test_components_of_a_hub(spark):
    n = 100_000
    found, rounds = resolve._components(spark.range(1, n + 1).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")))
    assert rounds <= 4
    assert found.agg(F.count("*"), F.min("component"), F.max("component")).first()[:] == (n + 1, 0, 0)


def test_rounds_have_plain_sizes(spark):
    """What is read back is as large as its files, however often tables are joined."""
    tables = durable.Rounds(spark)
    df = tables.put(spark.range(1000))
    for _ in range(6):
        last, df = df, tables.put(df.join(df.withColumnRenamed("id", "x"), F.col("id") == F.col("x")).select("id"))
        tables.drop(last)
    assert int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 24
    assert len(tables.tables) == 1 and df.count() == 1000 and tables.bytes(df) > 0


def test_depths_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(25)], "src long, dst long")
    assert {r.node: r.depth for r in graph.bfs(edges, spark.createDataFrame([(0,)], "n long")).collect()} == {i: i for i in range(26)}


def test_common_subsequence():
    rng = random.Random(1)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for _ in range(500):
        a, b = ("".join(rng.choice("abcé字") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert similarity.common_subsequence(similarity._places(a), len(a), b) == plain(a, b)
        if a and b:
            assert round(difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() * (len(a) + len(b)) / 2) <= plain(a, b)


def made(n, seed, blocks=3):
    rng = random.Random(seed)
    words = ["open", "mic", "night", "jazz", "bar", "夜", "第3回", "クラブ", "x", "club", "dance", "2026"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
    base = [text() for _ in range(12)]
    rows = []
    for i in range(n):
        t = rng.choice(base)
        if rng.random() < 0.5:
            k = rng.randint(0, len(t))
            t = t[:k] + rng.choice(["", "z", " live"]) + t[k + rng.randint(0, 3) :]
        rows.append((f"{i:04d}", rng.choice(["t1", "t1", None]), rng.choice([f"org{j}" for j in range(blocks)] + [None]), rng.choice(["", None, t]), t, rng.choice([None, "https://a.example/1", f"https://a.example/{i}"])))
    return rows


SCHEMA = "id string, starts_at string, organizer string, description string, title string, url string"


def plain_pairs(spark, rows, least):
    df = resolve._keys(spark.createDataFrame(rows, SCHEMA), "id").collect()
    for x, y in itertools.permutations(df, 2):
        if x.id < y.id and (x["at"], x.org) == (y["at"], y.org) and x.key and y.key:
            s = difflib.SequenceMatcher(None, x.key, y.key, autojunk=False).ratio()
            if s >= least:
                yield x, y, s


@pytest.mark.parametrize("chunk", [1024, 7])
def test_alike_pairs_are_all_pairs(spark, monkeypatch, chunk):
    """Whole blocks, and blocks cut into chunks."""
    monkeypatch.setattr(similarity, "CHUNK", chunk)
    rows = made(150, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    want, ambiguous = set(), set()
    for x, y, s in plain_pairs(spark, rows, 0.45):
        ordinal, same = x.nth is not None and s >= 0.5, x.nth == y.nth
        if same and (ordinal or s >= 0.75):
            want.add((x.id, y.id, "same_organizer_same_start_ordinal" if ordinal else "same_organizer_same_start_high_similarity"))
        elif not (x.url and x.url == y.url):
            ambiguous.add((x.id, y.id))
        if same and (ordinal or s >= 0.75) and x.url and x.url == y.url:
            ambiguous.discard((x.id, y.id))
    assert {(r.a, r.b, r.reason) for r in resolve.similar_pairs(df).collect()} == want and len({w[2] for w in want}) == 2
    assert {(r.a, r.b) for r in resolve.ambiguous_pairs(df).collect()} == ambiguous and ambiguous


def test_a_large_block_is_measured_in_part(spark):
    """5,000 different texts of one block: few pairs reach the slow measure, and no task has more than two chunks."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))
    rows = [(i, f"{word()} {word()} {word()} {i}", 0.75, None) for i in range(5000)]
    rows += [(5000 + i, rows[i][1] + "s", 0.75, None) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, key string, least double, carry string").withColumn("at", F.lit("t"))
    c = similarity.filter_counts(df, ["at"]).first()
    assert c.pairs == 5050 * 5049 // 2 and c.measured < 0.02 * c.pairs
    found = {(r.l, r.r) for r in similarity.alike_pairs(df, ["at"]).collect()}
    assert {(i, 5000 + i) for i in range(50)} <= found
    most = similarity._dealt(df, ["at"]).groupBy(F.spark_partition_id(), "_i", "_j").count().agg(F.max("count")).first()[0]
    assert most < 2.5 * similarity.CHUNK


def test_evidence_of_a_hot_key(spark):
    df = spark.range(5000).select(F.col("id").alias("i"), F.lit("b").alias("block"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    e = resolve.evidence_edges(df, {"same": F.col("k")}, "i", ["block"])
    assert e.agg(F.min("a"), F.max("a"), F.count("*")).first()[:] == (1, 1, 3332)


LINKS = "array<struct<url:string,label:string>>"
MEMBERS = f"cluster int, place long, id string, source_record_id string, source string, source_id string, url string, organizer string, fetched_at string, confidence double, starts_at string, title string, description string, tags array<string>, image_url string, official_links {LINKS}, provenance array<struct<source_record_id:string,event_id:string,source:string,source_id:string,url:string,organizer:string,fetched_at:string>>"


def members(spark):
    old = ("r0", "e0", "x", None, None, None, None)
    rows = [
        (1, 0, "e1", "r1", "yahoo_realtime_events", "s1", None, "o", "2026-01-01", 0.5, "t1", "low", "abcdef", ["b", " ", "a"], "i1", [("https://a.example/x?utm_source=q", "first"), (None, "n")], [old]),
        (1, 1, "e2", "r2", "repository_manual_events", "s2", "u2", "o", "2026-01-02", 0.9, "t1", "best", "abcdeg", ["c", "a"], "", [("https://a.example/x", "second"), ("https://a.example/y", "y")], [("r1", "other", "x", None, None, None, None), old]),
        (1, 2, "e3", "r3", "x_curated_events", "s3", None, None, None, None, "t1", "mid", None, None, "i3", None, None),
        (2, 3, "e4", "r4", "x", "s4", None, None, None, 0.1, "t1", "alone", "xyz", [], None, [], []),
    ]
    matches = spark.createDataFrame([(1, "same_canonical_url", 1.0), (1, "exact_text_same_start", 0.99), (1, "exact_text_same_start", 0.99)], "cluster int, reason string, confidence double")
    return spark.createDataFrame(rows, MEMBERS), matches


def test_merged_clusters(spark):
    m, matches = members(spark)
    got = {r.cluster: r for r in resolve.merged_clusters(m, matches, ["title", "organizer", "starts_at"]).collect()}
    r = got[1]
    assert (r.title, r.source_record_id, r.image_url, r.tags, r.members) == ("best", "r2", "i3", ["a", "b", "c"], 3)
    assert (r.merge_reason, r.merge_confidence) == (["exact_text_same_start", "same_canonical_url"], 0.99)
    assert [(p.source_record_id, p.event_id) for p in r.provenance] == [("r0", "e0"), ("r1", "e1"), ("r2", "e2"), ("r3", "e3")] and r.merged_source_count == 4
    assert [x.label for x in r.official_links] == ["first", "y", "n"]
    assert (got[2].merge_reason, got[2].merge_confidence, got[2].merged_source_count, got[2].tags) == ([], 1.0, 1, [])


def test_audit_of_clusters(spark):
    m, matches = members(spark)
    a = resolve.cluster_audit(m, matches)
    r, = a.collect()
    assert (r.member_count, r.member_ids, r.reasons, r.confidence, r.representative) == (3, ["e1", "e2", "e3"], ["exact_text_same_start", "same_canonical_url"], 0.99, "r2")
    t = resolve.audit_totals(m, a, spark.range(2)).first()
    assert tuple(t) == (4, 2, 1, 2, 0.5, 0, 2)
    none = resolve.audit_totals(m.limit(0), a.limit(0), spark.range(0)).first()
    assert tuple(none) == (0, 0, 0, 0, 0.0, 0, 0)


def test_negative_samples(spark):
    rng = random.Random(4)
    for _ in range(4):
        rows = [(rng.randint(0, 14), i, f"e{i}", rng.choice(["t1", "t2", None, "t3"]), rng.choice(["abcd", "abce", ""]), f"title {i}") for i in range(60)]
        rows = [(c * 10 + ["t1", "t2", None, "t3"].index(at), i, e, at, d, t) for c, i, e, at, d, t in rows]
        df = spark.createDataFrame(rows, "cluster int, place long, id string, starts_at string, description string, title string")
        want = []
        for at in dict.fromkeys(r[3] for r in rows):
            want += [(x[2], y[2]) for x, y in itertools.combinations([r for r in rows if r[3] == at], 2) if x[0] != y[0]]
        assert [(r.left_id, r.right_id) for r in resolve.negative_samples(df).collect()] == want[:10]


@pytest.mark.parametrize("chunk", [1024, 5])
def test_classes_say_what_all_pairs_say(spark, monkeypatch, chunk):
    """Each pair follows from one link of classes and the members, with its likeness; copies add members, not links."""
    monkeypatch.setattr(similarity, "CHUNK", chunk)
    rows = made(60, 3, 1)
    rng = random.Random(5)
    copies = [(f"{rng.randint(0, 9999):04d}x{k}", *r[1:]) for k in range(3) for r in rows[:40]]
    df = spark.createDataFrame(rows + copies, SCHEMA)
    for pairs, classes, value in ((resolve.similar_pairs, resolve.similar_classes, "confidence"), (resolve.ambiguous_pairs, resolve.ambiguous_classes, "similarity")):
        found = classes(df).collect()
        of = {}
        for r in found:
            if r.copy:
                of[r.b] = r.a
        member = {}
        for i in df.select("id").collect():
            member.setdefault(of.get(i.id, i.id), []).append(i.id)
        links = [(of.get(r.a, r.a), of.get(r.b, r.b), r[value]) for r in found if not r.copy]
        assert len({x[:2] for x in links}) == len(links) and of
        got = {(i, j, s) for a, b, s in links for i in member[a] for j in member[b] if i < j}
        want = {(r.a, r.b, r[value]) for r in pairs(df).collect()}
        if value == "confidence":
            kept = {r.a: r.confidence for r in found if r.copy}
            got |= {(i, j, kept[a]) for a, m in member.items() for i, j in itertools.combinations(sorted(m), 2)}
        assert got == want and want
        assert {(r.a, r.b) for r in found if not r.copy} <= {x[:2] for x in want}
        assert len(found) < len(want)


def test_queries_of_pairs_grow_with_the_copies(spark, tmp_path):
    """Twenty copies of each name: twenty times the rows at most, where their pairs are four hundred times as many."""
    from eventloom.plans import queries as plain

    n = {}
    for times in (1, 20):
        rows = [(i + 1000 * k, f"Customer#{i:09d}", 1, "S") for i in range(12) for k in range(times)]
        spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/{times}/customer.parquet")
        for q in ("similar_pairs", "ambiguous_pairs"):
            n[q, times] = plain.queries()[q](spark, f"{tmp_path}/{times}").count()
    assert n["similar_pairs", 1] and all(n[q, 20] <= 2 * n[q, 1] + 12 * 19 for q in ("similar_pairs", "ambiguous_pairs"))


@pytest.mark.parametrize("small", [False, True])
def test_counts_say_how_many_pairs_a_row_is_in(spark, monkeypatch, small):
    """Whole blocks, and blocks, and classes of copies, cut into parts; a row an id, also without a pair."""
    if small:
        monkeypatch.setattr(similarity, "CLASSES", 9)
        monkeypatch.setattr(similarity, "MEMBERS", 3)
    rows = made(90, 7, 2)
    rng = random.Random(8)
    copies = [(f"{rng.randint(0, 9999):04d}x{k}", *r[1:]) for k in range(3) for r in rows[:30]]
    df = spark.createDataFrame(rows + copies, SCHEMA)
    for pairs, counts in ((resolve.similar_pairs, resolve.similar_counts), (resolve.ambiguous_pairs, resolve.ambiguous_counts)):
        want = dict.fromkeys((r.id for r in resolve._keys(df, "id").select("id").collect()), 0)
        for r in pairs(df).collect():
            want[r.a] += 1
            want[r.b] += 1
        found = counts(df).collect()
        assert {r.id: r.n_links for r in found} == want and len(found) == len(want) and 0 in want.values() and max(want.values()) > 3
        assert all(r.class_id <= r.id for r in found) and any(r.class_id < r.id for r in found)


def test_likeness_decides_as_difflib_does():
    """Texts that differ in few places and in many, with a common beginning and without, and where it also lies elsewhere."""
    rng = random.Random(9)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    for begin, letters, most in (("customer0", "0123456789", 9), ("", "abc", 20), ("aaaaab", "ab", 12), ("abcd", "abcdé字", 40), ("", "abcdefghij字", 90)):
        texts = [begin + word(letters, rng.randint(1, most)) for _ in range(14)]
        want = np.array([[sum(m.size for m in difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) for y in texts] for x in texts], np.int16)
        c, every = likeness.Compared(texts), slice(0, len(texts))
        assert c.links(every, every, want.copy(), want + 1).all()
        assert not c.links(every, every, want + 1, want + 2).any() and not c.links(every, every, want - 1, want.copy()).any()


def test_queries_of_pairs_have_a_row_for_each_customer(spark, tmp_path):
    """Names that all differ and are alike: their links grow with the square of the customers, the rows don't."""
    from eventloom.plans import queries as plain

    rows = [(i, f"Customer#{i:09d}", 1, "S") for i in range(120)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    for q in ("similar_pairs", "ambiguous_pairs"):
        found = plain.queries()[q](spark, str(tmp_path))
        assert found.count() == 120 and found.agg(F.sum("n_links")).first()[0] > 1000
