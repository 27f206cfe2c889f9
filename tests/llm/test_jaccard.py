"""op10 against all pairs, and the guarantees of its signatures; the pipeline's stages."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import common, jaccard_join as J

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RAW = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    sets = {}
    for i, t in rows:
        w = RAW.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = {}
    for i in sorted(sets):
        for x in sets[i]:
            inverted.setdefault(x, []).append(i)
    for i in sorted(sets):
        for j, n in Counter(j for x in sets[i] for j in inverted[x] if j > i).items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed=4, n=500):
    rng = random.Random(seed)
    seeds = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.choice([3, 5, 9, 10, 14, 30, 80]))] for _ in range(30)]
    rows = []
    for i in range(n):
        w = list(rng.choice(seeds))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            p = rng.randrange(len(w) + 1)
            w[p : p + rng.choice([0, 1])] = [rng.choice("xyzw")]
        rows.append((i, " ".join(w)))
    return rows


def test_linked_sets_share_a_signature():
    rng, pairs = np.random.default_rng(1), 0
    for _ in range(2500):
        s = int(rng.choice([5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 50, 100, 300]))
        pool = rng.integers(0, 2**63, size=s * 2, dtype=np.int64).view(np.uint64)
        a = np.unique(pool[:s])
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[: int(rng.integers(int(s * 0.75), s + 1))]], pool[s : s + int(rng.integers(0, max(1, s // 5) + 1))]]))
        if len(b) and J.linked(a, b) and not np.array_equal(a, b):
            pairs += 1
            assert len(np.intersect1d(J.signatures(a), J.signatures(b)))
    assert pairs > 500


def test_bands_and_differences():
    for s in range(1, 400):
        for t in range(1, s + 1):
            if t >= 0.8 * s:
                assert J.band_of(s) - J.band_of(t) in (0, 1)
        k = J.max_difference(2 * s)
        assert (2 * s - k) / 2 >= 0.8 * (2 * s + k) / 2 - 1e-9


def test_sketches_bound_differences():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 2**40, size=int(rng.integers(1, 300)), dtype=np.int64).view(np.uint64)) for _ in range(2))
        apart = int(np.bitwise_count(np.frombuffer(J.sketch(a), np.uint8) ^ np.frombuffer(J.sketch(b), np.uint8)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_components_of_near_copies(spark):
    rows = near_copies() + [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "One TWO")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_chain_needs_the_second_round(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 60 - 2 * i] + [f"q{i}x{k}" for k in range(2 * i)])) for i in range(6)]
    rows += [(10 + i, " ".join(base[4 * i :] + base[: 4 * i])) for i in range(6)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def components_by(J, spark, rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_keys_that_collide_change_nothing(spark, monkeypatch):
    rows, whole = near_copies(8, 160), J.set_key
    monkeypatch.setattr(J, "set_key", lambda s: (whole(s)[0] % 7, whole(s)[1]))
    assert components_by(J, spark, rows) == brute(rows)


def test_hot_buckets_in_chunks_and_blocks(spark, monkeypatch):
    rows, candidates = near_copies(9, 300), J.candidates
    monkeypatch.setattr(J, "candidates", lambda sent, parts: candidates(sent, parts, chunk_bytes=200))
    monkeypatch.setattr(J, "UNIT", 6)
    monkeypatch.setattr(J, "OUTSIDE", 2)
    assert components_by(J, spark, rows) == brute(rows)


def test_chunks_keep_every_link_of_a_bucket():
    sig = np.array([5, 5, 5, 9, 5, 9, 9, 5], np.int64)
    key = np.array([3, 1, 2, 40, 7, 41, 42, 0], np.int64)
    own, pairs, members = J.Buckets(), set(), {}
    for k in range(0, 8, 2):
        got, lists = own.add([np.stack([sig[k : k + 2], key[k : k + 2]], 1).tobytes()], k == 6)
        pairs |= {tuple(p) for p in got.tolist()}
        for mark, m in lists:
            members.setdefault(mark, set()).update(m.tolist())
    assert members == {5: {0, 1, 2, 3, 7}, 9: {40, 41, 42}}
    parent = {}
    for a, b in pairs:
        parent[b] = min(a, parent.get(b, a))
    assert set(parent) == {1, 2, 3, 7, 41, 42}


def test_signatures_travel_without_a_table(spark, monkeypatch):
    """They are most of what a run has on disk: they are shuffled once, in 13 bytes each with their keys, and not written before."""
    tables, put = [], common.Durable.put
    monkeypatch.setattr(common.Durable, "put", lambda self, df, *a, **b: tables.append(df.columns) or put(self, df, *a, **b))
    rows = near_copies(5, 200)
    assert components_by(J, spark, rows) == brute(rows)
    assert tables and not any("payload" in c for c in tables)
    rng = np.random.default_rng(7)
    sig, key = rng.integers(0, 2**64, 5000, np.uint64), rng.integers(-(2**63), 2**63, 5000)
    sig[2500:] = sig[:2500]
    got, payload = J.dealt(sig, key, 37)
    assert sum(map(len, payload)) == 13 * 5000
    back = np.concatenate([np.frombuffer(J.unpacked(x, p, 37), np.int64).reshape(-1, 2) for p, x in zip(got, payload, strict=True)])
    by_key = dict(zip(back[:, 1].tolist(), back[:, 0].tolist(), strict=True))
    named = [by_key[k] for k in key.tolist()]
    assert named[:2500] == named[2500:] and len(set(named)) == 2500


def test_later_rounds_ask_only_where_a_partner_was(spark):
    """Bucket 1 has classes far apart: it is left out after the first round. In bucket 2 none of the pairs is lost."""
    sets = {v: np.unique(np.random.default_rng(v).integers(0, 2**63, 50, dtype=np.int64).view(np.uint64)) for v in range(1, 8)}
    near = {10 + k: np.concatenate([sets[1][k:], sets[2][:k]]) for k in range(4)}
    every = {k: np.unique(x) for k, x in (sets | near).items()}
    reps = spark.createDataFrame([(v, len(x), J.band_of(len(x)), J.sketch(x)) for v, x in every.items()], "v long, n_shingles long, band int, sketch binary")
    members = spark.createDataFrame([(1, v, None) for v in range(2, 8)] + [(2, v, None) for v in (3, 4, *near)], "bucket long, v long, live boolean")
    label = spark.createDataFrame([(10, 10), (11, 10)], "v long, label long")
    store = common.Durable(spark, "test")
    found = J.remaining(members, 12, label, reps, store, True)
    left = J.still_open(members, found)
    rows = {(r.bucket, r.v): r.live for r in left.collect()}
    assert {b for b, _ in rows} == {2} and {v for _, v in rows} == {3, 4, *near}
    assert not rows[2, 3] and not rows[2, 4] and rows[2, 12] and rows[2, 13]
    pairs = {tuple(sorted((r.a, r.b))) for r in J.remaining(left, 6, label, reps, store, False).collect()}
    assert pairs == {(10, 12), (10, 13), (11, 12), (11, 13), (12, 13)}


def test_null_and_repeated_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(None, a), (None, a), (None, None), (5, a), (5, b), (3, b), (7, a), (7, a), (8, "x y z"), (8, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in J.link_components(docs).collect())
    assert got == [(False, 3, 2, 3), (False, 5, 2, 3), (False, 5, 2, 5), (False, 7, 2, 5), (False, 7, 2, 5), (False, 8, 1, 8), (False, 8, 1, 8), (True, 0, 0, None), (True, 0, 2, None), (True, 0, 2, None)]
    kept = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in J.one_of_each(docs).collect()))
    assert kept == [(False, 3, b), (False, 5, a), (False, 8, "x y z"), (True, 0, ""), (True, 0, a), (True, 0, a)]


def test_awkward(awkward, texts):
    got = J.link_components(awkward)
    rows = got.collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)
    assert J.link_components(awkward.limit(0)).count() == 0
    kept = J.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(texts).values()})


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7)] + [(20, i) for i in range(21, 60)], "a long, b long")
    got = {r.v: r.label for r in J.components(edges, common.Durable(spark, "test")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7} | {i: 20 for i in range(20, 60)}


def test_pipeline(spark, awkward, tmp_path):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("toxic"))
    bench = spark.createDataFrame([(1, "the and idiot")], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    at = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"out{i}"))
        at = spark.read.parquet(str(tmp_path / f"out{i}"))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, at.collect()))
    assert {200, 201, 202} <= {r.doc_id for r in whole.collect()}  # texts without words pass every filter
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_whole_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link_components(documents).collect()}
    assert got == brute(rows)
