"""The automaton of entries and the substring index against plain searches."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import ontology, text_index


def plain_scores(events, entries):
    out = []
    for i, body, organizer in events:
        for e, aliases, organizers, patterns in entries:
            has = lambda t: t is not None and body is not None and t in body  # noqa: B023, E731
            alias, own = any(map(has, aliases or [])), organizer is not None and organizer in (organizers or [])
            met = bool(patterns) and all(map(has, patterns))
            if alias or (own and met):
                out.append((i, e, 5 * alias + 3 * own + 2 * met))
    return sorted(out)


def made(seed, n=80):
    rng = random.Random(seed)
    part = ["ab", "b", "abc", "夜会", "ca", "", "dd", "abcab", "x y", "会"]
    names = lambda most: rng.choice([None, []]) if rng.random() < 0.1 else [rng.choice([*part, None]) if rng.random() < 0.9 else "zz" for _ in range(rng.randint(0, most))]
    events = [(i, None if rng.random() < 0.05 else "".join(rng.choice(part) for _ in range(rng.randint(0, 5))), rng.choice(["o1", "o2", None, ""])) for i in range(n)]
    entries = [(f"e{k}", [a for a in names(2) or [] if a != "" or rng.random() < 0.1], rng.choice([None, ["o1"], ["o2", "o1", None], []]), names(2)) for k in range(25)]
    return events, entries


EVENTS, ENTRIES = "event_id int, body string, organizer string", "entry_id string, aliases array<string>, organizers array<string>, patterns array<string>"


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_scores_are_the_theta_joins(spark, monkeypatch, most):
    """By one automaton, and by joins where it would be too large."""
    monkeypatch.setattr(ontology, "AUTOMATON_BYTES", most)
    for seed in (1, 2):
        events, entries = made(seed)
        got = ontology.match_scores(spark.createDataFrame(events, EVENTS), spark.createDataFrame(entries, ENTRIES))
        assert sorted(tuple(r) for r in got.collect()) == plain_scores(events, entries)


def test_no_entries_and_no_events(spark, monkeypatch):
    events, entries = made(3, 4)
    for most in (1 << 20, -1):
        monkeypatch.setattr(ontology, "AUTOMATON_BYTES", most)
        assert ontology.match_scores(spark.createDataFrame(events, EVENTS), spark.createDataFrame([], ENTRIES)).collect() == []
        assert ontology.match_scores(spark.createDataFrame([], EVENTS), spark.createDataFrame(entries, ENTRIES)).collect() == []


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_many_entries(spark, monkeypatch, most):
    """200,000 entries, each found by its own name, by either way; all have one organizer."""
    monkeypatch.setattr(ontology, "AUTOMATON_BYTES", most)
    entries = spark.range(200_000).select(F.col("id").alias("entry_id"), F.array(F.concat(F.lit("club-"), F.col("id"), F.lit(";")), F.concat(F.lit("alias "), F.col("id"), F.lit(";"))).alias("aliases"), F.array(F.lit("o")).alias("organizers"), F.array(F.concat(F.lit("night "), F.col("id"), F.lit(";"))).alias("patterns"))
    events = spark.range(0, 200_000, 101).select(F.col("id").alias("event_id"), F.concat(F.lit("the club-"), F.col("id"), F.lit("; and night "), F.col("id") + 1, F.lit(";")).alias("body"), F.lit("o").alias("organizer"))
    got = ontology.match_scores(events, entries)
    assert got.agg(F.count("*"), F.count_if(F.expr("event_id = entry_id and score = 8")), F.count_if(F.expr("event_id + 1 = entry_id and score = 5"))).first()[:] == (3962, 1981, 1981)


TEXTS = [(1, "Open Mic Night"), (2, "open"), (3, ""), (4, None), (5, "夜会 — OPEN"), (6, "mi"), (7, "c"), (8, "aaaa"), (8, "other"), (9, "a\x03b"), (None, "open")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = "file://" + str(tmp_path_factory.mktemp("index"))
    df = spark.createDataFrame([*TEXTS, *((100 + i, f"number {i}") for i in range(300))], "doc long, text string")
    text_index.write_index(df, "doc", "text", path, folders=8)
    return text_index.TextIndex(spark, path, folders=8)


@pytest.mark.parametrize("term", ["open", "OPEN", "mic night", "ic n", "en", "c", "夜", "夜会", "aaa", "aaaaa", "", "number 29", "29", "zzz", " ", "a\x03b"])
def test_search_is_contains(index, term):
    rows = [*TEXTS, *((100 + i, f"number {i}") for i in range(300))]
    want = {i for i, t in rows if t is not None and i is not None and term.lower() in t.lower()}
    got = [r.id for r in index.search(term).collect() if r.id is not None]
    assert sorted(got) == sorted(want)


def test_search_reads_few_folders(index):
    plan = index.candidates("number 29")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "PartitionFilters: [folder" in plan
    assert "PushedFilters: [In(gram" in plan
    assert {r.id for r in index.search_any(["mic", "夜会", "MIC"]).collect()} == {1, 5}
    assert index.search_any([]).collect() == []


def test_terms_looked_up_together(spark, tmp_path):
    """Short terms, end marks, repeated ids and terms; the texts are joined once for all terms, and grams are made in one pass."""
    rows = [(1, "Abc abc 字"), (2, "xab"), (2, "abc def"), (3, "ab\x03"), (4, ""), (5, None), (6, "aaaa"), (7, "AAA bbb"), (8, "é\U0001f600z")]
    df = spark.createDataFrame(rows, "doc long, text string")
    text_index.write_index(df, "doc", "text", str(tmp_path / "ix"), folders=8)
    index = text_index.TextIndex(spark, str(tmp_path / "ix"), folders=8)
    terms = ["abc", "ab", "b", "\x03", "c\x03\x03", "abc def", "xab def", "aaaa", "", "字", "\U0001f600", "é\U0001f600z", "ABC", "abc"]
    want = {(t, i) for t in terms for i, x in rows if x is not None and t.lower() in x.lower()}
    got = index.search_each(terms)
    assert sorted((r.term, r.id) for r in got.collect()) == sorted(want)
    assert {r.id for r in index.search_any(["ABC", "字", "aaaa"]).collect()} == {1, 2, 6}
    many = index.search_each([f"term number {i}" for i in range(6)])._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "text#" in line for line in many.splitlines()) <= 2  # the texts, and the empty table of the result's columns
