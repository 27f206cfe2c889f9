"""op13 against a plain count of all phrases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventloom.llm import collocations as C


def plain(rows, least, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang, piece = "und" if lang is None else lang, []
        for w in [*C.tokens(text), C.BREAK]:
            if w != C.BREAK:
                piece.append(w)
                continue
            n[lang] += len(piece)
            for i in range(len(piece)):
                f[lang].update(tuple(piece[i : i + m]) for m in range(1, 6) if i + m <= len(piece))
            piece = []
    out = []
    for lang, c in f.items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        inside = {g[i : i + m] for g, a in found.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if 100 * a >= 100 * c[g[i : i + m]]}
        rank = []
        for g, a in found.items():
            if g not in inside:
                score, k = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                rank.append((-score, -a, b" ".join(g), c[g[:k]], c[g[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(rank)[:top], 1)]
    return sorted(out)


def made(seed, docs=250):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "É", "naïve", "字", "x y", "|", "a-b"] + [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(len(words))]
    sep = [" ", " ", " ", "  ", "\t", ".", ", ", "\n", "\r\n", "? "]
    one = lambda: "".join(x for _ in range(rng.randint(0, 60)) for x in (rng.choices(words, weights)[0] if rng.random() > 0.1 else "new york city", rng.choice(sep)))
    rows = [(rng.choice(["en", "en", "de", None, "und"]), one()) for _ in range(docs)]
    return rows + [rows[0]] * 40 + [("en", None), (None, ""), ("fr", ".,;"), ("en", "the " * 3000)]


def found(spark, rows):
    df = spark.createDataFrame([(*r, 0) for r in rows], "lang string, text string, id long").selectExpr("*", "1 as a", "2 as n", "'x' as word")
    return sorted(tuple(r) for r in C.collocations(df.repartition(3)).collect())


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(C, "LEAST", 6)


def test_collocations_are_the_plain_count(spark, few):
    rows = made(1)
    got = found(spark, rows)
    assert got == plain(rows, 6)
    assert len({len(r[2].split(" ")) for r in got}) == 4


def test_words_outside_the_head_and_split_pivots(spark, few, monkeypatch):
    monkeypatch.setattr(C, "HEAD_BYTES", 2000)
    monkeypatch.setattr(C, "PART_PLACES", 100)
    monkeypatch.setattr(C, "PART_WORDS", 500)
    monkeypatch.setattr(C, "HELD", 10)
    rows = made(2)
    assert found(spark, rows) == plain(rows, 6)


def test_top_and_nothing(spark, few):
    assert found(spark, []) == []
    assert found(spark, [("en", None), ("en", "one two")]) == []
    df = spark.createDataFrame(made(3), "lang string, text string")
    assert sorted(tuple(r) for r in C.collocations(df, top=3).collect()) == plain(made(3), 6, 3)


def test_spans_of_a_long_text():
    """A text rewritten in spans gives each fragment once."""
    rng = np.random.default_rng(4)
    ids = np.where(rng.random(500) < 0.1, C._RARE, rng.integers(0, 9, 500)).astype(np.int32)
    one = [(p, x) for p, x in C.fragments(ids, np.arange(500), np.ones(500, np.int32), np.array([], np.uint64), 1)]
    count = Counter()
    for g, a in C.phrases([x for _, x in one], 0, 1):
        count.update(dict(zip(map(tuple, g.tolist()), a.tolist())))
    expected = Counter(tuple(ids[i : i + m].tolist()) for m in range(2, 6) for i in range(500 - m + 1) if (ids[i : i + m] < C._RARE).all())
    assert count == expected


def test_scores_beyond_64_bits(spark, tmp_path):
    from eventloom.llm import common

    store = common.Durable(spark, "test")
    big = 7_000_000_000_001
    found = store.put(spark.createDataFrame([([0, 1], big - 5)], "g array<int>, a long"))
    words = store.put(spark.createDataFrame([("en", "a", big, 0), ("en", "b", big - 3, 1)], "lang string, word string, n long, id long"))
    langs = store.put(spark.createDataFrame([("en", 90_000_000_000_007)], "lang string, n long"))
    r, = C.scored(store, found, words, langs).collect()
    assert r.score == 1000 * (big - 5) * 90_000_000_000_007 // (big * (big - 3))


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(C, "_mix", lambda x: x * np.uint64(0))
    keys = np.array([[1, 2], [3, 4], [1, 2], [0, 9]], np.int32)
    rows, count = C._counted(keys, np.array([1, 2, 3, 4], np.int32))
    assert dict(zip(map(tuple, rows.tolist()), count.tolist())) == {(1, 2): 4, (3, 4): 2, (0, 9): 4}
