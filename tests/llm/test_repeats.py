"""op12 against a plain count of all windows; the suffix array against sorting."""

import hashlib
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm import repeats as R
from eventloom.llm.suffix_grouping import suffix_array


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array(symbols):
    s = [*symbols, 0]
    assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_array_of_periods_and_long_texts():
    rng = random.Random(2)
    for s in ([1] * 500, [1, 2] * 300, [2, 1] * 300, [1, 1, 2] * 200 + [1, 1], [rng.randint(1, 200) for _ in range(5000)], [3, 2, 1] * 100 + [3, 2, 2] * 100):
        s = [*s, 0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain(rows, width=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + width] for _, b in data for k in range(len(b) - width + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if count[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß字") for _ in range(rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (70, 90, 120, 200)] + ["ab" * 230, "x" * 700]
    rows = [(i, " ".join(rng.choice([text(rng.randint(1, 60)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 60) :]]) for _ in range(rng.randint(1, 5)))) for i in range(90)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (101, rows[0][1] + "!"), (None, None), (102, ""), (None, passages[1]), (103, "z" * 399), (104, "z" * 399), (105, "q" * 401), (106, "w" * 400), (106, "w" * 400)]
    return rows


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as n_bytes", "'x' as key", "1 as s")
    return sorted((tuple(r) for r in R.removed(df).collect()), key=repr)


def test_removed_is_the_plain_count(spark):
    rows = made(1)
    got = found(spark, rows)
    assert got == plain(rows)
    assert any(r[3] > 1 for r in got) and any(0 < r[2] < r[1] for r in got)


def test_blocks_of_an_anchors_regions(spark, monkeypatch):
    """Anchors with more regions than a block holds: digests between blocks, several parts."""
    monkeypatch.setattr(R, "BLOCK", 3)
    monkeypatch.setattr(R, "PART_BYTES", 5000)
    rows = made(2)
    assert found(spark, rows) == plain(rows)


def test_joins_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("eventloom.llm.common.LIGHT_BYTES", 0)
    rows = made(4)[60:]
    assert found(spark, rows) == plain(rows)


def test_long_text_is_cut_in_chunks(spark, monkeypatch):
    """Anchors of a text over CHUNK are those of its pieces; each window has one."""
    rng = random.Random(3)
    text = "".join(rng.choice("abcdef ") for _ in range(9000)).encode()
    (h, s, e, p), = R.text_anchors([text])
    monkeypatch.setattr(R, "CHUNK", 2000)
    (h2, s2, e2, p2), = R.text_anchors([text])
    window = lambda h, s, e, p: {w: (x, q) for x, a, b, q in zip(h.tolist(), s.tolist(), e.tolist(), p.tolist()) for w in range(a, b + 1)}
    assert window(h, s, e, p) == window(h2, s2, e2, p2)
    assert len(window(h, s, e, p)) == 9000 - 399


def test_nothing(spark):
    assert found(spark, []) == []


def test_awkward(spark, awkward, texts):
    got = sorted((tuple(r) for r in R.removed(awkward).collect()), key=repr)
    assert [r[:2] for r in got] == sorted(((i, len((t or "").encode())) for i, t in texts), key=repr)
    whole = {r[0]: r for r in got}
    assert whole[203][2] == 150_000 and whole[204][2] == 50_000 and whole[200][2] == 0
