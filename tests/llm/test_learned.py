"""Learned operators: op2 and op8, by automaton and forward sums against plain versions and by held-out accuracy."""

import math
import random
import time
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import language_id, toxicity


def distances(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_automaton_is_levenshtein():
    auto, rng = toxicity.LexiconAutomaton(["idiot", "moron", "réeux*", "abcdefghijkl", "bad"]), random.Random(5)
    for _ in range(4000):
        w = rng.choice(["idiot", "moron", "réeux", "abcdefghijkl", "idmoron", "bad"])
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(w))
            w = rng.choice([w[:i] + rng.choice("idotmrnéux") + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice("idotmrn") + w[i + 1 :]])
        expected = {t: d for t in ("idiot", "moron", "abcdefghijkl", "bad") if (d := distances(w, t)) <= toxicity.edits_for(t)}
        if (d := min(distances(w[:i], "réeux") for i in range(len(w) + 1))) <= 1:
            expected["réeux*"] = d
        assert auto.match(w) == expected if hasattr(auto, "match") else auto._match(w.encode()) == expected


def test_context():
    s = toxicity.Scorer({"weight": {("idiot", 0): 4.0}, "fit": [-3.0, 1.0, 0.0, 0.0]})
    plain, quoted, address = (s.score(t)[0] for t in ("that is one idiot here", 'they wrote "one idiot" here', "you are one idiot here"))
    assert quoted < plain < address


def train_table(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 7)))
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, " ".join([word() for _ in range(40)] + (["zounds", "zoundz", "flapdoodle"] if bad else [])), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns(spark):
    rows = train_table(spark)
    got = toxicity.learn_and_score(rows.drop("toxic").withColumn("score", F.lit(0)), rows.select("doc_id", "toxic", F.lit(1).alias("quality"))).join(rows.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 400 and held and all(r.predicted == r.toxic for r in held)
    assert all((r.predicted == 1) == (r.score >= 0.5) for r in got)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_toxicity_awkward(awkward, texts):
    labels = awkward.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    for lab in (labels, labels.limit(0), labels.withColumn("toxic", F.lit(1)), labels.withColumn("toxic", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0))):
        got = toxicity.learn_and_score(awkward, lab).collect()
        assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.learn_and_score(awkward.limit(0), labels).count() == 0
    assert toxicity.without_toxic(awkward, toxicity.learned(awkward, labels)).columns == awkward.columns


def test_held_out_toxicity(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = toxicity.learn_and_score(docs, labels).where("held_out").join(labels, "doc_id").collect()
    clean = [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert sum(r.predicted for r in got if r.toxic == 1) >= 0.5 * sum(r.toxic for r in got)


def plain_log_sum(word, prob):
    """Over all segmentations into pieces that the library knows, by slices of the word and exact fractions; other characters have FLOOR."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=language_id.default_path())
    known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    longest, text = max(map(len, known)), "\u2581" + word
    sums = [Fraction(1)]
    for e in range(1, len(text) + 1):
        total = Fraction(0)
        for s in range(max(0, e - longest), e):
            k = known.get(text[s:e])
            if k is not None or e - s == 1:
                total += sums[s] * Fraction(language_id.FLOOR if k is None else prob.get(k, prob[-1]))
        sums.append(total)
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


def test_forward_sums_all_segmentations():
    prob = {"en": {-1: 1e-6, 300: 0.1, 259: 0.01, 261: 0.2}, "fr": {-1: 1e-6, 270: 0.2}}
    s = language_id.Scorer(language_id.default_path(), prob)
    words = ["the", "tin", "éa字", "abcdefg", "abcdefghij" * 6, "thetion" * 9, "字仮名交じりの文" * 15, "", "x" * 200]
    assert np.allclose(s.forward([w.encode() for w in words]), [[plain_log_sum(w, prob[x]) for x in s.langs] for w in words])


def test_one_very_long_word():
    s = language_id.Scorer(language_id.default_path(), {"en": {-1: 1e-6, 300: 0.1}, "fr": {-1: 2e-6}})
    began = time.time()
    assert np.isfinite(s.rows([[("字a" * 100_000).encode(), b"the"]])).all()
    assert list(s.row) == [b"the"] and time.time() - began < 60


def test_expected_counts_are_consistent():
    lattice = language_id.Lattice(language_id.default_path())
    counts = language_id.expected_counts(lattice, b"thetion", None, 0.0)
    assert math.isclose(sum(x * lattice.vocab.length[k] for k, x in counts.items()), len("thetion") + 1)
    long = "thetion" * 300
    counts = language_id.expected_counts(lattice, long.encode(), {300: 0.1, -1: 1e-7}, 1e-7)
    assert math.isclose(sum(x * lattice.vocab.length[k] for k, x in counts.items()), len(long) + 1, rel_tol=1e-6)


def test_language_held_out(documents):
    got = language_id.learn_and_identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


def test_language_sample_is_by_language(spark):
    """Copies and a language of three texts among many of another: each is learned, from at most so many distinct texts."""
    from eventloom.llm import common

    rows = [(f"text number {i}", "en") for i in range(900)] + [("one text again and again", "en")] * 500 + [(f"le texte {i}", "fr") for i in range(3)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = [(r.lang, r.text) for r in language_id.sample(df, 40, common.Durable(spark, "t")).collect()]
    assert len(got) == len(set(got)) == 43 and sum(x == "fr" for x, _ in got) == 3
    assert sorted(got) == sorted((r.lang, r.text) for r in language_id.sample(df.distinct(), 40, common.Durable(spark, "t")).collect())
    assert set(language_id.train(df, language_id.default_path(), 40, 1)) == {"en", "fr"}


def test_language_awkward(awkward, texts):
    got = {r.doc_id: r for r in language_id.learn_and_identify(awkward).collect()}
    assert got[200].lang_pred == got[201].lang_pred == got[202].lang_pred == "und" and got[200].score == 0.0
    assert {r.lang_pred for r in got.values()} <= {"en", "de", "und"}
    assert language_id.learn_and_identify(awkward).count() == len(texts)
    none = language_id.learn_and_identify(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language_id.learn_and_identify(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("text, letters", [("123 !", False), ("字", True), ("é", True), ("😀", False), ("1a", True)])
def test_letters(text, letters):
    assert bool(language_id.words(text)) is letters


def test_predictions_are_the_plain_sums():
    """lang_pred and score of whole texts from exact fractions over all segmentations of each word."""
    prob = {"en": {-1: 1e-6, 300: 0.1, 259: 0.01, 261: 0.2}, "fr": {-1: 1e-6, 270: 0.2}, "de": {-1: 2e-6}}
    s = language_id.Scorer(language_id.default_path(), prob)
    texts = ["the tin in the", "es les mes des", "字 x", "", None, "1 2 3", "The Tin! 9", "a " * 40]
    langs, scores = s.predict(texts)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        ws = language_id.words(text)
        if not ws:
            assert (lang, score) == ("und", 0.0)
            continue
        total = {x: math.fsum(plain_log_sum(w.decode(), prob[x]) for w in ws) for x in s.langs}
        best = max(total.values())
        assert math.isclose(total[lang], best, rel_tol=1e-5)
        assert math.isclose(score, 1 / math.fsum(math.exp(max(-700, x - total[lang])) for x in total.values()), rel_tol=1e-3)


def plain_features(text, weight):
    """All of op2's features by distances of each word to each term; contexts by the module's own function."""
    ws = toxicity.words(text)
    hits = []
    for i, w in enumerate(ws):
        found = {}
        for term in {t for t, _ in weight}:
            stem = term.rstrip("*")
            near = min(distances(w.decode(), stem), *(distances(w.decode()[:k], stem) for k in range(len(w.decode()) + 1))) if term.endswith("*") else distances(w.decode(), stem)
            if near <= toxicity.edits_for(stem):
                found[term] = near
        if found:
            hits.append((i, found))
    factor = toxicity.contexts(text, ws, [i for i, _ in hits]) if hits else {}
    seen, total, n = {}, 0.0, 0
    for i, found in hits:
        own, term = max((weight.get((t, e), 0.0), t) for t, e in found.items())
        seen[term] = seen.get(term, 0) + 1
        if own:
            total, n = total + factor[i] * own / seen[term], n + 1
    return [1.0, total / (1 + total / toxicity.HALF), math.log1p(n), math.log1p(len(ws))]


def test_toxicity_scores_are_plain():
    weight = {("idiot", 0): 4.0, ("idiot", 1): 2.5, ("moron", 0): 3.0, ("bad", 0): 1.0, ("réeux*", 0): 2.0, ("réeux*", 1): 1.5}
    fit = [-3.0, 0.8, 0.5, -0.2]
    s, rng = toxicity.Scorer({"weight": weight, "fit": fit}), random.Random(3)
    vocabulary = ["you", "said", "idiot", "idiots", "idiut", "moron", "bad", "bed", "réeuxette", "reeux", '"', "the", "club", "quote"]
    for _ in range(200):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))
        plain = plain_features(text, weight)
        score, _ = s.score(text)
        assert np.allclose(s.features(text)[0], plain)
        assert math.isclose(score, 1 / (1 + math.exp(-sum(a * b for a, b in zip(plain, fit)))))


def test_each_match_counts():
    """However many matches there are, one more raises the sum and their number."""
    s = toxicity.Scorer({"weight": {("idiot", 0): 4.0}, "fit": [0.0] * 4})
    rows = [s.features(" ".join(["idiot"] * n))[0] for n in range(1, 400)]
    assert all(b[1] > a[1] and b[2] > a[2] for a, b in zip(rows, rows[1:]))
