"""Toxicity from a learned lexicon: Levenshtein automata intersected with the lexicon's trie, and context windows.

The lexicon (whole words and word stems) and its weights are learned from a bounded sample of labelled rows
(`sample_rows`). A trie holds the terms; the automaton walks a word through the trie with up to 0, 1 or 2 edits by the
term's length, as sets of (node, edits) that are made deterministic as they come up. Each match adds its learned
log-odds, scaled by its context: less between quotation marks or near words of reporting, more near words of address.
The score is the logistic of the sum. Null and empty texts have no match and get the learned score of such texts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Fixed word lists of the context windows.
REPORTING = {b"said", b"says", b"wrote", b"called", b"quoted", b"quote", b"quotes", b"word", b"term", b"slur", b"insult", b"reported", b"accused"}
ADDRESS = {b"you", b"your", b"youre", b"u", b"ur"}
QUOTES = "\"“”«»„"
#: Words on each side that make up the context, and what a context does to a match.
CONTEXT, QUOTED, REPORTED, ADDRESSED = 5, 0.4, 0.7, 1.2
STEM_LENGTHS = range(3, 9)
#: A text's sum of weighted matches x counts as x / (1 + x / HALF): each match raises it, however many there are.
HALF = 25.0
_RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return common.word_bytes((text or "").lower())


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class LexiconAutomaton:
    """Terms are words, or stems ending in '*'. match(word) gives {term: least edits} of the terms within reach."""

    def __init__(self, terms: list[str]):
        self.child: list[dict[str, int]] = []
        self.limit: list[int] = []
        self.word: list[str | None] = []
        self.stem: list[str | None] = []
        self.roots: dict[int, int] = {}
        for term in terms:
            plain = term.rstrip("*")
            k = edits_for(plain)
            node = self.roots.get(k)
            if node is None:
                node = self.roots[k] = self._node(k)
            for c in plain:
                nxt = self.child[node].get(c)
                if nxt is None:
                    nxt = self.child[node][c] = self._node(k)
                node = nxt
            (self.stem if term.endswith("*") else self.word)[node] = term
        self.memo = common.Memo(self._match)
        self._reset()

    def _node(self, k: int) -> int:
        self.child.append({})
        self.limit.append(k)
        self.word.append(None)
        self.stem.append(None)
        return len(self.child) - 1

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.next: list[dict[str, int]] = []
        self.first = self._state({r: 0 for r in self.roots.values()}, {})

    def _state(self, at: dict[int, int], done: dict[str, int]) -> int:
        todo = list(at)  # leave out characters of the term
        while todo:
            node = todo.pop()
            e = at[node] + 1
            if e <= self.limit[node]:
                for nxt in self.child[node].values():
                    if e < at.get(nxt, 99):
                        at[nxt] = e
                        todo.append(nxt)
        done = dict(done)
        for node, e in at.items():
            if self.stem[node] and e < done.get(self.stem[node], 99):
                done[self.stem[node]] = e
        key = (frozenset(at.items()), frozenset(done.items()))
        got = self.states.get(key)
        if got is None:
            got = self.states[key] = len(self.sets)
            self.sets.append((at, done))
            self.next.append({})
        return got

    def _step(self, state: int, c: str) -> int:
        at, done = self.sets[state]
        new: dict[int, int] = {}
        for node, e in at.items():
            nxt = self.child[node].get(c)
            if nxt is not None and e < new.get(nxt, 99):
                new[nxt] = e
            if e < self.limit[node]:
                if e + 1 < new.get(node, 99):
                    new[node] = e + 1
                for other in self.child[node].values():
                    if e + 1 < new.get(other, 99):
                        new[other] = e + 1
        return self._state(new, done)

    def _match(self, word: bytes) -> dict[str, int]:
        if len(self.sets) > 50_000:
            self._reset()
        state = self.first
        for c in word.decode():
            nxt = self.next[state].get(c)
            if nxt is None:
                nxt = self._step(state, c)
                self.next[state][c] = nxt
            state = nxt
            if not self.sets[state][0] and not self.sets[state][1]:
                return {}
        at, done = self.sets[state]
        out = dict(done)
        for node, e in at.items():
            if self.word[node] and e < out.get(self.word[node], 99):
                out[self.word[node]] = e
        return out

    def hits(self, ws: list[bytes]) -> list[tuple[int, dict[str, int]]]:
        return [(i, m) for i, m in enumerate(map(self.memo.__getitem__, ws)) if m]


def contexts(text: str, ws: list[bytes], hits: list[int]) -> dict[int, float]:
    """The factor of each hit word by what stands around it."""
    low = text.lower()
    spans = [m.span() for m in _RAW_WORD.finditer(low)]
    marks = [i for i, c in enumerate(low) if c in QUOTES]
    out, before, k = {}, 0, 0
    for i in hits:
        near = set(ws[max(0, i - CONTEXT) : i] + ws[i + 1 : i + 1 + CONTEXT])
        f = 1.0
        if i < len(spans):
            a, b = spans[max(0, i - CONTEXT)][0], spans[min(len(spans) - 1, i + CONTEXT)][1]
            while k < len(marks) and marks[k] < spans[i][0]:
                before, k = before + 1, k + 1
            if before % 2 and any(a <= m < spans[i][0] for m in marks[max(0, k - 2) : k]) and any(spans[i][1] <= m <= b for m in marks[k : k + 2]):
                f *= QUOTED
        if near & REPORTING:
            f *= REPORTED
        if near & ADDRESS:
            f *= ADDRESSED
        out[i] = f
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int) -> DataFrame:
    """(text, toxic) of about sample_rows labelled rows that may be learned from, chosen by a hash of the id."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).where(learn)
    n = known.count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample_rows / n * (1 << 30)))
    return common.id_text(docs).join(F.broadcast(known), "doc_id").where(F.col("text").isNotNull()).select("text", "toxic")  # bounded by sample_rows


def _features(text: str) -> Counter:
    """How often each word and stem occurs, by repeats(), so that one text can't make a term; "" counts the words."""
    out: Counter = Counter()
    for w, n in Counter(words(text)).items():
        w = w.decode()
        out[w] += n
        out[""] += n
        for k in STEM_LENGTHS:
            if len(w) >= k:
                out[w[:k] + "*"] += n
    return Counter({t: repeats(n) if t else n for t, n in out.items()})


def repeats(n: int) -> int:
    """What n occurrences in one text count: one more each time n doubles."""
    return n.bit_length()


def _count(df: DataFrame, features) -> DataFrame:
    """(term, n): how often the terms that features(text) gives occur in all texts."""

    def start():
        def step(b: pa.RecordBatch):
            seen: Counter = Counter()
            for t in b.column(0).to_pylist():
                seen.update(features(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

        return step

    return common.map_rows(df.select("text"), "term string, n long", start).groupBy("term").agg(F.sum("n").alias("n"))


def _log_rate(a: int, n_a: int, b: int, n_b: int) -> float:
    return math.log((a + 0.5) / (n_a + 1)) - math.log((b + 0.5) / (n_b + 1))


def _evidence(a: int, n_a: int, b: int, n_b: int) -> float:
    """The likelihood ratio statistic of a term that occurs a times in n_a words and b times in n_b."""
    rate = (a + b) / (n_a + n_b)
    return 2 * ((a * math.log(a / (n_a * rate)) if a else 0.0) + (b * math.log(b / (n_b * rate)) if b else 0.0))


def _standing_out(bad: DataFrame, good: DataFrame, min_log_rate: float, min_evidence: float, store: common.Durable) -> tuple[dict, int, int]:
    """{term: evidence} of the terms that stand out in toxic texts, and the words of both kinds of texts; only those reach the driver."""
    a = store.put(_count(bad, _features).withColumnRenamed("n", "a"))
    b = store.put(_count(good, _features).withColumnRenamed("n", "b"))
    n1, n0 = ((r[0] if r else 0) or 1 for r in (a.where("term = ''").select("a").first(), b.where("term = ''").select("b").first()))
    both = a.where("term <> '' and a >= 5").join(b, "term", "left").select("term", "a", F.coalesce("b", F.lit(0)).alias("b"))
    rate = (F.col("a") + F.col("b")) / (n1 + n0)
    g = 2 * (F.col("a") * F.log(F.col("a") / (n1 * rate)) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (n0 * rate))).otherwise(0.0))
    apart = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    return {r.term: r.g for r in both.select("term", g.alias("g")).where((F.col("g") >= min_evidence) & (apart >= min_log_rate)).collect()}, n1, n0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the constant and isn't shrunk."""
    w, shrink = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + shrink, x.T @ (y - p) - shrink @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(sample: DataFrame, min_log_rate: float = 1.5, min_evidence: float = 40.0) -> dict:
    """{'weight': {(term, edits): log of its rate in toxic texts over its rate in others}, 'fit': weights of features()}.

    min_evidence keeps out terms that stand out by chance among the very many that are looked at. What reaches the driver
    is bounded by the sample: its terms of that evidence, and four numbers a row.
    """
    store = common.Durable(sample.sparkSession, "toxicity")
    sample = store.put(sample.repartition(16))
    n = {r.toxic: r.n for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return {"weight": {}, "fit": [math.log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 0.5)), 0.0, 0.0, 0.0]}
    bad, good = sample.where("toxic > 0"), sample.where("toxic <= 0")
    evidence, n1, n0 = _standing_out(bad, good, min_log_rate, min_evidence, store)
    # The strongest first; of equals a whole word, then the longest stem; none that a chosen one covers or extends.
    chosen: list[str] = []
    for t in sorted(evidence, key=lambda t: (-round(evidence[t], 6), t.endswith("*"), -len(t), t)):
        plain = t.rstrip("*")
        if not any((c.endswith("*") and plain.startswith(c[:-1])) or (t.endswith("*") and c.rstrip("*").startswith(plain)) for c in chosen):
            chosen.append(t)
    key = uuid.uuid4().hex

    def matched(text: str) -> Counter:
        auto = common.resident(("lexicon", key), lambda: LexiconAutomaton(chosen))
        found = Counter(f"{term}\t{e}" for _, m in auto.hits(words(text)) for term, e in m.items())
        return Counter({t: repeats(n) for t, n in found.items()})

    a, b = ({r.term: r.n for r in _count(part, matched).collect()} for part in (bad, good))
    weight = {}
    for t in {*a, *b}:
        term, e = t.split("\t")
        w = _log_rate(a.get(t, 0), n1, b.get(t, 0), n0)
        if w > 0.5 and _evidence(a.get(t, 0), n1, b.get(t, 0), n0) >= 10:
            weight[term, int(e)] = min(8.0, w)
    model, fit_key = {"weight": weight, "fit": [0.0] * 4}, uuid.uuid4().hex

    def start():
        scorer = common.resident(("toxicity", fit_key), lambda: Scorer(model))

        def step(batch: pa.RecordBatch):
            x = [scorer.features(t)[0] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1).cast(pa.int32())], ["x", "toxic"])

        return step

    rows = common.map_rows(sample.select("text", "toxic"), "x array<double>, toxic int", start).collect()  # sample_rows rows of four numbers
    store.keep()
    model["fit"] = _logistic(np.array([r.x for r in rows]), np.array([float(r.toxic > 0) for r in rows])).tolist()
    return model


class Scorer:
    def __init__(self, model: dict):
        self.weight, self.fit = model["weight"], model["fit"]
        self.auto = LexiconAutomaton(sorted({t for t, _ in self.weight}))

    def features(self, text: str | None) -> tuple[list[float], int]:
        """Constant, weighted matches, log of their number, log of the number of words; and the number of matches.

        All matches count: the k-th of a term by 1 / k of its weight, so a term's sum grows as the logarithm.
        """
        ws = words(text)
        hits = self.auto.hits(ws)
        total, n = 0.0, 0
        if hits:
            factor = contexts(text, ws, [i for i, _ in hits])
            seen: Counter = Counter()
            for i, m in hits:
                own, term = max((self.weight.get(x, 0.0), x[0]) for x in m.items())
                seen[term] += 1
                if own:
                    total += factor[i] * own / seen[term]
                    n += 1
        return [1.0, total / (1 + total / HALF), math.log1p(n), math.log1p(len(ws))], n

    def score(self, text: str | None) -> tuple[float, int]:
        x, n = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, self.fit, strict=True)))))), n


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted (1 if score >= 0.5) and n_hits for each row; reads the text only."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # terms of a bounded sample

    def start():
        s = common.resident(("toxicity", key), lambda: Scorer(shared.value))

        def step(b: pa.RecordBatch):
            got = [s.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.float64()), pa.array([int(x >= 0.5) for x, _ in got], pa.int32()), pa.array([n for _, n in got], pa.int64())], ["doc_id", "score", "predicted", "n_hits"])

        return step

    return common.map_rows(common.id_text(docs), "doc_id long, score double, predicted int, n_hits long", start)


def without_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The documents that aren't predicted toxic, all columns; a filter, no shuffle."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.arrow_udf("boolean")
    def toxic(texts: pa.Array) -> pa.Array:
        s = common.resident(("toxicity", key), lambda: Scorer(shared.value))
        return pa.array([s.score(t.as_py())[0] >= 0.5 for t in texts], pa.bool_())

    return docs.where(~toxic(F.col("text").cast("string")))


def learned(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000) -> dict:
    """A model from labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    return train(labelled_sample(docs, labels, learn, sample_rows))


def learn_and_score(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score(docs, learned(docs, labels, sample_rows)).withColumn("held_out", held).select("doc_id", "held_out", "score", "predicted", "n_hits")
