"""Language identification with unigram pieces, summed over all segmentations.

Each language has a probability for each piece of the fixed public vocabulary. The likelihood of a word is the sum over
all its segmentations, by a forward algorithm; a text's is the product over its words. The probabilities are fitted by
expectation-maximisation (forward-backward) on the word counts of a bounded sample of labelled texts: the first
`sample_rows` distinct texts of each language in the order of a hash, and all of a language that has fewer. So each
language is learned whatever its share of the rows, and copies count once. E-steps run in tasks and are summed by Spark; the driver gets one number a piece and language.

Words are runs of letters, lower-cased; in scripts without blanks that can be a whole text, whose sums are scaled as they
go, so a word's length doesn't matter. Null texts and texts without a letter are `und` with score 0. Long texts cost a
memo lookup a word. Equal likelihoods go to the first language by name; repeated rows each get theirs.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections import defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .vocabulary import MARK, PieceVocabulary, default_path

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Places after which the forward sums of a word are scaled anew, so they can't underflow; letters of a word that is remembered.
SCALED, LONG = 8, 64
#: Probability of a character that is no piece, and what smooths each count.
FLOOR, SMOOTH = 1e-9, 0.05


def words(text: str | None) -> list[bytes]:
    if not text:
        return []
    got = text.lower().encode().translate(_LETTERS).split()
    return got if text.isascii() else [w for w in got if w.isascii() or any(unicodedata.category(c)[0] == "L" for c in w.decode())]


def held_out_of(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part


class Lattice:
    """The pieces at each place of a word, with the word mark before it."""

    def __init__(self, path: str):
        self.vocab = PieceVocabulary(path)

        self.longest = max(self.vocab.length[i] for i in self.vocab.id_of.values())

    def arcs(self, word: bytes) -> tuple[str, list[tuple[int, int, int]]]:
        """The marked word and its arcs (start, end, piece or -1) ordered by end."""
        text, v = MARK + word.decode(), self.vocab
        arcs = [(last + 1 - v.length[p], last + 1, p) for last, p in v.automaton.iter(text)]
        covered = {e for s, e, _ in arcs if e - s == 1}
        arcs += [(i, i + 1, -1) for i in range(len(text)) if i + 1 not in covered]
        arcs.sort(key=lambda a: a[1])
        return text, arcs


def _log_sums(n: int, steps: list[tuple[int, int, float]]) -> list[float]:
    """The logarithm of the sum over all paths from 0 to each place, from steps (from, to, log probability) ordered by `to`."""
    out = [0.0] + [-math.inf] * n
    for to, own in groupby(steps, key=lambda x: x[1]):
        terms = [out[a] + x for a, _, x in own]
        top = max(terms)
        out[to] = top + math.log(math.fsum(math.exp(t - top) for t in terms))
    return out


def expected_counts(lattice: Lattice, word: bytes, prob: dict[int, float] | None, floor: float) -> dict[int, float]:
    """Expected number of each piece over all segmentations of a word; prob None: all pieces alike."""
    counts: dict[int, float] = defaultdict(float)
    text, arcs = lattice.arcs(word)
    n = len(text)
    p = [math.log(FLOOR if k < 0 else 1e-4 if prob is None else prob.get(k, floor)) for _, _, k in arcs]
    forward = _log_sums(n, [(s, e, x) for (s, e, _), x in zip(arcs, p, strict=True)])
    backward = _log_sums(n, sorted(((n - e, n - s, x) for (s, e, _), x in zip(arcs, p, strict=True)), key=lambda x: x[1]))
    for (s, e, k), x in zip(arcs, p, strict=True):
        if k >= 0:
            counts[k] += math.exp(forward[s] + x + backward[n - e] - forward[n])
    return counts


def sample(labelled: DataFrame, most: int, store: common.Durable) -> DataFrame:
    """text, lang: of each language the `most` distinct texts with the smallest hashes, or all if it has fewer.

    A share of each language's hashes, about twice as many as needed, is ranked; no language's rows meet in one task.
    """
    rows = labelled.select("text", "lang", F.xxhash64("text").alias("_h"))
    hashes = store.put(rows.select("lang", "_h").distinct())
    share = F.when(F.col("n") > 2 * most + 100, ((2 * most + 100) / F.col("n") * (1 << 30)).cast("long")).otherwise(1 << 30)
    size = store.put(hashes.groupBy("lang").agg(F.count("*").alias("n")))  # written, so Spark sees that it is small and broadcasts it
    near = hashes.join(size, "lang").where(F.pmod("_h", F.lit(1 << 30)) < share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("_h", F.lit(1 << 30)), "_h"))
    last = store.put(near.select("lang", "_h", place.alias("k")).where(F.col("k") <= most).select("lang", "_h"))
    # sample_rows hashes a language: broadcast while they are few, as Spark finds from the written table's size
    return store.put(rows.join(last, ["lang", "_h"]).groupBy("lang", "_h").agg(F.first("text").alias("text")).select("text", "lang"))


def train(labelled: DataFrame, path: str, sample_rows: int, rounds: int) -> dict:
    """Piece probabilities by language from (text, lang) rows: of each language the first sample_rows distinct texts by a hash."""
    store = common.Durable(labelled.sparkSession, "lid")
    labelled = sample(labelled, sample_rows, store)

    def count_words():
        def step(b: pa.RecordBatch):
            seen: dict[tuple[str, bytes], int] = defaultdict(int)
            for text, lang in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for w in words(text):
                    seen[lang, w] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen], pa.string()), pa.array([w for _, w in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

        return step

    pairs = common.map_rows(labelled.select("text", "lang"), "lang string, word binary, n long", count_words)
    counts = store.put(pairs.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    prob: dict[str, dict[int, float]] = {}
    for _ in range(rounds):

        def estep(known=prob):
            lattice = common.resident(("lattice", path), lambda: Lattice(path))

            def step(b: pa.RecordBatch):
                total: dict[tuple[str, int], float] = defaultdict(float)
                for lang, word, k in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    own = known.get(lang)
                    for piece, x in expected_counts(lattice, word, own, own[-1] if own else 0.0).items():
                        total[lang, piece] += k * x
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in total], pa.string()), pa.array([p for _, p in total], pa.int32()), pa.array(list(total.values()), pa.float64())], ["lang", "piece", "x"])

            return step

        got = common.map_rows(counts, "lang string, piece int, x double", estep).groupBy("lang", "piece").agg(F.sum("x").alias("x")).collect()
        found: dict[str, dict[int, float]] = defaultdict(dict)
        for r in got:  # at most one row a piece of the fixed vocabulary and language
            found[r.lang][r.piece] = r.x
        prob = {}
        for lang, own in found.items():
            total = sum(own.values()) + SMOOTH * 32_000
            prob[lang] = {k: (x + SMOOTH) / total for k, x in own.items()} | {-1: SMOOTH / total}
    store.keep()
    return prob


class Scorer:
    def __init__(self, path: str, prob: dict):
        self.lattice, self.langs = Lattice(path), sorted(prob)
        self.table = np.full((self.lattice.vocab.size + 1, len(self.langs)), 0.0)
        for j, lang in enumerate(self.langs):
            self.table[:-1, j] = prob[lang][-1]
            for k, x in prob[lang].items():
                if k >= 0:
                    self.table[k, j] = x
        self.table[-1] = FLOOR
        self.cap, self.used, self.row = 300_000, 0, {}
        self.value = np.empty((self.cap, len(self.langs)), np.float32)

    def forward(self, part_words: list[bytes]) -> np.ndarray:
        """Log-likelihoods of words in each language: one forward pass over all of them, by place in the word."""
        v, texts = self.lattice.vocab, [MARK + w.decode() for w in part_words]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        found = np.array(list(v.automaton.iter("\n".join(texts))), np.int64).reshape(-1, 2)
        length = np.asarray(v.length)
        end = found[:, 0] + 1
        start, piece = end - length[found[:, 1]], found[:, 1]
        lone = np.ones(begin[-1] + 1, bool)  # characters without a piece of their own
        lone[begin[:-1] + size] = False
        lone[begin[-1] :] = False
        lone[start[end - start == 1]] = False
        at = np.flatnonzero(lone)
        start, end, piece = np.concatenate([start, at]), np.concatenate([end, at + 1]), np.concatenate([piece, np.full(len(at), v.size)])
        text_of = np.searchsorted(begin, start, side="right") - 1
        order = np.lexsort((end, end - begin[text_of]))
        start, end, piece, place = start[order], end[order], piece[order], (end - begin[text_of])[order]
        alpha = np.zeros((begin[-1] + 1, len(self.langs)))
        alpha[begin[:-1]] = 1.0
        longest = int(size.max(initial=0))
        scale = np.zeros((len(texts), len(self.langs)))
        bounds = np.searchsorted(place, np.arange(1, longest + 2))
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 1):
            if b > a:
                first = np.flatnonzero(np.concatenate([[True], end[a + 1 : b] != end[a : b - 1]]))
                alpha[end[a:b][first]] = np.add.reduceat(alpha[start[a:b]] * self.table[piece[a:b]], first, axis=0)
            if k % SCALED == 0 and len(on := np.flatnonzero(size > k)):  # the sums that longer words still need, over the last of them
                front = alpha[begin[on] + k]
                scale[on] += np.log(front)
                at = begin[on][:, None] + np.arange(max(0, k - self.lattice.longest), k + 1)[None, :]
                alpha[at] /= front[:, None, :]
        return np.log(alpha[begin[:-1] + size]) + scale

    def rows(self, each: list[list[bytes]]) -> list[np.ndarray]:
        new = set().union(*each).difference(self.row) if each else set()
        if self.used + len(new) > self.cap:
            self.row.clear()
            self.used, new = 0, set().union(*each)
        if new:
            new = sorted(new, key=len)  # words of like length together
            if self.used + len(new) > len(self.value):
                self.value = np.resize(self.value, (self.used + len(new), len(self.langs)))
            a = 0
            while a < len(new):
                b = a + max(1, min(4096, 65_536 // len(new[a])))
                self.value[self.used + a : self.used + min(b, len(new))] = self.forward(new[a:b])
                a = b
            self.row.update(zip(new, range(self.used, self.used + len(new)), strict=True))
            self.used += len(new)
        get = self.row.__getitem__
        out = [self.value[np.fromiter(map(get, ws), np.int64, len(ws))].sum(0, dtype=np.float64) for ws in each]
        for w in reversed(new) if new else ():  # long words aren't kept
            if len(w) <= LONG:
                break
            del self.row[w]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        each = [words(t) for t in texts]
        langs, scores = [], []
        for ws, like in zip(each, self.rows(each), strict=True):
            if not ws or not self.langs:
                langs.append("und")
                scores.append(0.0)
                continue
            best = int(np.argmax(like))
            langs.append(self.langs[best])
            scores.append(1.0 / math.fsum(math.exp(max(x - like[best], -700.0)) for x in like))
        return langs, scores


def identify(docs: DataFrame, prob: dict, path: str | None = None) -> DataFrame:
    """doc_id, lang_pred, score (posterior of the prediction under equal priors)."""
    path = path or default_path()
    key = ("lid", path, uuid.uuid4().hex)
    shared = docs.sparkSession.sparkContext.broadcast(prob)  # bounded by vocabulary and languages

    def start():
        scorer = common.resident(key, lambda: Scorer(path, shared.value))

        def step(b: pa.RecordBatch):
            langs, scores = scorer.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

        return step

    return common.map_rows(common.id_text(docs), "doc_id long, lang_pred string, score double", start)


def learn_and_identify(docs: DataFrame, path: str | None = None, sample_rows: int = 1500, rounds: int = 2) -> DataFrame:
    """Learns from rows that are not held out (crc32 of the id as text mod 4 is not 2), predicts all rows."""
    path = path or default_path()
    held = held_out_of(F.col("doc_id"), 4, 2)
    known = docs.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    prob = train(known, path, sample_rows, rounds)
    return identify(docs, prob, path).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score")
