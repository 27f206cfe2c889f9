"""Phrase collocations by pivot partitioning, as in MG-FSM.

A phrase of two to five words belongs to its rarest word, its pivot. Words are counted first; those under the least
count break a piece of text, since no frequent phrase has them, and the others get numbers by falling count. For each
place of a word the text around it is rewritten to what the word can own: up to four words to either side, as far as
they aren't rarer. (Where the rarest word stands twice in a phrase the first place owns it: words on the left must be
less rare.) These fragments go to the pivot's part, where phrases are counted by sorting; a part emits phrases whose
pivot it has, frequent ones only. A word with so many places that they would fill a part is dealt to several, whose
counts are added. Equal texts of a task's slice are sent once, with a weight.

Phrases are scored by SQL over the table of frequent phrases: lower parts of a cut are frequent phrases themselves.
Arithmetic is exact (decimals of 38 digits; a count times all words of a language times 1,000 must stay under 10^38).

The numbers of the most frequent words (HEAD_BYTES at most) are broadcast. If there are more frequent words, those are
looked up by a join: each text's words that aren't in the broadcast part, once each, against the table of words.

Null texts are empty, null languages `und`. Rows without or with repeated doc_id count like others; other columns are ignored.
An empty table gives an empty result. Texts of any length are read whole; a very long one is cut into spans of CHUNK
words, which overlap by what a fragment needs.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of words (with 32 for each) whose numbers are broadcast; longer words are looked up by a join.
HEAD_BYTES, HEAD_WORD = 48 << 20, 256
#: Places of a pivot in a part, and words of text for each part.
PART_PLACES, PART_WORDS = 150_000, 1_500_000
#: Words that a task holds in its counts before it sends them.
HELD = 400_000
#: What separates pieces becomes 0xFF, which no text has; tabs become blanks and A-Z a-z.
BREAK = b"\xff"
_BYTES = bytes(0xFF if chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RARE = np.int32(2**31 - 1)
SIDE = LONGEST - 1


def tokens(text: str | None) -> list[bytes]:
    """Words and BREAKs."""
    return [w for w in (text or "").encode().translate(_BYTES).replace(BREAK, b" \xff ").split(b" ") if w]


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n; the null word has the sum of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def send() -> pa.RecordBatch:
            langs, words, n = [], [], []
            for lang, c in counts.items():
                c.pop(BREAK, None)
                langs += [lang] * (len(c) + 1)
                words += [None, *(w.decode() for w in c)]
                n += [sum(c.values()), *c.values()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())], ["lang", "word", "n"])

        for b in batches:
            for lang, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                counts.setdefault(lang, Counter()).update(tokens(text))
                if sum(map(len, counts.values())) > HELD:
                    yield send()
        yield send()

    return rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(store: common.Durable, counts: DataFrame) -> DataFrame:
    """lang, word, n, id of the frequent words: ids from 0 by falling n, then lang and word."""
    at = F.monotonically_increasing_id()
    ordered = store.put(counts.where(F.col("word").isNotNull() & (F.col("n") >= LEAST)).orderBy(F.desc("n"), "lang", "word").withColumn("at", at))
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    begin = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", begin.alias("begin"))  # a row for each partition
    return store.put(ordered.join(F.broadcast(offsets), part == F.col("part")).select("lang", "word", "n", (F.col("begin") + row).alias("id")))


def _head(words: DataFrame) -> tuple[dict[str, dict[bytes, int]], int]:
    """For each language the numbers of its most frequent words, as many as HEAD_BYTES allow; how many frequent words have none."""
    short = words.where(F.octet_length("word") <= HEAD_WORD)
    total, size, most = words.agg(F.count("*"), F.sum(F.octet_length("word") + 32), F.max(F.octet_length("word"))).first()
    if not total:
        return {}, 0
    if size > HEAD_BYTES or most > HEAD_WORD:
        short = short.where(F.col("id") < HEAD_BYTES // (HEAD_WORD + 32))
    out: dict[str, dict[bytes, int]] = {}
    n = 0
    for r in short.select("lang", "word", "id").toLocalIterator():
        out.setdefault(r.lang, {})[r.word.encode()] = r.id
        n += 1
    return out, total - n


def _with_tail(rows: DataFrame, words: DataFrame, head) -> DataFrame:
    """rows with tail: the numbers of a text's frequent words that aren't in the head, by a join on the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = pickle.loads(head.value)
        for b in batches:
            for lang, text, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = known.get(lang, {})
                other = [w.decode() for w in set(tokens(text)) if w != BREAK and w not in own]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(other), pa.string()), pa.array([key] * len(other), pa.binary()), pa.array(other, pa.string())], ["lang", "key", "word"])

    keyed = rows.withColumn("key", F.unhex(F.left(F.sha2(F.col("text").cast("binary"), 256), F.lit(32))))
    wanted = keyed.mapInArrow(run, "lang string, key binary, word string")
    tail = wanted.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("lang", "key").agg(F.collect_set(F.struct("word", "id")).alias("tail"))
    return keyed.join(tail, ["lang", "key"], "left").select("lang", "text", "tail")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def fragments(ids: np.ndarray, shift: np.ndarray, weight: np.ndarray, hot: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, payload) of the fragments of a row of word numbers, _RARE where no phrase passes.

    shift: a number of each place that depends on its text only; weight: of each place; hot: the parts of a word, for
    the words that have more than one, which are the first.
    """
    n = len(ids)
    wide = np.full(n + 2 * SIDE, _RARE, np.int32)
    wide[SIDE : SIDE + n] = ids
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    on = ids < _RARE
    for k in range(1, LONGEST):
        on = on & (wide[SIDE - k : SIDE - k + n] < ids)
        left += on
    on = ids < _RARE
    for k in range(1, LONGEST):
        on = on & (wide[SIDE + k : SIDE + k + n] <= ids)
        right += on
    at = np.flatnonzero((left + right > 0) & (weight > 0))
    if not len(at):
        return
    left, right, pivot = left[at], right[at], ids[at]
    spread = np.zeros(len(at), np.uint64)
    many = pivot < len(hot)
    spread[many] = _mix(shift[at[many]].astype(np.uint64)) % hot[pivot[many]]
    part = (_mix(pivot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + spread) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    at, left, right, part = at[order], left[order], right[order], part[order]
    rows = wide[at[:, None] + np.arange(2 * SIDE + 1)]
    place = np.arange(2 * SIDE + 1)
    used = (place >= SIDE - left[:, None]) & (place <= SIDE + right[:, None])
    flat, begin = rows[used], np.concatenate([[0], np.cumsum(left + right + 1)])
    shape, times = (left * LONGEST + right).astype(np.uint8), weight[at].astype(np.int32)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield int(part[a]), np.int32(b - a).tobytes() + shape[a:b].tobytes() + times[a:b].tobytes() + flat[begin[a] : begin[b]].tobytes()


#: Words of a text that are rewritten at a time.
CHUNK = 1 << 20


def rewrite(rows: DataFrame, head, parts: int) -> DataFrame:
    """part, payload: the fragments of all texts. rows: lang, text and, if there are words outside the head, tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot = pickle.loads(head.value)

        def sent(texts: dict) -> Iterator[pa.RecordBatch]:
            ids, shift, weight = [], [], []
            for (lang, text), (times, tail) in texts.items():
                number = known.get(lang, {})
                if tail:
                    number = number | tail
                found = np.fromiter((number.get(w, _RARE) for w in [BREAK, *tokens(text)]), np.int32)
                ids.append(found)
                shift.append(np.arange(len(found)))
                weight.append(np.full(len(found), times, np.int32))
            ids, shift, weight = np.concatenate(ids), np.concatenate(shift), np.concatenate(weight)
            for a in range(0, len(ids), CHUNK):  # a fragment belongs to the span that its pivot is in
                b = min(len(ids), a + CHUNK)
                lo, hi = max(0, a - SIDE), min(len(ids), b + SIDE)
                out = _span(ids[lo:hi], shift[lo:hi], weight[lo:hi], a - lo, b - lo)
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["part", "payload"])

        def _span(ids, shift, weight, a, b):
            times = weight.copy()
            times[:a] = times[b:] = 0
            return list(fragments(ids, shift, times, hot, parts))

        held, size = {}, 0
        for b in batches:
            tails = b.column(2).to_pylist() if b.num_columns > 2 else [None] * b.num_rows
            for lang, text, tail in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), tails, strict=True):
                seen = held.get((lang, text))
                if seen:
                    seen[0] += 1
                    continue
                held[lang, text] = [1, {x["word"].encode(): x["id"] for x in tail} if tail else None]
                size += len(text) + 100
                if size > 6 << 20:
                    yield from sent(held)
                    held, size = {}, 0
        if held:
            yield from sent(held)

    return rows.mapInArrow(run, "part int, payload binary")


def _counted(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of keys and the sum of their weights."""
    h = np.zeros(len(keys), np.uint64)
    for c in range(keys.shape[1]):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + keys[:, c].astype(np.uint64) + np.uint64(1))
    order = np.argsort(h, kind="stable")
    rows = keys[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    if (new[1:] & (h[order][1:] == h[order][:-1])).any():  # two phrases with one hash: in full order
        order = np.lexsort(keys.T[::-1])
        rows = keys[order]
        new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    first = np.flatnonzero(new)
    return rows[first], np.add.reduceat(weight[order].astype(np.int64), first)


def phrases(payloads: list[bytes], hot: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of word numbers and counts of the phrases of a part whose pivot owns them; with a pivot under hot, all, else frequent ones."""
    shapes, times, flats = [], [], []
    for p in payloads:
        n = int(np.frombuffer(p, np.int32, 1)[0])
        shapes.append(np.frombuffer(p, np.uint8, n, 4))
        times.append(np.frombuffer(p, np.int32, n, 4 + n) if (4 + n) % 4 == 0 else np.frombuffer(p[4 + n : 4 + 5 * n], np.int32))
        flats.append(np.frombuffer(p[4 + 5 * n :], np.int32))
    shape, weight, flat = np.concatenate(shapes).astype(np.int64), np.concatenate(times), np.concatenate(flats)
    left, right = shape // LONGEST, shape % LONGEST
    begin = np.concatenate([[0], np.cumsum(left + right + 1)[:-1]])
    for size in range(2, LONGEST + 1):
        keys, pivots, weights = [], [], []
        for i in range(size):
            own = np.flatnonzero((left >= i) & (right >= size - 1 - i) & (weight > 0))
            at = begin[own] + left[own]
            keys.append(flat[(at - i)[:, None] + np.arange(size)])
            pivots.append(flat[at])
            weights.append(weight[own])
        key = np.concatenate([np.concatenate(keys), np.concatenate(pivots)[:, None]], axis=1)
        if not len(key):
            continue
        rows, count = _counted(key, np.concatenate(weights))
        keep = (count >= least) | (rows[:, -1] < hot)
        if keep.any():
            yield rows[keep, :-1], count[keep]


def mine(rows: DataFrame, hot: int) -> DataFrame:
    """g (word numbers), a: counts of phrases; hot pivots' counts are of one part each. rows: partitioned and sorted by part."""
    least = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
            for g, count in phrases(payloads, hot, least):
                offsets = np.arange(0, g.size + 1, g.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(g.ravel(), pa.int32())), pa.array(count, pa.int64())], ["g", "a"])

        held, of = [], None
        for b in batches:
            for part, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != of and held:
                    yield from batch(held)
                    held = []
                of = part
                held.append(payload)
        if held:
            yield from batch(held)

    return rows.select("part", "payload").mapInArrow(run, "g array<int>, a long").groupBy("g").agg(F.sum("a").alias("a")).where(F.col("a") >= LEAST)


def frequent_phrases(store: common.Durable, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """g and a of the frequent phrases; lang, word, n, id of the frequent words; lang, n of the languages."""
    spark, rows = docs.sparkSession, _source(docs)
    counts = store.put(word_counts(rows))
    words = numbered(store, counts)
    langs = store.put(counts.where("word is null").select("lang", "n"))
    head, outside = _head(words)
    total, = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()
    # words with so many places: all words / PART_PLACES at most, 8 bytes each
    hot = np.array([-(-r.n // PART_PLACES) for r in words.where(F.col("n") > PART_PLACES).orderBy("id").select("n").toLocalIterator()], np.uint64)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // PART_WORDS))
    value = spark.sparkContext.broadcast(pickle.dumps((head, hot)))
    if outside:
        rows = _with_tail(rows, words, value)
    sent = rewrite(rows, value, parts).repartition(parts, "part").sortWithinPartitions("part")
    return store.put(mine(sent, len(hot))), words, langs


def scored(store: common.Durable, found: DataFrame, words: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score, dropped of all frequent phrases."""
    part = store.put(found.select("g", "a").unionByName(words.select(F.array(F.col("id").cast("int")).alias("g"), F.col("n").alias("a"))))
    spoken = found.select("g", "a", F.posexplode("g").alias("at", "id")).join(store.light(words).select(F.col("id").cast("int").alias("id"), "word", "lang"), "id")
    spoken = spoken.groupBy("g", "a").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    k = F.explode(F.sequence(F.lit(1), F.size("g") - 1)).alias("k")
    cuts = found.select("g", k).select("g", "k", F.slice("g", 1, F.col("k")).alias("first"), F.slice("g", F.col("k") + 1, F.size("g")).alias("rest"))
    small = store.light(part)
    cuts = cuts.join(small.select(F.col("g").alias("first"), F.col("a").alias("l")), "first").join(small.select(F.col("g").alias("rest"), F.col("a").alias("r")), "rest")
    whole = F.col("a").cast("decimal(19,0)") * 1000
    cuts = cuts.join(spoken, "g").join(store.light(langs).withColumnRenamed("lang", "spoken"), F.col("lang") == F.col("spoken"))
    product = whole.cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    cuts = cuts.withColumn("product", product).withColumn("under", F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)"))
    cuts = cuts.withColumn("score", F.expr("cast(product div under as bigint)"))
    best = cuts.groupBy("g", "a", "lang", "phrase", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    shorter = found.where(F.size("g") > 2).select("a", F.explode(F.array(F.expr("slice(g, 1, size(g) - 1)"), F.expr("slice(g, 2, size(g) - 1)"))).alias("g")).groupBy("g").agg(F.max("a").alias("inside"))
    out = best.join(shorter, "g", "left").select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"), (F.coalesce("inside", F.lit(0)) >= F.col("a")).alias("dropped"))
    return store.put(out)


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first of each language by score, a, phrase.

    A phrase inside a longer one that is as frequent is dropped. If so, one that is longer by one word is as frequent
    too, as counts can only fall on the way; therefore only those are looked at.
    """
    store = common.Durable(docs.sparkSession, "collocations")
    rows = scored(store, *frequent_phrases(store, docs)).where("not dropped").drop("dropped")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # first within shares of a language, then of what is left: no task sorts a whole language
    rows = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
