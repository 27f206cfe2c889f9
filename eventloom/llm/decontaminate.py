"""Benchmark decontamination with suffix arrays over the training words.

Each task makes suffix arrays of its documents' words, shard by shard, and looks up benchmark suffixes in them by binary
search: those whose first words stand somewhere in the shard. Places that follow each other in both texts are one
verbatim match, as long as can be; the matches' words are hit, and the longest of a document is reported with its places.
Words that no benchmark item has end all matches, so only runs of benchmark words as long as the shortest window get
suffixes; that loses nothing.

A benchmark of BENCH_BYTES at most is sent to all tasks. A larger one is dealt to parts by a hash of each window's first
words, as are the documents' runs of words that begin with such words (a bitmap of the hashes drops most others at once).
Each part has a suffix array of its different runs and looks up its windows; occurrences that follow each other in a
document and an item are then joined to verbatim matches by windows over their places.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z. A window is 13 consecutive words of an item; an item
of fewer words, but not none, is one window. Null texts have no words; items without an id are left out; repeated items
count once; repeated documents each get their row. Of equally long matches the first in the document, then in the
first item by its id as a string, is reported.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Bytes of benchmark text (four for each character) that are sent to every task; of windows in a part beyond.
BENCH_BYTES, BENCH_PART_BYTES = common.BROADCAST_BYTES, 8 << 20
#: Documents, and bytes of their texts, in one suffix array (but for a single longer text); words by which suffixes are chosen.
SHARD_ROWS, SHARD_BYTES, FIRST_WORDS = 2048, 16 << 20, 3


def first_words(flat: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words at each place; equal words have equal hashes."""
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = (out ^ flat[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low .. high - 1 of each pair, one after the other."""
    n = high - low
    return np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class Benchmark:
    """Item words as numbers from 1, and the windows and suffixes to look up."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.ids: list[str] = []
        flat: list[int] = []
        start, width, item = [], [], []
        size = []
        for item_id, text in sorted(set(items)):
            words = common.word_bytes(text)
            if not words:
                continue
            m, at = min(window, len(words)), len(flat)
            flat += [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            start += range(at, at + len(words) - m + 1)
            width += [m] * (len(words) - m + 1)
            item += [len(self.ids)] * (len(words) - m + 1)
            self.ids.append(item_id)
            size.append(len(words))
            flat += [0]
        self.start, self.width, self.item = (np.asarray(x, np.int64) for x in (start, width, item))
        #: Words of each item; its words begin where those of the items before, with a 0 after each, end.
        self.size = np.asarray(size, np.int64)
        self.least = int(self.width.min()) if len(width) else 0
        self.flat = np.concatenate([np.asarray(flat, np.int64), np.zeros(window + 1, np.int64)])
        keys = first_words(self.flat, self.start, min(FIRST_WORDS, self.least))
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, words, item and place in the item of each suffix of each item."""
        begin, n = np.cumsum(self.size + 1) - self.size - 1, self.size
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(begin, n) + at, np.repeat(n, n) - at, np.repeat(np.arange(len(n)), n), at


class Shard:
    """The suffix array of the words of some documents, restricted to runs of known words of at least `least`."""

    def __init__(self, docs: list[list[bytes]], vocab: dict[bytes, int], least: int):
        self.size = np.fromiter(map(len, docs), np.int64, len(docs))
        self.begin = np.concatenate([[0], np.cumsum(self.size + 1)])  # a 0 after each document
        self.flat = np.zeros(self.begin[-1] + 1, np.int64)
        for at, words in zip(self.begin, docs, strict=False):
            self.flat[at : at + len(words)] = np.fromiter(map(vocab.get, words, repeat(0)), np.int64, len(words))
        zero = np.flatnonzero(self.flat == 0)
        runs = np.diff(zero, prepend=-1) - 1
        long = np.flatnonzero(runs >= max(1, least))
        end = zero[long]
        n = runs[long]
        at = np.repeat(end - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.end = np.repeat(end, n)  # of the run
        self.sa = self._sorted(at, self.end)

    def _sorted(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Positions in the order of their suffixes up to the run's end, by doubling."""
        if not len(at):
            return at
        _, rank = np.unique(self.flat[at], return_inverse=True)
        rank = rank.astype(np.int64) + 1
        step, n, longest = 1, len(at), int((end - at).max())
        index = np.arange(n)
        while step < longest:
            nxt = index + step
            inside = at + step < end  # the run is stored without gaps
            second = np.where(inside, rank[np.minimum(nxt, n - 1)], 0)
            _, rank = np.unique(rank * (n + 1) + second, return_inverse=True)
            rank = rank.astype(np.int64) + 1
            if rank.max() == n:
                break
            step *= 2
        return at[np.argsort(rank, kind="stable")]

    def bound(self, b: Benchmark, start: np.ndarray, width: np.ndarray, after: bool) -> np.ndarray:
        """For each run of width words of b the first place in the suffix array that isn't below it (after: that is above it)."""
        low = np.zeros(len(start), np.int64)
        high = np.full(len(start), len(self.sa))
        while (open_ := low < high).any():
            mid = (low + high) // 2
            pos = self.sa[np.minimum(mid, len(self.sa) - 1)]
            order = np.zeros(len(mid), np.int64)  # of the suffix against the window
            for j in range(int(width.max())):
                todo = (order == 0) & (j < width)
                if not todo.any():
                    break
                order = np.where(todo, np.sign(self.flat[np.minimum(pos + j, len(self.flat) - 1)] - b.flat[start + np.minimum(j, width - 1)]), order)
            right = open_ & ((order < 0) | (after & (order == 0)))
            low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
        return low

    def occurrences(self, b: Benchmark) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) for each occurrence of each window."""
        if not len(self.sa) or not len(b.start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        here = np.unique(first_words(self.flat, self.sa, min(FIRST_WORDS, b.least)))
        todo = b.by_key[_ranges(np.searchsorted(b.keys, here), np.searchsorted(b.keys, here, side="right"))]
        if not len(todo):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        low, high = self.bound(b, b.start[todo], b.width[todo], False), self.bound(b, b.start[todo], b.width[todo], True)
        return self.sa[_ranges(low, high)], np.repeat(todo, high - low)

    def verbatim(self, b: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, window, length): where a longest verbatim match starts here and in its item, and its words.

        A window's occurrence that continues the one a word before, in the same item, belongs to that one's match.
        """
        pos, win = self.occurrences(b)
        order = np.lexsort((pos, pos - b.start[win]))
        pos, win = pos[order], win[order]
        going = (np.diff(pos) == 1) & (np.diff(b.start[win]) == 1)
        first = np.flatnonzero(np.concatenate([[True], ~going])) if len(pos) else np.empty(0, np.int64)
        last = np.append(first[1:], len(pos)) - 1
        return pos[first], win[first], last - first + b.width[win[first]]

    def longest(self, b: Benchmark, start: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, first position) of the longest match of each run of width words of b, 0 if its first word isn't here.

        The longest is shared with a neighbour of the place where the whole run would stand; all suffixes that share it
        stand next to each other, and the smallest of their positions is taken.
        """
        best, where = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        if not len(self.sa) or not len(start):
            return best, where
        place = self.bound(b, start, width, False)
        for candidate in (place - 1, place):
            ok = (candidate >= 0) & (candidate < len(self.sa))
            pos, length = self.sa[np.clip(candidate, 0, len(self.sa) - 1)], np.zeros(len(place), np.int64)
            while ok.any():
                a = self.flat[np.minimum(pos + length, len(self.flat) - 1)]
                c = b.flat[np.minimum(start + length, len(b.flat) - 1)]
                ok = ok & (length < width) & (a == c) & (a > 0)
                length += ok
            best = np.maximum(best, length)
        got = np.flatnonzero(best)
        low, high = self.bound(b, start[got], best[got], False), self.bound(b, start[got], best[got], True)
        least, step = self.sa, 1  # of the step positions from each place on
        while len(got):
            own = (high - low >= step) & (high - low < 2 * step)
            where[got[own]] = np.minimum(least[low[own]], least[high[own] - step])
            if 2 * step > len(self.sa):
                break
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        return best, where

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, pos, side="right") - 1


def items_of(bench: DataFrame) -> DataFrame:
    """item_id (string) and text of the items that have both."""
    return bench.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))


def is_small(bench: DataFrame) -> bool:
    return (items_of(bench).agg(F.sum(F.length("text").cast("long") * 4 + 64)).first()[0] or 0) <= BENCH_BYTES


def _merged(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) rows as disjoint rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[first, 0], reach[np.concatenate([np.flatnonzero(first)[1:] - 1, [len(spans) - 1]])]], 1)


SCHEMA = "doc_id long, text string, n_words long, spans array<int>, items array<string>, longest struct<length:bigint,word:bigint,item:string,item_word:bigint>"


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text, n_words, spans (start, end, start, end ... of the hit words, disjoint), items with an occurring window, and the longest match."""
    if not is_small(bench):
        return _matches_by_parts(docs, bench, window)
    rows = [tuple(r) for r in items_of(bench).toLocalIterator()]  # BENCH_BYTES at most
    shared, key = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

    def start():
        b = common.resident(("bench", key, window), lambda: Benchmark(shared.value, window))
        item_begin = np.cumsum(b.size + 1) - b.size - 1

        def step(batch: pa.RecordBatch):
            words = [common.word_bytes(t) for t in batch.column(1).to_pylist()]
            shard = Shard(words, b.vocab, b.least)
            pos, win, length = shard.verbatim(b)
            spans, items, longest = ([None if k == 2 else [] for _ in words] for k in range(3))
            if len(pos):
                doc = shard.doc_of(pos)
                order = np.argsort(doc, kind="stable")
                pos, win, length, doc = pos[order], win[order], length[order], doc[order]
                cut = np.flatnonzero(np.diff(doc)) + 1
                for p, w, n, d in zip(np.split(pos, cut), np.split(win, cut), np.split(length, cut), doc[np.concatenate([[0], cut])], strict=True):
                    own = np.stack([p, p + n], 1) - shard.begin[d]
                    spans[d] = _merged(own).ravel().tolist()
                    items[d] = sorted({b.ids[i] for i in np.unique(b.item[w])})
                    top = np.flatnonzero(n == n.max())
                    top = top[own[top, 0] == own[top, 0].min()]
                    k = min(top.tolist(), key=lambda k: (b.ids[b.item[w[k]]], b.start[w[k]]))
                    longest[d] = {"length": int(n[k]), "word": int(own[k, 0]), "item": b.ids[b.item[w[k]]], "item_word": int(b.start[w[k]] - item_begin[b.item[w[k]]])}
            kind = pa.struct([("length", pa.int64()), ("word", pa.int64()), ("item", pa.string()), ("item_word", pa.int64())])
            columns = [batch.column(0), batch.column(1), pa.array(shard.size), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())), pa.array(longest, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_words", "spans", "items", "longest"])

        return step

    return common.map_rows(common.id_text(docs), SCHEMA, start, SHARD_ROWS, SHARD_BYTES)


def _hashes(words: list[bytes], m: int, memo: common.Memo) -> np.ndarray:
    """A hash of the first words of each run of m words, and of m."""
    n = min(FIRST_WORDS, m)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    out = np.full(max(0, len(words) - m + 1), m, np.uint64)
    for k in range(n):
        out = (out ^ h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _windows(rows: DataFrame, sizes: list[int] | None, bits, window: int) -> DataFrame:
    """id, at, m, h, run: runs of m words with the hash of their first ones. rows: id, text.

    sizes None: an item's windows; else runs of these sizes whose hash is in the bitmap, a set of bits of FILTER_BITS.
    """
    schema = "id long, at int, m int, h long, run string"

    def start():
        memo = common.Memo(xxhash.xxh64_intdigest)
        known = None if bits is None else np.frombuffer(bits.value, np.uint8)

        def step(b: pa.RecordBatch):
            out: list[list] = [[], [], [], [], []]
            for i, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = common.word_bytes(text)
                for m in sizes or ([min(window, len(words))] if words else []):
                    h = _hashes(words, m, memo)
                    at = np.arange(len(h))
                    if known is not None:
                        bit = h.view(np.uint64) % np.uint64(common.FILTER_BITS)
                        at = np.flatnonzero(known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                    for column, v in zip(out, ([i] * len(at), at.tolist(), [m] * len(at), h[at].tolist(), [b" ".join(words[a : a + m]).decode() for a in at.tolist()]), strict=True):
                        column += v
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)], ["id", "at", "m", "h", "run"])

        return step

    return common.map_rows(rows.select("id", "text"), schema, start)


def _bitmap(store: common.Durable, windows: DataFrame):
    """The hashes of all windows as FILTER_BITS bits, broadcast: 8 MB, whatever the benchmark's size."""
    bit = F.pmod("h", F.lit(common.FILTER_BITS))
    rows = store.put(windows.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32768).alias("bucket")).agg(F.bitmap_construct_agg((F.col("bit") % 32768).cast("long")).alias("bitmap")))
    whole = bytearray(common.FILTER_BITS // 8)
    for r in rows.toLocalIterator():
        whole[r.bucket * 4096 : (r.bucket + 1) * 4096] = bytes(r.bitmap)
    return rows.sparkSession.sparkContext.broadcast(bytes(whole))


def _found_runs(runs: DataFrame, windows: DataFrame, parts: int) -> DataFrame:
    """m, run of the runs that are windows: each part's different runs as a suffix array, in which its windows are looked up."""
    rows = runs.select("m", "h", "run").distinct().withColumn("side", F.lit(1)).unionByName(windows.select("m", "h", "run").distinct().withColumn("side", F.lit(0)))
    rows = rows.withColumn("part", F.pmod("h", F.lit(parts)).cast("int")).repartition(parts, "part").sortWithinPartitions("part", "side")

    def solve(items: list[str], texts: list[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
        b = Benchmark([(run, run) for run in items], 1 << 20)  # an item is one window here
        shard = Shard([run.encode().split(b" ") for _, run in texts], b.vocab, b.least or 1)
        pos, win = shard.occurrences(b)
        doc = shard.doc_of(pos)
        whole = (pos == shard.begin[doc]) & (b.width[win] == shard.size[doc])
        got = np.unique(doc[whole])
        yield pa.RecordBatch.from_arrays([pa.array([texts[d][0] for d in got], pa.int32()), pa.array([texts[d][1] for d in got], pa.string())], ["m", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, texts, of, size = [], [], None, 0
        for batch in batches:
            for m, text, side, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != of or size > SHARD_BYTES:  # a part's windows stay for the next runs
                    if texts and items:
                        yield from solve(items, texts)
                    texts, size = [], 0
                    if part != of:
                        items, of = [], part
                if side:
                    texts.append((m, text))
                    size += len(text)
                else:
                    items.append(text)
        if texts and items:
            yield from solve(items, texts)

    return rows.select("m", "run", "side", "part").mapInArrow(run, "m int, run string")


def _matches_by_parts(docs: DataFrame, bench: DataFrame, window: int) -> DataFrame:
    """matches() for a benchmark that isn't sent to every task."""
    store = common.Durable(docs.sparkSession, "bench")
    items = store.put(items_of(bench).distinct().withColumn("id", F.monotonically_increasing_id()))
    windows = store.put(_windows(items, None, None, window).withColumnRenamed("id", "item_no").withColumnRenamed("at", "item_word"))
    sizes = sorted(r.m for r in windows.select("m").distinct().collect())  # `window` at most
    rows = store.put(common.id_text(docs).withColumn("id", F.monotonically_increasing_id()))
    runs = store.put(_windows(rows, sizes, _bitmap(store, windows), window)) if sizes else None
    if runs is None:
        return rows.select("doc_id", "text", _word_count("text"), F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"), F.lit(None).cast(SCHEMA.split("longest ")[1]).alias("longest"))
    size = windows.agg(F.sum(F.octet_length("run") + 32)).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BENCH_PART_BYTES))
    found = store.put(_found_runs(runs, windows, parts))
    # every side of these joins is a table, so hot runs and windows can be split
    mine = store.put(windows.join(found, ["m", "run"]).join(items.select(F.col("id").alias("item_no"), "item_id"), "item_no").select("m", "run", "item_no", "item_id", "item_word"))
    occurs = runs.join(found, ["m", "run"]).select("id", "at", "m", "run").join(mine, ["m", "run"]).select("id", "at", "m", "item_no", "item_id", "item_word")
    by = Window.partitionBy("id", "item_no", F.col("at") - F.col("item_word")).orderBy("at")
    going = F.col("at") - F.row_number().over(by)
    matched = occurs.withColumn("_run", going).groupBy("id", "item_no", "item_id", (F.col("at") - F.col("item_word")).alias("_shift"), "_run").agg(F.min("at").alias("word"), (F.max("at") - F.min("at") + F.max("m")).alias("length"), F.min("item_word").alias("item_word"))
    best = F.min(F.struct((-F.col("length")).alias("length"), "word", "item_id", "item_word")).alias("b")
    per = matched.groupBy("id").agg(F.array_sort(F.collect_set(F.struct(F.col("word").alias("a"), (F.col("word") + F.col("length")).alias("b")))).alias("ranges"), F.array_sort(F.collect_set("item_id")).alias("items"), best)
    per = store.put(_merged_ranges(per))
    kind = F.when(F.col("b").isNotNull(), F.struct((-F.col("b.length")).cast("long").alias("length"), F.col("b.word").cast("long").alias("word"), F.col("b.item_id").alias("item"), F.col("b.item_word").cast("long").alias("item_word")))
    out = rows.join(per, "id", "left")
    return out.select("doc_id", "text", _word_count("text"), F.coalesce("spans", F.array().cast("array<int>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), kind.alias("longest"))


def _word_count(text: str):
    return F.size(F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", " "), " "), lambda w: w != "")).cast("long").alias("n_words")


def _merged_ranges(per: DataFrame) -> DataFrame:
    """per with spans, the disjoint union of ranges, instead of ranges."""

    @F.arrow_udf("array<int>")
    def union(ranges: pa.Array) -> pa.Array:
        return pa.array([_merged(np.array([(x["a"], x["b"]) for x in r], np.int64)).ravel().tolist() for r in ranges.to_pylist()], pa.list_(pa.int32()))

    return per.withColumn("spans", union("ranges")).drop("ranges")


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, longest_match, contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    longest_match: words of the longest verbatim match with an item, 0 without a hit; matches() has its places.
    """
    return _judged(docs, bench, window).drop("_hash")


def _judged(docs: DataFrame, bench: DataFrame, window: int) -> DataFrame:
    hit = F.aggregate(F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)), F.lit(0).cast("long"), lambda a, i: a + F.get("spans", i + 1) - F.get("spans", i))
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return (
        matches(docs, bench, window)
        .select("doc_id", F.xxhash64("text").alias("_hash"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), F.coalesce("longest.length", F.lit(0).cast("long")).alias("longest_match"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def longest_matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, item_word, length, doc_id, word: the longest verbatim match of each item suffix in the whole corpus.

    Each shard gives one row a suffix whose first word it has; Spark takes the longest, then the smallest doc_id and word.
    """
    parts = []
    for block in _blocks(bench):
        shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def start(shared=shared, key=key):
            b = common.resident(("bench", key, window), lambda: Benchmark(shared.value, window))
            begin, width, item, at = b.suffixes()

            def step(batch: pa.RecordBatch):
                rows = sorted(zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True), key=lambda r: (r[0] is None, r[0] or 0))
                shard = Shard([common.word_bytes(t) for _, t in rows], b.vocab, 1)
                length, pos = shard.longest(b, begin, width)
                got = np.flatnonzero(length)
                doc = shard.doc_of(pos[got])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.ids[i] for i in item[got]], pa.string()), pa.array(at[got]), pa.array(length[got]), pa.array([rows[d][0] for d in doc], pa.int64()), pa.array(pos[got] - shard.begin[doc])],
                    ["item_id", "item_word", "length", "doc_id", "word"],
                )

            return step

        parts.append(common.map_rows(common.id_text(docs), "item_id string, item_word long, length long, doc_id long, word long", start, SHARD_ROWS, SHARD_BYTES))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    best = F.max_by(F.struct("length", "doc_id", "word"), F.struct("length", -F.col("doc_id"), -F.col("word"))).alias("b")
    return out.groupBy("item_id", "item_word").agg(best).select("item_id", "item_word", "b.*")


def _blocks(bench: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most BENCH_BYTES: every suffix of an item is looked up in every shard, so all have to pass by."""
    block, size = [], 0
    for r in items_of(bench).toLocalIterator():
        if block and size + len(r[1]) * 4 > BENCH_BYTES:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1]) * 4
    yield block


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, all columns; of different texts under one id each is judged on its own.

    The ids and text hashes to remove are written first: Spark broadcasts them while they are few, and shuffles beyond.
    """
    bad = _judged(docs, bench, window).where("contaminated").select(F.col("doc_id").alias("_bad"), "_hash").distinct()
    bad = common.Durable(docs.sparkSession, "contaminated").put(bad)
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]) & (F.xxhash64(docs["text"].cast("string")) == bad["_hash"]), "left_anti")
