"""Pairs of alike texts inside blocks: exact, without comparing all pairs by the slow measure.

The measure is Ratcliff/Obershelp, 2 M / (a + b) with M matched characters and a, b characters in the texts. What M can
be at most is found in three steps, each dearer and closer than the one before, and only pairs that may still reach the
least likeness go on: the shorter text's length; the characters that the texts share, as counts in a matrix; the length
of their longest common subsequence, by bit operations over whole texts. Equal texts of a block are measured once.

A block of more than CHUNK rows is dealt to chunks by a hash, and each task has the rows of two chunks, so tasks are
bounded however large a block is; a row of a block of n rows goes to n / CHUNK tasks.

`alike_pairs` gives every pair of rows, of copies too. `alike_classes` makes one row of all copies first, so its work and its
result grow with the different texts of a block, not with the square of their copies. `alike_counts` gives each row's number of
pairs, so its result grows with the rows, however many texts are alike; it measures all pairs of different texts (`likeness`).
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from . import likeness
from .durable import Rounds

#: Rows of a chunk.
CHUNK = 1024
#: Classes of a chunk where they are counted, rows of a part of a class, and pairs that are measured at once.
CLASSES, MEMBERS, PAIRS = 2048, 256, 1 << 17


def common_subsequence(places: dict[str, int], n: int, other: str) -> int:
    """Length of the longest common subsequence of a text of n characters, given by the places of each character as bits, and another."""
    full = (1 << n) - 1
    v = full
    for ch in other:
        u = v & places.get(ch, 0)
        v = (v + u | v - u) & full
    return n - v.bit_count()


def _places(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, ch in enumerate(text):
        out[ch] = out.get(ch, 0) | 1 << i
    return out


def alike_texts(left: list[str], right: list[str] | None, least: float, counts: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """Index pairs of different texts that may reach `least`; right None: of one list with itself, i < j.

    counts: gets the number of pairs, of those with shared characters enough, and of those with a subsequence long enough.
    """
    texts = left + (right or [])
    letters = {ch: k for k, ch in enumerate(sorted(set().union(*texts)))} if texts else {}
    bags = np.zeros((len(texts), max(1, len(letters))), np.int16 if max(map(len, texts), default=0) < 30_000 else np.int32)
    for i, t in enumerate(texts):
        for ch in t:
            bags[i, letters[ch]] += 1
    size = np.array([len(t) for t in texts], np.int64)
    begin = len(left) if right is not None else 0
    order = begin + np.argsort(size[begin:], kind="stable")
    sorted_size, sorted_bags = size[order], bags[order]
    share = least / (2 - least)  # the shorter text has at least this share of the longer one's length
    for i in range(len(left)):
        a = np.searchsorted(sorted_size, np.floor(size[i] * share), "left")
        b = np.searchsorted(sorted_size, np.ceil(size[i] / share), "right") if share else len(order)
        has = np.flatnonzero(bags[i])
        shared = np.minimum(sorted_bags[a:b][:, has], bags[i, has]).sum(1, dtype=np.int64)
        may = order[a:b][2.0 * shared / np.maximum(1, sorted_size[a:b] + size[i]) >= least]
        if right is None:
            may = may[may > i]
        places, bag, kept = None, 0, 0
        for j in may.tolist():
            bag += 1
            if places is None:
                places = _places(texts[i])
            if 2.0 * common_subsequence(places, len(texts[i]), texts[j]) / (len(texts[i]) + len(texts[j])) >= least:
                kept += 1
                yield i, j - begin
        if counts is not None:
            counts[0] += len(order) if right is not None else len(left) - i - 1
            counts[1] += bag
            counts[2] += kept


def _ratio(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def _group(rows: list[tuple], counts: list[int]) -> Iterator[tuple]:
    """(id, carry of the first text, id, carry of the second, likeness) of a task's group: rows of one chunk, or of two.

    rows: side, first, last, key, least, carry; a row is all rows from the id first to last with its text. Those of a row come
    before some of another one if its first id is less than the other's last: these two ids are given, once for each order.
    """
    sides: list[dict[str, list]] = [{}, {}]
    for side, first, last, key, _, carry in rows:
        sides[side].setdefault(key, []).append((first, last, carry))
    least = rows[0][4]
    left, right = list(sides[0]), list(sides[1]) if any(r[0] for r in rows) else None

    def pairs(x: str, a: list, y: str, b: list) -> Iterator[tuple]:
        forth = back = None
        for i in a:
            for j in b:
                if i[0] < j[1]:
                    forth = _ratio(x, y) if forth is None else forth
                    if forth >= least:
                        yield i[0], i[2], j[1], j[2], forth
                if j[0] < i[1]:
                    back = _ratio(y, x) if back is None else back
                    if back >= least:
                        yield j[0], j[2], i[1], i[2], back

    def equal(i: tuple, j: tuple) -> Iterator[tuple]:
        if i[0] < j[1]:
            yield i[0], i[2], j[1], j[2], 1.0
        if j[0] < i[1]:
            yield j[0], j[2], i[1], i[2], 1.0

    for i, j in alike_texts(left, right, least, counts):
        x, y = left[i], (right or left)[j]
        if right is None or x != y:
            yield from pairs(x, sides[0][x], y, sides[0][y] if right is None else sides[1][y])
    for x, ids in sides[0].items():
        if right is None:
            for k, i in enumerate(ids):
                for j in ids[k + 1 :]:
                    yield from equal(i, j)
        elif x in sides[1]:
            for i in ids:
                for j in sides[1][x]:
                    yield from equal(i, j)


def _dealt(rows: DataFrame, block: list[str], chunk: int | None = None) -> DataFrame:
    """rows for each pair of chunks (i, j) that they take part in, side 0 or 1; partitioned and sorted by block and chunks."""
    tables = Rounds(rows.sparkSession)
    rows = tables.put((rows if "first" in rows.columns else _each(rows, block)).where("key <> ''"))
    held = [c for c in rows.columns if c not in block]
    size = F.lit(chunk or CHUNK)
    large = tables.put(rows.groupBy(*block).agg(F.count("*").alias("_n")).where(F.col("_n") > size).select(*(F.col(c).alias(f"_{c}") for c in block), F.ceil(F.col("_n") / size).cast("int").alias("_k")))
    k = F.coalesce("_k", F.lit(1))
    df = rows.join(large, _equal(block), "left").withColumn("_c", F.pmod(F.xxhash64("first"), k).cast("int"))
    df = df.withColumn("_d", F.explode(F.sequence(F.lit(0), k - 1)))
    df = df.select(*block, F.least("_c", "_d").alias("_i"), F.greatest("_c", "_d").alias("_j"), (F.col("_c") > F.col("_d")).cast("int").alias("_side"), *held)
    # a number of parts, as parts of few bytes are put together otherwise, though it takes long to compare their rows
    return df.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *block, "_i", "_j").sortWithinPartitions(*block, "_i", "_j")


def _equal(by: list[str]):
    """The columns are as those of the other side, which begin with _."""
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return on


def _solved(rows: DataFrame, block: list[str], schema: str | StructType, give, chunk: int | None = None) -> DataFrame:
    width = len(block) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[:width] != of and held:
                    yield from give(held)
                    held = []
                of = r[:width]
                held.append(r[width:])
        if held:
            yield from give(held)

    return _dealt(rows, block, chunk).mapInArrow(run, schema)


def _each(rows: DataFrame, block: list[str]) -> DataFrame:
    return rows.select(*block, F.col("id").alias("first"), F.col("id").alias("last"), "key", "least", "carry")


def _alike(rows: DataFrame, block: list[str]) -> DataFrame:
    kind, carried = (rows.schema[c].dataType for c in ("first", "carry"))
    schema = StructType([StructField("l", kind), StructField("r", kind), StructField("s", DoubleType()), StructField("l_carry", carried), StructField("r_carry", carried)])
    arrow = to_arrow_schema(schema)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        l, l_carry, r, r_carry, s = zip(*out, strict=True)  # noqa: E741
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((l, r, s, l_carry, r_carry), arrow.types, strict=True)], schema=arrow)

    def give(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for p in _group(held, [0, 0, 0]):
            out.append(p)
            if len(out) == 20_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return _solved(rows, block, schema, give)


def alike_pairs(rows: DataFrame, block: list[str]) -> DataFrame:
    """l, r, s, l_carry, r_carry of the pairs of a block whose likeness reaches the block's least.

    rows: id, key, least (at most 1), carry (any column) and the block's columns. l is the smaller id and the measure's
    first text. Empty or null keys are like nothing; rows with one id make no pair.
    """
    return _alike(_each(rows, block), block)


def alike_classes(rows: DataFrame, block: list[str]) -> tuple[DataFrame, DataFrame]:
    """All that alike_pairs says, as links between classes, and the classes' members. A class is all rows of a block with one key and carry.

    Links are l, r, s, l_carry, r_carry as of alike_pairs, one for each two classes and order of their texts: l is the smallest id
    of its class, r the greatest of its own, and each row of l's class is linked to every row of r's class that has a greater
    id. The measure depends on the order, so two classes have up to two links. Members are first (the class's smallest id),
    id and carry of the other rows; those of a class are alike by 1.
    """
    by = [*block, "key", "least", "carry"]
    rows = Rounds(rows.sparkSession).put(rows.where("key <> ''").select(*by, "id"))
    classes = rows.groupBy(*by).agg(F.min("id").alias("first"), F.max("id").alias("last"))
    classes = Rounds(rows.sparkSession).put(classes)
    several = classes.where(F.col("first") < F.col("last")).select(*(F.col(c).alias(f"_{c}") for c in by), "first")
    members = rows.join(several, _equal(by)).where(F.col("id") > F.col("first")).select("first", "id", "carry")
    return _alike(classes.select(*block, "first", "last", "key", "least", "carry"), block), members


def _bounds(value: float | None, longest: int) -> np.ndarray:
    """By the characters of two texts, how many must match for a likeness of value or more; None: more than can."""
    total = np.arange(2 * longest + 1)
    if value is None:
        return total + 1
    m = np.clip(np.ceil(value * total / 2).astype(np.int64) - 1, 0, None)
    for _ in range(2):  # by the measure's own arithmetic
        m += 2.0 * m / np.maximum(1, total) < value
    return m


def _counted(rows: list[tuple]) -> tuple[list, np.ndarray]:
    """ids and how many rows each is alike to, of a task's group: classes (or parts of them) of one chunk, or of two.

    rows: side, first, key, least, below, kind, apart, ids.
    """
    rank = {v: k for k, v in enumerate(sorted({i for r in rows for i in r[-1]}))}
    held = sorted(((r[0], np.sort(np.array([rank[i] for i in r[-1]], np.int64)), r) for r in rows), key=lambda h: (h[0], h[1][0]))
    members = [h[1] for h in held]
    texts = likeness.Compared([h[2][2] for h in held])
    longest = int(texts.size.max())
    number = np.int16 if longest < 8000 else np.int32
    first, last, size = np.array([m[0] for m in members]), np.array([m[-1] for m in members]), texts.size.astype(number)
    even = size.min() == size.max()  # one number of characters, as of names with numbers in them
    least = _bounds(rows[0][3], longest).astype(number)
    bounds = list({h[2][4] for h in held})
    below = np.stack([_bounds(b, longest) for b in bounds]).astype(number)
    bound = np.array([bounds.index(h[2][4]) for h in held])
    codes: list[dict] = [{}, {}]
    kind = np.array([codes[0].setdefault(h[2][5], len(codes[0])) for h in held])
    apart = np.array([-1 if h[2][6] is None else codes[1].setdefault(h[2][6], len(codes[1])) for h in held])
    cut = sum(h[0] == 0 for h in held)
    single = all(len(m) == 1 for m in members)
    begin = np.concatenate([[0], np.cumsum([len(m) for m in members])])
    out = np.zeros(begin[-1], np.int64)  # for each row of held's classes
    for xs, ys in [(slice(0, cut), slice(0, cut))] if cut == len(held) else [(slice(0, cut), slice(cut, len(held))), (slice(cut, len(held)), slice(0, cut))]:
        all_links = None if single else np.zeros((xs.stop - xs.start, ys.stop - ys.start), bool)
        reach = np.maximum.accumulate(last[ys])
        step = max(1, PAIRS // max(1, ys.stop - ys.start))
        for a in range(xs.start, xs.stop, step):
            x = slice(a, min(a + step, xs.stop))
            y = slice(ys.start + int(np.searchsorted(reach, first[a], "right")), ys.stop)  # classes that have a greater id than one of these
            if y.start == y.stop:
                continue
            shape = (x.stop - x.start, y.stop - y.start)
            total = np.full(shape, 2 * size[0], number) if even else size[x][:, None] + size[y]
            enough = np.full(shape, least[2 * size[0]], number) if even else least[total]
            if even and len(bounds) == 1:
                most = np.full(shape, below[0][2 * size[0]], number)
            else:
                most = below[bound[x]][np.arange(shape[0])[:, None], total]
            if len(codes[0]) > 1:
                most = np.where(kind[x][:, None] == kind[y], most, total + number(1))
            never = first[x][:, None] >= last[y]
            if len(codes[1]):
                never |= (apart[x][:, None] == apart[y]) & (apart[y] >= 0)
            most[never] = 0
            links = texts.links(x, y, enough, most)
            if single:
                out[x] += links.sum(1)
                out[y] += links.sum(0)
            else:
                all_links[a - xs.start : x.stop - xs.start, y.start - ys.start :] = links
        if not single:
            _add_rows(out, begin, members, xs, ys, all_links)
    return [i for h in held for i in sorted(h[2][-1])], out


def _add_rows(out: np.ndarray, begin: np.ndarray, members: list[np.ndarray], xs: slice, ys: slice, links: np.ndarray) -> None:
    """Adds to out, for each row of a class of xs, the rows of the classes of ys that it is linked to and that have greater ids; for those of ys likewise."""

    def add(own: slice, other: slice, links: np.ndarray, greater: bool) -> None:
        of = np.repeat(np.arange(other.stop - other.start), [len(m) for m in members[other]])
        ids = np.concatenate(members[other])
        order = np.argsort(ids, kind="stable")
        of, ids = of[order], ids[order]
        for k in np.flatnonzero(links.any(1)):
            m, c = members[own.start + k], np.concatenate([[0], np.cumsum(links[k][of])])
            out[begin[own.start + k] : begin[own.start + k + 1]] += c[-1] - c[np.searchsorted(ids, m, "right")] if greater else c[np.searchsorted(ids, m, "left")]

    add(xs, ys, links, True)
    add(ys, xs, links.T, False)


def alike_counts(rows: DataFrame, block: list[str]) -> DataFrame:
    """id, class_id, n_links: to how many rows of its block a row is alike, one row for each id.

    rows: a table (it is read three times) of id, key, least (at most 1, of the block), and below, kind, apart: rows of one kind (null is one too) are linked below the
    likeness `below` of the first only (null: no bound, and it is the same for all rows of a kind); rows of one value of apart
    aren't linked (null: with others they are). The measure's first text is that of the smaller id; copies are alike by 1. Rows
    with one id make no pair, those without none either. class_id is the smallest id with the row's key, kind and apart; rows
    with empty or null keys are like nothing and their own class.
    """
    by = [*block, "key", "least", "below", "kind", "apart"]
    of = [F.col(c).alias(f"_{c}") for c in by]
    tables = Rounds(rows.sparkSession)
    texts = rows.where("key <> '' and id is not null").select(*by, "id")
    large = tables.put(texts.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > MEMBERS).select(*of, F.ceil(F.col("_n") / MEMBERS).cast("int").alias("_k")))
    parts = texts.join(large, _equal(by), "left").withColumn("_p", F.pmod(F.xxhash64("id"), F.coalesce("_k", F.lit(1))))
    parts = parts.groupBy(*by, "_k", "_p").agg(F.collect_list("id").alias("ids"))
    parts = tables.put(parts.select(*block, F.array_min("ids").alias("first"), "key", "least", "below", "kind", "apart", "ids", "_k"))
    classes = parts.where("_k is not null").groupBy(*by).agg(F.min("first").alias("_first")).select(*of, "_first")
    named = parts.where("_k is not null").join(classes, _equal(by)).select("ids", F.col("_first").alias("class_id")).unionByName(parts.where("_k is null").select("ids", F.col("first").alias("class_id")))
    schema = StructType([StructField("id", rows.schema["id"].dataType), StructField("n", LongType())])
    arrow = to_arrow_schema(schema)

    def give(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, n = _counted(held)
        for at in range(0, len(ids), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 20_000], arrow.types[0]), pa.array(n[at : at + 20_000])], schema=arrow)

    counts = _solved(parts.drop("_k"), block, schema, give, CLASSES)
    none = F.lit(0).cast("long").alias("n")
    out = counts.select("id", F.lit(None).cast(rows.schema["id"].dataType).alias("class_id"), "n")
    out = out.unionByName(named.select(F.explode("ids").alias("id"), "class_id", none)).unionByName(rows.where("coalesce(key, '') = '' or id is null").select("id", F.col("id").alias("class_id"), none))
    return out.groupBy("id").agg(F.min("class_id").alias("class_id"), F.sum("n").alias("n_links"))


def filter_counts(rows: DataFrame, block: list[str]) -> DataFrame:
    """One row: pairs of different texts in the blocks, those with shared characters enough, those that were measured."""

    def give(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        counts = [0, 0, 0]
        for _ in _group(held, counts):
            pass
        yield pa.RecordBatch.from_pydict({n: [c] for n, c in zip(("pairs", "shared", "measured"), counts, strict=True)})

    return _solved(_each(rows, block), block, "pairs long, shared long, measured long", give).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "shared", "measured")))
