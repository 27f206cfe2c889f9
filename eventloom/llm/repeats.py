"""Removal of repeated passages: every byte covered by a string of 400 bytes that also starts anywhere else.

Each window of 400 bytes has an anchor, the 200-byte string in it whose hash is least (the leftmost of equal ones). Equal
windows have equal anchors, so two equal windows meet where the windows of one anchor are brought together. Neighbouring
windows with the anchor at one place make a region. Steps, each over all rows:

1. One pass over the texts finds the anchors. Those whose hash occurs once in the whole table can have no repeated window.
2. The regions of the others are cut out of the texts and counted by their content: copies meet as numbers, not as bytes.
   All windows of a region that occurs twice are repeated.
3. The different regions of an anchor are put one after the other (the anchor itself as one symbol) and a suffix array is
   built by Lyndon grouping (see suffix_grouping). Windows that are repeated are neighbours in it and are compared. What
   lies further from the anchor than any other region agrees is cut off first: no repeated window reaches there.
4. The regions of an anchor with more than BLOCK different ones are dealt to blocks, each with a suffix array of its own.
   Each block's different windows are then compared with the other blocks' by 128-bit digests, packed by digest.
5. Repeated windows go back to their texts as byte ranges.

Tasks hold one block or one part of digests. Hashes choose candidates only; windows are compared byte for byte inside a block,
regions and windows between blocks by 128 bits. Texts are identified by 128 bits of their SHA-256.

Null is an empty text. Texts under 400 bytes lose nothing. Rows that repeat a text (of 400 bytes or more) lose all of it in
each row. Rows without or with repeated doc_id are judged each on its own. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .suffix_grouping import suffix_array

WINDOW, ANCHOR = 400, 200
#: Windows that share an anchor differ in the place of it: so many grams a window has.
GRAMS = WINDOW - ANCHOR + 1
#: Bytes of text whose anchors are found at a time; bits of a place in them.
CHUNK, PLACE_BITS = 1 << 20, np.uint64(21)
#: Different regions of one anchor in one suffix array; bytes of digests in a part.
BLOCK, PART_BYTES = 512, 16 << 20
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
#: A region's bytes before its anchor, the anchor, its bytes after; neither byte occurs in UTF-8.
_ANCHOR_BYTE, _END_BYTE = b"\xff", b"\xfe"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte; powers of an odd number and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    n = CHUNK + WINDOW + 1
    powers, inverse = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64), np.multiply.accumulate(powers), np.multiply.accumulate(inverse)


def anchors(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first window, last window and anchor of each region in texts that stand one after the other and end at ends.

    Places count from the start of data. data: CHUNK + WINDOW - 1 bytes at most.
    """
    a = np.frombuffer(data, np.uint8)
    windows = len(a) - WINDOW + 1
    if windows <= 0:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    number, powers, inverse = _tables()
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(number[a] * powers[: len(a)], out=total[1:])
    grams = (total[ANCHOR:] - total[:-ANCHOR]) * inverse[: len(a) - ANCHOR + 1]
    grams ^= grams >> np.uint64(31)
    grams *= _MIX
    grams ^= grams >> np.uint64(29)
    marked = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    rows = np.full(-(-len(grams) // GRAMS) * GRAMS, ~np.uint64(0))
    rows[: len(grams)] = marked
    rows = rows.reshape(-1, GRAMS)
    upto = np.minimum.accumulate(rows, 1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(since[:windows], upto[GRAMS - 1 : GRAMS - 1 + windows])
    at = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = np.searchsorted(ends, np.arange(windows), side="right")
    valid = np.arange(windows) + WINDOW <= ends[np.minimum(text, len(ends) - 1)]
    starts = np.flatnonzero(valid & np.concatenate([[True], (np.diff(at) != 0) | (np.diff(text) != 0)]))
    last = np.flatnonzero(valid & np.concatenate([(np.diff(at) != 0) | (np.diff(text) != 0) | ~valid[1:], [True]]))
    return grams[at[starts]], starts, last, at[starts]


def text_anchors(texts: list[bytes]) -> list[tuple[np.ndarray, ...]]:
    """For each text the regions' hashes, first and last windows and anchors, as places in the text."""
    out, i = [], 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:
            parts = []
            for c in range(0, len(texts[i]), CHUNK):
                piece = texts[i][c : c + CHUNK + WINDOW - 1]
                h, s, e, p = anchors(piece, np.array([len(piece)]))
                parts.append((h, s + c, e + c, p + c))
            out.append(tuple(map(np.concatenate, zip(*parts, strict=True))))
            i += 1
            continue
        k, size = i, 0
        while k < len(texts) and size + len(texts[k]) <= CHUNK:
            size += len(texts[k])
            k += 1
        ends = np.cumsum([len(t) for t in texts[i:k]])
        h, *places = anchors(b"".join(texts[i:k]), ends)
        cut = np.searchsorted(places[0], np.concatenate([[0], ends]))
        for t in range(k - i):
            own = slice(cut[t], cut[t + 1])
            out.append((h[own], *(x[own] - (ends[t] - len(texts[i + t])) for x in places)))
        i = k
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and the text's key."""
    text = F.coalesce("text", F.lit(""))
    return common.id_text(docs).select("doc_id", text.alias("text"), F.unhex(F.left(F.sha2(text.cast("binary"), 256), F.lit(32))).alias("key"))


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat.astype(np.int32), kind))


def find_anchors(rows: DataFrame) -> DataFrame:
    """key and the regions' hashes h, first and last windows s and e, anchors p, of texts of WINDOW bytes or more."""

    def start():
        def step(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = text_anchors([t.encode() for t in b.column(1).to_pylist()])
            columns = [_lists([f[k] for f in found], pa.int32() if k else pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["key", "h", "s", "e", "p"])

        return step

    long = rows.where(F.octet_length("text") >= WINDOW).select("key", "text")
    return common.map_rows(long, "key binary, h array<long>, s array<int>, e array<int>, p array<int>", start, rows=1024, most_bytes=CHUNK)


REGION = "key binary, g1 long, g2 long, d1 long, d2 long, s array<int>, n long, windows int, pre int, body binary"


def _numbers(digest: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(digest, np.int64).tolist())


def cut_regions(rows: DataFrame) -> DataFrame:
    """The regions of each text by the digests g of its anchor and d of its content. rows: key, text, regions (s, e, p).

    s: where it starts; n: how often it was met by this row; body: what stands before and after the anchor, once a task.
    A task counts a text that it has met before once more and then no more: two are as good as many.
    """

    def start():
        met: dict[bytes, int] = {}
        sent: set[bytes] = set()

        def step(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            out: list[list] = [[] for _ in REGION.split(", ")]
            for key, text, regions in zip(*(c.to_pylist() for c in b.columns), strict=True):
                times = met.get(key, 0)
                if len(met) > 300_000:
                    met.clear()
                met[key] = times + 1
                if times > 1:
                    continue
                data, found = text.encode(), {}
                for r in regions:
                    s, e, p = r["s"], r["e"], r["p"]
                    gram = xxhash.xxh3_128_digest(data[p : p + ANCHOR])
                    content = xxhash.xxh3_128_digest(data[s : e + WINDOW], seed=p - s)
                    found.setdefault((gram, content), []).append((s, e, p))
                if len(sent) > 300_000:
                    sent.clear()
                for (gram, content), places in found.items():
                    s, e, p = places[0]
                    new = gram + content not in sent
                    sent.add(gram + content)
                    body = data[s:p] + data[p + ANCHOR : e + WINDOW] if new else None
                    for column, v in zip(out, (key, *_numbers(gram), *_numbers(content), [x[0] for x in places], len(places), e - s + 1, p - s, body), strict=True):
                        column.append(v)
            types = [pa.binary(), *[pa.int64()] * 4, pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], [c.split()[0] for c in REGION.split(", ")])

        return step

    return common.map_rows(rows.select("key", "text", "regions"), REGION, start)


def _agreed(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _reach(sides: list[bytes]) -> list[int]:
    """For each text the length of the longest prefix that it shares with another: sorted, with one of its neighbours."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for i, j in zip(order, order[1:]):
        n = _agreed(sides[i], sides[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def repeated_windows(regions: list[tuple[bytes, int, int, int]]) -> list[np.ndarray]:
    """For each region (body, pre, windows, n) of one anchor which windows are repeated; n: how often the region occurs."""
    width = WINDOW - ANCHOR + 1
    left = _reach([body[:pre][::-1] for body, pre, _, _ in regions])
    right = _reach([body[pre:] for body, pre, _, _ in regions])
    flags = [np.full(w, n > 1) for _, _, w, n in regions]
    raw, at, owner = b"", [0] * len(regions), []
    for k, (body, pre, windows, _) in enumerate(regions):
        first, last = max(0, pre - left[k]), min(windows - 1, pre + right[k] - (width - 1))
        if first > last:
            continue
        at[k] = len(raw) - first
        piece = body[first:pre] + _ANCHOR_BYTE + body[pre : last + width - 1] + _END_BYTE
        owner += [k] * (last - first + 1) + [-1] * (len(piece) - (last - first + 1))
        raw += piece
    before = -1
    for i in suffix_array([c + 1 for c in raw] + [0]) if raw else ():
        k = owner[i] if i < len(owner) else -1
        if k < 0:
            continue
        if before >= 0 and raw[before : before + width] == raw[i : i + width]:
            flags[k][i - at[k]] = flags[owner[before]][before - at[owner[before]]] = True
        before = i
    return flags


def runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2].tolist(), (edge[1::2] - 1).tolist()


FOUND = "g1 long, g2 long, d1 long, d2 long, a array<int>, b array<int>, part int, payload binary"
_LEFT = np.dtype([("x1", "<i8"), ("x2", "<i8"), ("g1", "<i8"), ("g2", "<i8"), ("d1", "<i8"), ("d2", "<i8"), ("at", "<i4")])


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [*[pa.int64()] * 4, pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], [c.split()[0] for c in FOUND.split(", ")])


def match_blocks(rows: DataFrame, parts: int) -> DataFrame:
    """Runs a..b of repeated windows of each region; of anchors with several blocks also the different windows' digests by part.

    rows: partitioned and sorted by g1, g2, block; blocks: the anchor's number of them.
    """
    names = ["g1", "g2", "block", "blocks", "d1", "d2", "body", "pre", "windows", "n"]

    def solve(group: list[tuple]) -> Iterator[tuple]:
        flags = repeated_windows([(r[6], r[7], r[8], r[9]) for r in group])
        left, sent = [], set()
        for r, f in zip(group, flags, strict=True):
            ids = (r[0], r[1], r[4], r[5])
            if f.any():
                yield (*ids, *runs(f), None, None)
            if r[3] > 1:
                whole = r[6][: r[7]] + _ANCHOR_BYTE + r[6][r[7] :]
                for i, repeated in enumerate(f.tolist()):
                    digest = xxhash.xxh3_128_digest(whole[i : i + WINDOW - ANCHOR + 1])
                    if not repeated or digest not in sent:  # of those that the block has found, one each
                        sent.add(digest)
                        left.append((*_numbers(digest), *ids, i))
        if left:
            table = np.array(left, _LEFT)
            part = (table["x1"].view(np.uint64) % np.uint64(parts)).astype(np.int32)
            for p in np.unique(part).tolist():
                yield (None, None, None, None, None, None, p, table[part == p].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, out, of = [], [], None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[:3] != of:
                    if group:
                        out += solve(group)
                    group, of = [], r[:3]
                    if len(out) > 500:
                        yield _found_batch(out)
                        out = []
                group.append(r)
        if group:
            out += solve(group)
        if out:
            yield _found_batch(out)

    return rows.select(names).mapInArrow(run, FOUND)


def match_digests(rows: DataFrame) -> DataFrame:
    """Runs of windows whose digests meet in a part. rows: part, payload, partitioned and sorted by part."""

    def solve(payloads: list[bytes]) -> list[tuple]:
        table = np.frombuffer(b"".join(payloads), _LEFT)
        table = table[np.lexsort([table["x2"], table["x1"], table["g2"], table["g1"]])]
        same = (table["x1"][1:] == table["x1"][:-1]) & (table["x2"][1:] == table["x2"][:-1]) & (table["g1"][1:] == table["g1"][:-1]) & (table["g2"][1:] == table["g2"][:-1])
        table = table[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        found: dict[tuple, list[int]] = {}
        for _, _, *ids, at in table.tolist():
            found.setdefault(tuple(ids), []).append(at)
        return [(*ids, sorted(at), sorted(at), None, None) for ids, at in found.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None
        for b in batches:
            for part, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != of and held:
                    yield _found_batch(solve(held))
                    held = []
                of = part
                held.append(payload)
        if held:
            yield _found_batch(solve(held))

    return rows.select("part", "payload").mapInArrow(run, FOUND).drop("part", "payload")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges a..b, b exclusive, joined where they meet."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _merge_ranges(rows: DataFrame) -> DataFrame:
    def start():
        def step(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            spans = [merged([(x["a"], x["b"]) for x in r]) for r in b.column(1).to_pylist()]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([[x[0] for x in s] for s in spans], kind), pa.array([[x[1] for x in s] for s in spans], kind)], ["key", "a", "b"])

        return step

    return common.map_rows(rows.select("key", "ranges"), "key binary, a array<int>, b array<int>", start)


def repeated_ranges(store: common.Durable, rows: DataFrame) -> DataFrame:
    """key and its text's byte ranges a..b (b exclusive) to remove; texts that lose nothing have no row. rows: of keyed()."""
    spark = store.spark
    found = store.put(find_anchors(rows))
    often = store.put(found.select(F.explode("h").alias("h")).groupBy("h").count().where("count > 1").select("h"))
    each = found.select("key", F.explode(F.arrays_zip("h", "s", "e", "p")).alias("r")).select("key", "r.*")
    places = store.put(each.join(store.light(often), "h").groupBy("key").agg(F.collect_set(F.struct("s", "e", "p")).alias("regions")))
    bits = common.key_filter(store, places, "key")
    regions = store.put(cut_regions(common.with_filter(rows.select("key", "text"), bits, "key").where("may_have").join(places, "key")))

    ids = ["g1", "g2", "d1", "d2"]
    different = store.put(regions.groupBy(*ids).agg(F.sum("n").alias("n"), F.first("windows").alias("windows"), F.first("pre").alias("pre"), F.max("body").alias("body")))
    many = store.put(different.groupBy("g1", "g2").agg(F.count("*").alias("m"), F.min("n").alias("least"), F.sum("windows").alias("w")).where("m > 1 and least < 2").withColumn("blocks", F.ceil(F.col("m") / BLOCK)))
    left = many.where("blocks > 1").agg(F.sum("w")).first()[0] or 0
    parts = max(1, -(-left * _LEFT.itemsize // PART_BYTES))
    size = different.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size >> 18)
    blocked = different.join(store.light(many).select("g1", "g2", "blocks"), ["g1", "g2"]).withColumn("block", F.pmod("d1", "blocks"))
    blocked = blocked.repartition(tasks, "g1", "g2", "block").sortWithinPartitions("g1", "g2", "block")
    matched = store.put(match_blocks(blocked, parts))
    rest = matched.where("payload is not null").select("part", "payload").repartition(max(parts, 1), "part").sortWithinPartitions("part")
    whole = different.where("n > 1").select(*ids, F.array(F.lit(0)).alias("a"), F.array(F.col("windows") - 1).alias("b"))
    out = matched.where("payload is null").drop("part", "payload").unionByName(match_digests(rest)).unionByName(whole)
    out = store.put(out)
    back = regions.select("key", *ids, "s").join(store.light(out), ids)
    ranges = F.expr(f"flatten(transform(s, x -> transform(arrays_zip(a, b), r -> struct(x + r.a as a, x + r.b + {WINDOW} as b))))")
    gathered = back.select("key", ranges.alias("ranges")).groupBy("key").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))
    return store.put(_merge_ranges(gathered))


def _applied(rows: DataFrame) -> DataFrame:
    def start():
        def step(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            size, removed, spans, digest, kept_text = [], [], [], [], []
            for text, a, e in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                data, at, kept = text.encode(), 0, []
                for x, y in zip(a or [], e or [], strict=True):
                    kept.append(data[at:x])
                    at = y
                kept = b"".join([*kept, data[at:]])
                size.append(len(data))
                removed.append(len(data) - len(kept))
                spans.append(len(a or []))
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(kept_text, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

        return step

    return common.map_rows(rows.select("doc_id", "text", "a", "b"), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", start)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept of each row (a cut may fall inside a character)."""
    store = common.Durable(docs.sparkSession, "repeats")
    rows = keyed(docs)
    ranges = repeated_ranges(store, rows)
    marked = common.with_filter(rows, common.key_filter(store, ranges, "key"), "key")
    none = F.lit(None).cast("array<int>")
    whole = marked.where("not may_have").withColumns({"a": none, "b": none})
    return _applied(marked.where("may_have").join(ranges, "key", "left").unionByName(whole))


def removed(docs: DataFrame) -> DataFrame:
    """without_repeats without the bytes."""
    return without_repeats(docs).drop("kept")
