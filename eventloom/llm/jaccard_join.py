"""N-gram Jaccard join by a partition of the universe, and the components of its links.

A text's set are the 64-bit hashes of its distinct five-word shingles. Two sets link at Jaccard similarity 0.8 or more,
so they differ in at most k shingles, where k follows from their sizes. Sizes fall into bands so that linked sets are
in the same band or neighbours. For each band the shingles' hashes are dealt to m segments. By the pigeonhole principle
linked sets agree in m - k segments at least. Each set keeps its k + 1 cheapest segments, in an order of cost that
depends on a segment's contents alone (many shingles before few), so the cheapest segment that both share is kept by
both. For small sets, segments with their one-deletion neighbourhoods cost less: there (k + 1) / 2 segments do, since one
of them differs by at most one shingle. A cost estimate decides for each band.

Nothing is lost, and no group is expanded into all its pairs: sets of equal 128-bit content are one class; in each bucket of a
signature first the smallest class is compared with the others, then each class that is not yet in the bucket's main
component with its likeliest partner elsewhere, and at last all pairs whose ends are still in different components and
whose parity sketches allow a link. Comparisons are exact, on the whole sets.

Words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z. With fewer than five words the whole sequence is the only shingle.
Null, empty and blank texts have no set and link with nothing. Ties go to the smallest doc_id. Rows without a doc_id get
their set's size and a null component. Rows that repeat a doc_id each get a row; different texts under one id are
separate texts, whose components may meet in that number.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
LINK = Fraction(4, 5)
SKETCH_BITS = 2048
#: Bytes of signatures in a partition, documents whose signatures are sent together, and members compared with one leader in a task.
PART_BYTES, SEND_ROWS, MEMBERS = 16 << 20, 2048, 256
#: Bytes of a part that a task takes at a time; bytes of text for each word, to size parts.
CHUNK_BYTES, WORD_BYTES = 64 << 20, 6
#: Members of a bucket, and members outside its largest component, that are compared in one group.
UNIT, OUTSIDE = 4096, 512
#: Shuffle partitions at most; each serves several parts beyond.
MOST_PARTITIONS = 20_000
#: What a false candidate costs, in signatures.
CANDIDATE_COST = 50.0
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    return x ^ (x >> np.uint64(29))


class Shingler:
    def __init__(self):
        self.memo = common.Memo(xxhash.xxh64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the text's shingles."""
        words = (text or "").encode().translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        n = min(SHINGLE, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for k in range(n):
            h = _mix(h * _M2 + w[k : len(w) - n + 1 + k])
        return np.unique(h)


def shingler() -> Shingler:
    return common.resident("shingler", Shingler)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set's content, as two signed numbers."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist())


def sketch(s: np.ndarray) -> bytes:
    """Parity of the number of hashes in each of SKETCH_BITS cells: sketches differ in no more bits than sets in hashes."""
    return np.packbits((np.bincount((s >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def max_difference(total: int) -> int:
    """Most shingles that two linked sets with so many shingles together can differ in."""
    j = LINK
    return total - 2 * math.ceil(Fraction(total) * j / (1 + j))


@cache
def bands(upto: int) -> tuple[list[int], list[int]]:
    """Least and greatest sizes of the bands that cover 1 .. upto."""
    low, high = [], []
    at = 1
    while at <= upto:
        low.append(at)
        high.append(math.floor(at / LINK))
        at = high[-1] + 1
    return low, high


@cache
def band_of(size: int) -> int:
    low, high = bands(1 << (size.bit_length() + 1))
    return next(i for i, h in enumerate(high) if size <= h)


@cache
def layout(band: int) -> tuple[int, bool]:
    """Number of segments for pairs whose larger set is in the band; whether with one-deletion neighbourhoods."""
    low, high = bands(1 << 40)
    k, n = max_difference(2 * high[band]), low[band]
    exact, deleting = k + 1 + max(1, (k + 1) // 4), (k + 2) // 2
    cost_exact = (k + 1) * (1 + CANDIDATE_COST * math.exp(-n / exact))
    cost_deleting = (n + deleting) * (1 + CANDIDATE_COST * math.exp(-n / deleting))
    return (deleting, True) if cost_deleting < cost_exact else (exact, False)


@cache
def roles(size: int) -> list[tuple[int, int]]:
    """(band, k): the bands in which a set of this size takes part, and the most that it can differ there."""
    own = band_of(size)
    low, high = bands(1 << 40)
    least = math.ceil(size * LINK)
    out = []
    for band in (own, own + 1):
        a, b = (least if band == own else low[band]), min(high[band], math.floor(size / LINK))
        if a <= b:
            k = max(max_difference(size + t) for t in {a, b, max(a, b - 1), max(a, b - 2)})
            if k > 0:
                out.append((band, k))
    return out


def signatures(s: np.ndarray) -> np.ndarray:
    """Signatures of a set: any two linked, different sets share one."""
    out = []
    for band, k in roles(len(s)):
        m, deleting = layout(band)
        salt = np.uint64((band * 2 + deleting + 1) * int(_M2) % (1 << 64))
        hashed = _mix(s + salt)
        segment = (hashed % np.uint64(m)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        hashed, segment = _mix(hashed ^ _M1)[order], segment[order]
        count = np.bincount(segment, minlength=m)
        begin = np.concatenate([[0], np.cumsum(count)])
        total = np.concatenate([[np.uint64(0)], np.cumsum(hashed, dtype=np.uint64)])
        content = total[begin[1:]] - total[begin[:-1]]  # wraps: a sum modulo 2**64
        mark = salt + np.arange(m, dtype=np.uint64)
        if deleting:
            out += [_mix(content * _M1 + mark), _mix((content[segment] - hashed) * _M1 + mark[segment])]
        else:
            own = _mix(content * _M1 + mark)
            if m > k + 1:  # the cheapest: most shingles, then by the signature itself
                rank = (np.uint64(255) - np.minimum(count, 255).astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
                own = own[np.argpartition(rank, k)[: k + 1]]
            out.append(own)
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * LINK.denominator >= LINK.numerator * (len(a) + len(b) - both)


#: A row of a document (its set's size, 128-bit key, band and sketch) or, where part isn't null, signatures on their way.
SET = "doc_id long, text_hash long, n_shingles long, key long, key2 long, band int, sketch binary"
PASS = f"{SET}, part int, payload binary"
NAMES = [c.split()[0] for c in PASS.split(", ")]
#: Bits of a signature that travel, beside its part: a false match in a part of a million costs a comparison, no link.
SENT_BITS = 40


def one_pass(docs: DataFrame, parts: int) -> DataFrame:
    """Shingles each text once: a row for each document, and payloads of signatures and keys packed by the part that they go to.

    Equal sets of a task send their signatures once.
    """
    rows = common.id_text(docs).withColumn("text_hash", F.xxhash64("text"))

    def start():
        make, seen = shingler(), set()

        def step(b: pa.RecordBatch):
            size, k1, k2, band, sketches, sigs, sent = [], [], [], [], [], [], []
            for t in b.column(1).to_pylist():
                s = make(t)
                size.append(len(s))
                if not len(s):
                    for c in (k1, k2, band, sketches):
                        c.append(None)
                    continue
                key = set_key(s)
                k1.append(key[0])
                k2.append(key[1])
                band.append(band_of(len(s)))
                sketches.append(sketch(s))
                if key in seen:
                    continue
                if len(seen) < 500_000:  # beyond, equal sets go again, which changes nothing
                    seen.add(key)
                own = signatures(s)
                sigs.append(own)
                sent.append(np.full(len(own), key[0], np.int64))
            n = len(size)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(size, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(band, pa.int32()), pa.array(sketches, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                NAMES,
            )
            if sigs:
                got, payload = dealt(np.concatenate(sigs), np.concatenate(sent), parts)
                n = len(got)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(n, k) for k in (pa.int64(),) * 5), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(got, pa.int32()), pa.array(payload, pa.binary())], NAMES)

        return step

    return common.map_rows(rows, PASS, start, SEND_ROWS)


def dealt(sig: np.ndarray, key: np.ndarray, parts: int) -> tuple[list[int], list[bytes]]:
    """The parts that signatures go to, and for each what unpacked() reads: SENT_BITS of its signatures, then their keys."""
    part = (sig % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    rest, key = (sig // np.uint64(parts))[order], key[order]
    low, high = rest.astype(np.uint32), (rest >> np.uint64(32)).astype(np.uint8)
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    got = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
    return got, [b"".join(x[cut[p] : cut[p + 1]].tobytes() for x in (low, high, key)) for p in got]


def unpacked(payload: bytes, part: int, parts: int) -> bytes:
    """(signature, key) pairs of a payload; equal signatures get equal numbers, those of different parts never do."""
    n = len(payload) // (SENT_BITS // 8 + 8)
    low, high, key = np.frombuffer(payload, np.uint32, n), np.frombuffer(payload, np.uint8, n, 4 * n), np.frombuffer(payload[5 * n :], np.int64)
    return np.stack([(low + (high.astype(np.int64) << 32)) * parts + part, key], 1).tobytes()


def classes_of(sets: DataFrame, store: common.Durable) -> tuple[DataFrame, DataFrame]:
    """The classes of equal sets: v, key, key2, rep (a smallest doc_id), n_shingles, band, sketch; and those of them that share `key` with another.

    Payloads name a class by `key` alone, so v is `key` but for the second and further sets of one key, which get a
    number of their own; their signatures are sent once more under it.
    """
    every = sets.where("key is not null and doc_id is not null").groupBy("key", "key2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("band").alias("band"), F.first("sketch").alias("sketch"))
    every = store.put(every)
    shared = every.groupBy("key").agg(F.count("*").alias("n"), F.min("key2").alias("first2")).where("n > 1").select("key", "first2")
    shared = store.put(shared)
    if shared.isEmpty():
        return every.withColumn("v", F.col("key")), every.limit(0).withColumn("v", F.col("key"))
    named = every.join(shared, "key", "left").withColumn("v", F.when(F.col("key2") > F.col("first2"), F.xxhash64("key", "key2")).otherwise(F.col("key")))
    named = store.put(named)
    return named.drop("first2"), named.where("v <> key").drop("first2")


def sent_again(docs: DataFrame, later: DataFrame, parts: int) -> DataFrame:
    """All payloads once more, and those of the classes that share another's key under their own v."""
    rows = common.id_text(docs).join(later.select(F.col("rep").alias("doc_id"), "v", "key", "key2"), "doc_id").select("v", "key", "key2", "text")

    def start():
        make = shingler()

        def step(b: pa.RecordBatch):
            sigs, sent = [], []
            for v, k1, k2, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = make(t)
                if set_key(s) == (k1, k2):
                    sigs.append(signatures(s))
                    sent.append(np.full(len(sigs[-1]), v, np.int64))
            if sigs:
                got, payload = dealt(np.concatenate(sigs), np.concatenate(sent), parts)
                yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(payload, pa.binary())], ["part", "payload"])

        return step

    again = common.map_rows(rows, "part int, payload binary", start, SEND_ROWS)
    return one_pass(docs, parts).where("part is not null").unionByName(again, allowMissingColumns=True)


class Buckets:
    """The buckets of one part, taken in as many chunks as it has. Between chunks only each signature's smallest key is kept."""

    def __init__(self):
        self.carried = np.empty((0, 2), np.int64)
        self.chunks = 0

    def add(self, payloads: list[bytes], last: bool) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Distinct (smallest, other) pairs, and the distinct buckets of three keys or more, each with a number.

        A bucket that comes in one chunk is numbered by its members, so equal buckets are one; where a part has several
        chunks, pieces of a bucket have the signature as their number, however small they are.
        """
        whole = last and not self.chunks
        self.chunks += 1
        both = np.concatenate([self.carried, np.frombuffer(b"".join(payloads), np.int64).reshape(-1, 2)])
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        new_sig = np.concatenate([[True], both[1:, 0] != both[:-1, 0]])
        fresh = new_sig | np.concatenate([[True], both[1:, 1] != both[:-1, 1]])
        sig, key, head = both[fresh, 0], both[fresh, 1], new_sig[fresh]
        at = np.flatnonzero(head)
        if not last:
            self.carried = np.stack([sig[at], key[at]], 1)
        size = np.diff(np.append(at, len(key)))
        pick = np.repeat(size > 1, size) & ~head
        pairs = np.unique(np.stack([np.repeat(key[at], size)[pick], key[pick]], 1), axis=0) if pick.any() else np.empty((0, 2), np.int64)
        known, lists = set(), []
        for i in np.flatnonzero(size > (2 if whole else 1)):
            members = key[at[i] : at[i] + size[i]]
            mark = xxhash.xxh3_64_intdigest(members.tobytes()) if whole else (int(sig[at[i]]) & 0xFFFFFFFFFFFFFFFF)
            if mark not in known:
                known.add(mark)
                lists.append((mark - (1 << 64) if mark >> 63 else mark, members))
        return pairs, lists


def candidates(sent: DataFrame, parts: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """a, b (a the smallest of a bucket, b another) or bucket, members (of a bucket of three or more), each once a part; or a document's row, as it came.

    A task takes its parts one after the other and each in chunks of chunk_bytes, so its memory follows neither their
    number nor the size of a bucket. Documents' rows come along so that the signatures need no table: those are most of
    what a run has on disk.
    """
    out = f"a long, b long, bucket long, members array<long>, {SET}"
    names, kinds = [c.split()[0] for c in out.split(", ")], [pa.int64()] * 3 + [pa.list_(pa.int64())] + [pa.int64()] * 5 + [pa.int32(), pa.binary()]

    def rows_of(n: int, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names)

    def run(batches):
        part, held, size, own = None, [], 0, Buckets()

        def flush(last: bool):
            pairs, lists = own.add(held, last)
            held.clear()
            for i in range(0, len(pairs), 50_000):
                p = pairs[i : i + 50_000]
                yield rows_of(len(p), a=p[:, 0], b=p[:, 1])
            cut = [(mark, m[k : k + 100_000]) for mark, m in lists for k in range(0, len(m), 100_000)]
            for i in range(0, len(cut), 2_000):
                p = cut[i : i + 2_000]
                yield rows_of(len(p), bucket=[k for k, _ in p], members=[m.tolist() for _, m in p])

        for batch in batches:
            of_document = batch.filter(pc.is_null(batch.column("part")))
            if of_document.num_rows:
                yield rows_of(of_document.num_rows, **{c: of_document.column(c) for c in names[4:]})
            batch = batch.filter(pc.is_valid(batch.column("part")))
            for p, packed in zip(batch.column("part").to_pylist(), batch.column("payload"), strict=True):
                x = unpacked(packed.as_py(), p, parts)
                if part is not None and p != part:
                    yield from flush(True)
                    own, size = Buckets(), 0
                elif size >= chunk_bytes:
                    yield from flush(False)
                    size = 0
                part = p
                held.append(x)
                size += len(x)
        if part is not None:
            yield from flush(True)

    # documents' rows of no part are spread by what they hold
    deal = F.coalesce(F.col("part").cast("long"), F.xxhash64("doc_id", "text_hash"))
    dealt_out = sent.repartition(min(parts, MOST_PARTITIONS), deal).sortWithinPartitions("part")
    return dealt_out.mapInArrow(common.releasing(run), out)


def verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, store: common.Durable) -> DataFrame:
    """Those of the pairs (a, b of classes' v) whose sets link, by comparing the whole sets.

    Members travel to their leader as texts, at most about MEMBERS to one task's leader at a time.
    """
    own = common.Durable(docs.sparkSession, "jaccard-texts")
    needed = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))).distinct()
    most = pairs.count()
    needed = own.put(needed.join(reps.select("v", "key", "key2", "rep"), "v"), rows=2 * most)
    few = needed.count() <= 500_000  # at most 16 MB of numbers; a shuffle join beyond
    texts = common.id_text(docs).withColumnRenamed("doc_id", "rep").join(F.broadcast(needed) if few else needed, "rep")
    texts = own.put(texts.select("v", F.struct("key", "key2", "text").alias("own")))
    # only leaders of many pairs; a table of its own, so that the join's two sides are shuffled and a hot leader can be split
    salts = own.put(pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("salts")).where("salts > 1"), rows=most // MEMBERS + 1)
    dealt = own.put(pairs.join(salts, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")), rows=most)
    leaders = dealt.select("a", "salt").distinct().join(texts, F.col("a") == F.col("v")).select("a", "salt", F.lit(0).alias("member"), F.col("a").alias("b"), "own.*")
    members = dealt.join(texts, F.col("b") == F.col("v")).select("a", "salt", F.lit(1).alias("member"), "b", "own.*")
    rows = leaders.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "member")

    def run(batches):
        make, leader, of = shingler(), None, None
        for batch in batches:
            a, b = [], []
            for ka, salt, member, kb, k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shingles = make(text)
                if set_key(shingles) != (k1, k2):  # another text under the same doc_id
                    continue
                if not member:
                    leader, of = shingles, (ka, salt)
                elif of == (ka, salt) and linked(leader, shingles):
                    a.append(ka)
                    b.append(kb)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    out = store.put(rows.mapInArrow(common.releasing(run), "a long, b long").distinct(), rows=most)
    own.keep()
    return out


def components(edges: DataFrame, store: common.Durable) -> DataFrame:
    """v, label (the smallest vertex that edges lead to).

    Each round gives a vertex its smallest neighbour, jumps on from there, and contracts the edges to what is left
    between different ones; so a hub's edges are gone after the round in which it is met. The rounds' steps are then
    followed one after the other.
    """
    rest = store.put(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), rows=edges.count())
    steps, vertices = [], 0
    while n := rest.count():
        near = rest.select(F.col("a").alias("v"), F.col("a").alias("p")).union(rest.select(F.col("b").alias("v"), F.col("a").alias("p")))
        near = store.put(near.groupBy("v").agg(F.min("p").alias("p")), rows=2 * n)
        jump = near.select(F.col("v").alias("at"), F.col("p").alias("hop"))
        step = store.put(near.join(jump, near["p"] == jump["at"], "left").select("v", F.coalesce("hop", "p").alias("p")), rows=2 * n)
        steps.append(step)
        vertices = vertices or step.count()
        for end in ("a", "b"):
            rest = rest.join(step.select(F.col("v").alias(end), F.col("p").alias(f"_{end}")), end).drop(end).withColumnRenamed(f"_{end}", end)
        rest = store.put(rest.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), rows=n)
    if not steps:
        return edges.select(F.col("a").alias("v"), F.col("a").alias("label")).limit(0)
    label = steps[0].select("v", F.col("p").alias("label"))
    for step in steps[1:]:
        label = label.join(step.select(F.col("v").alias("label"), "p"), "label", "left").select("v", F.coalesce("p", "label").alias("label"))
    return store.put(label, rows=vertices)


def remaining(members: DataFrame, n_members: int, label: DataFrame, reps: DataFrame, store: common.Durable, nearest: bool) -> DataFrame | None:
    """bucket, a, b: a bucket's classes in different components whose sizes and sketches allow a link, or None if no bucket has such classes.

    members: bucket, v, live. nearest: only the likeliest partner of each class a that is asked for. It can't find every
    link, but after it few components are left, and so few pairs for the full pass.

    A pair across components has an end outside any one component, so members outside the most frequent one meet all:
    they are asked for where live is null. Later it says which had a partner at all the time before. Components only
    merge, so of any pair that is left one end had one: these are asked for then, in their buckets alone.
    Buckets of more than UNIT members are split by size band (linked sets are in the same or neighbouring ones), and in
    blocks of UNIT members and OUTSIDE of those outside; each pair of blocks is a group of its own.
    """
    rows = members.join(label, "v", "left").withColumn("label", F.coalesce("label", "v"))
    rows = store.put(rows, rows=n_members)
    open_ = rows.groupBy("bucket", "label").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.sum("n").alias("size"), F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("main")).where("labels > 1")
    open_ = store.put(open_.select("bucket", "size", "main"), rows=n_members)
    largest = open_.agg(F.max("size")).first()[0]
    if largest is None:
        return None
    rows = rows.join(open_, "bucket").join(reps.select("v", "n_shingles", "band", "sketch"), "v").withColumn("minor", F.coalesce("live", F.col("label") != F.col("main")))
    whole = rows.where(F.col("size") <= UNIT).withColumns({"sub": F.lit(0), "i": F.lit(0), "j": F.lit(0), "as_minor": F.col("minor"), "as_other": F.lit(True)})
    columns = ["bucket", "sub", "i", "j", "as_minor", "as_other", "v", "label", "n_shingles", "sketch"]
    units = whole.select(*columns)
    if largest > UNIT:
        hot = store.put(rows.where(F.col("size") > UNIT))
        near = hot.where("minor").withColumn("sub", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
        others = hot.withColumn("sub", F.col("band"))
        blocks = near.groupBy("bucket", "sub").agg(F.ceil(F.count("*") / OUTSIDE).cast("int").alias("ni")).join(others.groupBy("bucket", "sub").agg(F.ceil(F.count("*") / UNIT).cast("int").alias("nj")), ["bucket", "sub"])
        blocks = store.put(blocks)
        near = near.join(blocks, ["bucket", "sub"]).withColumns({"i": F.pmod(F.xxhash64("v"), F.col("ni")).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("nj") - 1)), "as_minor": F.lit(True), "as_other": F.lit(False)})
        others = others.join(blocks, ["bucket", "sub"]).withColumns({"j": F.pmod(F.xxhash64("v"), F.col("nj")).cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("ni") - 1)), "as_minor": F.lit(False), "as_other": F.lit(True)})
        units = units.unionByName(near.select(*columns)).unionByName(others.select(*columns))
    units = units.repartition("bucket", "sub", "i", "j").sortWithinPartitions("bucket", "sub", "i", "j")
    num, den = LINK.numerator, LINK.denominator

    def pairs_of(unit: list[list]):
        """Batches of (bucket, a of the members outside, b, bits apart)."""
        minor, other = (np.flatnonzero(np.array(x, bool)) for x in unit[4:6])
        key, lab, n = (np.array(x, np.int64) for x in unit[6:9])
        bits = np.frombuffer(b"".join(unit[9]), np.uint64).reshape(len(key), -1)
        for i in range(0, len(minor), 256):
            own = minor[i : i + 256]
            ok = (lab[own, None] != lab[None, other]) & (den * np.minimum(n[own, None], n[None, other]) >= num * np.maximum(n[own, None], n[None, other]))
            x, y = np.nonzero(ok)
            y = other[y]
            got = []
            for k in range(0, len(x), 1 << 16):
                xs, ys = x[k : k + (1 << 16)], y[k : k + (1 << 16)]
                apart = np.bitwise_count(bits[own[xs]] ^ bits[ys]).sum(1, dtype=np.int64)
                near = (num + den) * apart <= (den - num) * (n[own[xs]] + n[ys])
                got.append(np.stack([key[own[xs[near]]], key[ys[near]], apart[near]], 1))
            found = np.concatenate(got) if got else np.empty((0, 3), np.int64)
            if nearest and len(found):
                found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
                found = found[np.concatenate([[True], found[1:, 0] != found[:-1, 0]])]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), unit[0][0], np.int64)), *(pa.array(found[:, k]) for k in range(3))], ["bucket", "a", "b", "apart"])

    def run(batches):
        held: list[list] = [[] for _ in columns]
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] and tuple(c[0] for c in held[:4]) != row[:4]:
                    yield from pairs_of(held)
                    for c in held:
                        c.clear()
                for c, v in zip(held, row, strict=True):
                    c.append(v)
        if held[0]:
            yield from pairs_of(held)

    found = units.mapInArrow(common.releasing(run), "bucket long, a long, b long, apart long")
    if nearest and largest > UNIT:
        found = found.groupBy("bucket", "a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
    return found.select("bucket", "a", "b")


def still_open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets in which something was found; live says of which."""
    live = found.select("bucket", F.col("a").alias("v")).distinct().withColumn("live", F.lit(True))
    rows = members.drop("live").join(found.select("bucket").distinct(), "bucket", "left_semi").join(live, ["bucket", "v"], "left")
    return rows.select("bucket", "v", F.coalesce("live", F.lit(False)).alias("live"))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of each row."""
    spark = docs.sparkSession
    store = common.Durable(spark, "jaccard")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / WORD_BYTES * 0.55 * 16 / PART_BYTES))
    found = passed = store.put(candidates(one_pass(docs, parts), parts))
    sets = passed.where("n_shingles is not null").select(*NAMES[:7])
    reps, later = classes_of(sets, store)
    if not later.isEmpty():
        found = store.put(candidates(sent_again(docs, later, parts), parts))
    found = found.where("n_shingles is null").select("a", "b", "bucket", "members")
    pairs = store.put(found.where("a is not null").select("a", "b").distinct(), rows=found.count())
    edges = verified(docs, reps, pairs, store)
    label = components(edges, store)
    members = store.put(found.where("members is not null").select("bucket", F.explode("members").alias("v"), F.lit(None).cast("boolean").alias("live")).distinct())
    n_members = members.count()
    for nearest in (True, True, False):
        left = remaining(members, n_members, label, reps, store, nearest)
        if left is None:
            break
        if nearest:
            left = store.put(left)
            members = store.put(still_open(members, left), rows=n_members)
            n_members = members.count()
        rest = left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        rest = store.put(rest.join(pairs, ["a", "b"], "left_anti"))
        if rest.isEmpty():
            continue
        more = verified(docs, reps, rest, store)
        pairs = store.put(pairs.unionByName(rest))
        if not more.isEmpty():
            edges = edges.unionByName(more)
            label = components(edges, store)
    named = label.join(reps.select("v", "rep"), "v")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    classes = reps.select("v", "key", "key2", "rep").join(named.select("v", "label").join(smallest, "label").select("v", "component_id"), "v", "left")
    classes = store.put(classes.select("key", "key2", F.coalesce("component_id", "rep").alias("component_id")))
    store.keep(passed, classes)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return sets.join(classes, ["key", "key2"], "left").select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))


def link_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links lead to; one row for each row of docs."""
    return joined(docs).drop("text_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component the document with the smallest doc_id, all columns. Rows without an id stay.

    Rows that repeat both id and text count once (which of them, if other columns differ, is left open); of different
    texts under one id each is judged by its own component. Only rows with such a repeated id and text are shuffled.
    """
    store = common.Durable(docs.sparkSession, "jaccard-kept")
    judged = store.put(joined(docs).where("doc_id is not null").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg((F.max("component_id") < F.col("_id")).alias("_gone"), (F.count("*") > 1).alias("_again")))

    def of(df: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return df.join(some, (df["doc_id"].cast("long") == some["_id"]) & (F.xxhash64(df["text"].cast("string")) == some["_hash"]), how)

    kept = of(docs, judged.where("_gone").select("_id", "_hash"), "left_anti")
    again = store.put(judged.where("_again and not _gone").select("_id", "_hash"))
    if again.isEmpty():
        return kept
    return of(kept, again, "left_anti").unionByName(of(kept, again, "left_semi").dropDuplicates(["doc_id", "text"]))
