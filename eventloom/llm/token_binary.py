"""Token ids as binary files: an adaptive context-mixing range coder in independent, checksummed blocks.

A frame's ids are numbered by falling frequency first, and these numbers are what is coded; its row has the id of each.
Ids are coded in blocks of BLOCK ids; each block starts from the same state, so any block can be read alone, and carries
the crc32 of its ids. Three orders predict each id: order 2 and order 1 the id that last followed their context, order 0
every id by the adaptive counts of its upper byte and, within a class of those, its lower byte. They are mixed: an id's
probability is the sum over the orders of the order's weight times its prediction. The weights adapt, for each pair of
the confidences that orders 2 and 1 have earned in their contexts. A range coder with carries writes the bytes. All
blocks at hand are coded in lockstep, one id of each at a time, so the arithmetic runs on whole arrays, of whole numbers
only (two divisions of the decoder go through doubles, exactly); encoder and decoder run the same in the same order.

A file row ("frame") holds whole documents in ascending doc_id order: their ids and lengths, the blocks' bytes and
checksums. Rows are stored as Parquet, written and read by Spark alone. Ids must be under 65,535. Null texts count as
empty and still get the end id; repeated rows are all written; a damaged block raises ValueError.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BLOCK = 2048
#: Ids in a frame at least (but for the last), blocks in lockstep (1.5 times as many at most), and pieces that a worker remembers.
FRAME_IDS, LANES, REMEMBER = 1 << 18, 6144, 800_000
#: Bytes of text in a range of documents, and of texts whose words are looked up together.
RANGE_BYTES, SLICE_BYTES = 32 << 20, 32 << 20
#: Contexts of an order in a block; bits of the mix of orders, and of each byte of order 0.
SLOTS, MIX, BITS = 256, 12, 14
_MASK, _TOTAL, _ONE, _WEIGHT = SLOTS - 1, MIX + 2 * BITS, 1 << BITS, 1 << 15
_WORD, _TOP, _LOW, _SHIFT, _LAST = np.uint64(16), np.uint64(48), np.uint64(1 << 48), np.uint64(_TOTAL), np.uint64((1 << _TOTAL) - 1)
#: Classes of upper bytes with lower-byte counts of their own, what an id adds to a count, and ids after which the tables of order 0 are made anew.
CLASSES, GAIN, RENEW = 4, 24, {8, 16, 32, 64, 128, 256, 512, 1024}
_CLASS = np.array([0, 1] + [2] * 6 + [3] * 248)
_NONE = 1 << 18  # no id yet, as id * 4 + confidence
#: How the tokenizer file cuts texts, where WordTokenizer cuts words into pieces itself; with another file it leaves that to the library.
KNOWN_CUTS = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    None,
]


class Coder:
    """The state of n blocks in lockstep. The first `live` blocks take part in a step; they are sorted by length.

    ids: a row for each step; read, or filled from data. An id takes one part of 2 ** 40: the mix of the orders has 12 bits
    of these, and within order 0 either byte has 14. Cumulated counts of a byte don't depend on how many upper bytes the
    tables hold, so blocks with few and many can go in lockstep.
    """

    def __init__(self, ids: np.ndarray, upper: int, data: list[bytes] | None = None):
        n = ids.shape[1]
        self.ids, self.range, self.lane = ids, np.full(n, (1 << 64) - 1, np.uint64), np.arange(n)
        if data is None:
            self.size = BLOCK * 3 + 8
            self.low, self.out, self.code, self.pos = np.zeros(n, np.uint64), np.zeros(n * self.size, np.uint16), None, self.lane * self.size
        else:
            self.size = max(map(len, data)) // 2 + 8
            self.out = np.frombuffer(b"".join(d.ljust(2 * self.size, b"\0") for d in data), ">u2").astype(np.uint16)
            self.pos = self.lane * self.size
            self.code = sum(self.out[self.pos + k].astype(np.uint64) << np.uint64(48 - 16 * k) for k in range(4))
            self.pos += 4
            self.end = (self.lane + 1) * self.size - 1
        # tables go by context or byte first and by block then: neighbours in memory are read together. Order 1 comes before order 2
        self.follow, self.weight = np.full(2 * n * SLOTS, _NONE, np.int32), np.full(2 * n * 32, _WEIGHT // 4, np.int32)
        self.at_follow, self.at_weight = (self.lane + np.array([[0], [k * n]]) for k in (SLOTS, 32))
        self.bits = max(1, upper.bit_length())
        self.upper, self.lower = np.zeros(((1 << self.bits) + 1, n), np.uint16), np.zeros((CLASSES, 257, n), np.uint16)
        self.n, self.at_class = n, _CLASS * 257 * n
        self.prev1, self.prev2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self._renew(0, n)

    def _renew(self, t: int, live: int) -> None:
        """Order 0 from the t ids coded so far: cumulated counts, scaled so that each byte has a part of its own."""
        width = 1 << self.bits
        for a in range(0, live, 64):
            b = min(live, a + 64)
            ids = self.ids[:t, a:b].astype(np.int64)
            lane, up = self.lane[: b - a], ids >> 8
            count = np.bincount((up * (b - a) + lane).ravel(), minlength=width * (b - a)).reshape(width, -1)
            total = np.cumsum(count.astype(np.int32) * GAIN + 1, axis=0, dtype=np.int32)
            self.upper[1:, a:b] = (total * (((_ONE - 256) << 16) // (256 + GAIN * t)) >> 16) + np.arange(1, width + 1, dtype=np.int32)[:, None]
            count = np.bincount(((_CLASS.take(up) * 256 + (ids & 255)) * (b - a) + lane).ravel(), minlength=CLASSES * 256 * (b - a)).reshape(CLASSES, 256, -1)
            total = np.cumsum(count.astype(np.int32) * GAIN + 1, axis=1, dtype=np.int32)
            self.lower[:, 1:, a:b] = (total * (((_ONE - 256) << 16) // total[:, -1:]) >> 16) + np.arange(1, 257, dtype=np.int32)[:, None]

    def _byte(self, cum: np.ndarray, base: np.ndarray, bits: int, value: np.ndarray) -> np.ndarray:
        """Where the part that has each value begins, in rows of cumulated counts."""
        value, place = value.astype(np.uint16), base
        for k in range(bits - 1, -1, -1):
            place = place + (cum.take(place + (self.n << k)) <= value) * (self.n << k)
        return place

    def _narrow(self, live: int, r: np.ndarray, cum: np.ndarray, freq: np.ndarray) -> None:
        """Takes the part [cum, cum + freq) of 2 ** _TOTAL for each block, and moves words out or in."""
        skip, rng = r * cum.view(np.uint64), r * freq.view(np.uint64)
        few = np.flatnonzero(rng < _LOW)
        if self.code is None:
            low = self.low[:live] + skip
            over = np.flatnonzero(low < skip)
            if len(over):
                self._carry(over)
        else:
            code = self.code[:live] - skip
        while len(few):
            pos = self.pos.take(few)
            if self.code is None:
                x = low.take(few)
                self.out[pos] = x >> _TOP
                low[few] = x << _WORD
            else:
                code[few] = (code.take(few) << _WORD) | self.out.take(np.minimum(pos, self.end.take(few)))
            self.pos[few] = pos + 1
            x = rng.take(few) << _WORD
            rng[few] = x
            few = few[x < _LOW]
        self.range[:live] = rng
        if self.code is None:
            self.low[:live] = low
        else:
            self.code[:live] = code

    def _carry(self, lane: np.ndarray) -> None:
        pos = self.pos.take(lane) - 1
        while len(pos):
            x = self.out.take(pos) + np.uint16(1)
            self.out[pos] = x
            pos = pos[x == 0] - 1

    def finish(self) -> list[bytes]:
        """The bytes of all blocks: one more word says which value in the last range is meant, zeros follow."""
        low = self.low + (_LOW - np.uint64(1))
        self._carry(np.flatnonzero(low < self.low))
        self.out[self.pos] = low >> _TOP
        return [self.out[a : b + 1].astype(">u2").tobytes() for a, b in zip((self.lane * self.size).tolist(), self.pos.tolist(), strict=True)]

    def step(self, t: int, live: int) -> None:
        """Codes (or reads) the ids of row t for the first `live` blocks."""
        if t in RENEW:
            self._renew(t, live)
        p1, p2, lane = self.prev1[:live], self.prev2[:live], self.lane[:live]
        at = self.at_follow[:, :live] + (np.stack([p1, p1 * 37 ^ p2]) & _MASK) * self.n
        e = self.follow.take(at)
        sure = e & 3
        same = (e[0] ^ e[1]) < 4  # both orders say one id: their weights add up
        x = self.at_weight[:, :live] + (sure[1] * 8 + sure[0] * 2 + same) * np.int64(self.n)
        w = self.weight.take(x)
        share = (w * 127 >> 22 - MIX) + 8
        a, b = share[1].astype(np.int64), share[1] + share[0].astype(np.int64)
        r = self.range[:live] >> _SHIFT
        rest = (1 << MIX) - b
        if self.code is None:
            got = self.ids[t, :live].astype(np.int64)
            up = got >> 8
            place = up * self.n + lane
            place0 = self.at_class.take(up) + (got & 255) * self.n + lane
            cum1 = self.upper.take(place).astype(np.int64)
            cum0 = self.lower.take(place0).astype(np.int64)
        else:
            v = np.minimum(self.code[:live] // r, _LAST).view(np.int64)
            by = v >> 2 * BITS
            by2, by1 = by < a, by < b
            v = (np.maximum(v - (b << 2 * BITS), 0) / rest).astype(np.int64)  # exact: under 2 ** 53
            place = self._byte(self.upper, lane, self.bits, v >> BITS)
            up = place // self.n
            cum1 = self.upper.take(place).astype(np.int64)
        freq1 = self.upper.take(place + self.n) - cum1
        if self.code is not None:
            base = self.at_class.take(up) + lane
            place0 = self._byte(self.lower, base, 8, (v - (cum1 << BITS)) / freq1)
            cum0 = self.lower.take(place0).astype(np.int64)
            got = np.where(by2, e[1] >> 2, np.where(by1, e[0] >> 2, up * 256 + (place0 - base) // self.n))
        freq0 = self.lower.take(place0 + self.n) - cum0
        new = (got << 2).astype(np.int32)
        d = e ^ new  # the confidence, where the order was right
        right = d < 4
        if self.code is None:
            by2, by1 = right[1], right[0]
        one, two = a << 2 * BITS, b << 2 * BITS
        cum = np.where(by2, 0, np.where(by1, one, two + rest * ((cum1 << BITS) + freq1 * cum0)))
        freq = np.where(by2, one, np.where(by1, two - one, rest * (freq1 * freq0)))
        self._narrow(live, r, cum, freq)
        # what was learned
        self.weight[x] = w + (right * (_WEIGHT >> (right[0] & right[1]).astype(np.int32)) - w >> 5)
        self.follow[at] = new + np.minimum(d + 1, 3) * right
        self.prev2[:live] = p1
        self.prev1[:live] = got
        if self.code is not None:
            self.ids[t, :live] = got


def _steps(coder: Coder, size: np.ndarray) -> None:
    live = np.searchsorted(-size, -np.arange(size[0]), side="left").tolist()
    for t, n in enumerate(live):
        coder.step(t, n)


def _groups(blocks: list) -> Iterator[list]:
    """Blocks in groups of about LANES, all of one size: a step takes little longer for many blocks than for few."""
    each = max(1, -(-len(blocks) // max(1, round(len(blocks) / LANES))))
    for k in range(0, len(blocks), each):
        yield blocks[k : k + each]


def _turned(ids: np.ndarray) -> np.ndarray:
    """The transposed array, by parts that fit a cache."""
    out = np.empty(ids.shape[::-1], ids.dtype)
    for a in range(0, len(ids), 64):
        for b in range(0, ids.shape[1], 64):
            out[b : b + 64, a : a + 64] = ids[a : a + 64, b : b + 64].T
    return out


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The bytes of each block of at most BLOCK ids; longer ones must come first. The first byte is the largest upper byte."""
    out: list[bytes] = []
    for part in _groups(blocks):
        size = np.array([len(b) for b in part])
        ids = np.zeros((len(part), int(size[0])), np.uint16)
        for j, b in enumerate(part):
            ids[j, : len(b)] = b
        upper = ids.max(axis=1) >> 8
        coder = Coder(_turned(ids), int(upper.max()))
        _steps(coder, size)
        out += [bytes([u]) + b for u, b in zip(upper.tolist(), coder.finish(), strict=True)]
    return out


def decode_blocks(data: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    order = sorted(range(len(data)), key=lambda i: -sizes[i])
    out: list = [None] * len(data)
    for part in _groups(order):
        size = np.array([sizes[i] for i in part])
        coder = Coder(np.zeros((int(size[0]), len(part)), np.uint16), max(data[i][0] for i in part), [data[i][1:] for i in part])
        _steps(coder, size)
        ids = _turned(coder.ids)
        for j, i in enumerate(part):
            out[i] = ids[j, : sizes[i]]
    return out


class WordTokenizer:
    """The library's ids of texts, by their words: a blank always ends a piece, so a word's ids hold wherever it stands.

    Words of ASCII and of Latin letters to U+00FF are cut into pieces as the tokenizer file says, and the pieces that are new
    go to the library's model; other words, and those that may hold a special token, go to the library whole.
    """

    PLAIN = "^[!-~À-ÖØ-öø-ÿ]*$"
    PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\\[-`{-~]+")
    GAP = 0xFFFF  # stands for the end of a word

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        vocab, spec = self.tok.get_vocab(), json.loads(self.tok.to_str())
        if max(vocab.values()) >= self.GAP:
            raise ValueError("ids must be under 65,535")
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.last = np.zeros(1 << 16, bool)  # ids that end a piece
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.known_cuts = [spec[k] for k in ("normalizer", "pre_tokenizer", "post_processor")] == KNOWN_CUTS and spec["model"]["end_of_word_suffix"] == "</w>" and all(t["content"].startswith("<|") for t in spec["added_tokens"])
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        flat = self.PIECES.findall("\n".join([*_strings(words), ""]).lower())
        new = list(set(flat).difference(self.pieces))
        if len(self.pieces) + len(new) > REMEMBER:
            self.pieces.clear()
            new = list(set(flat))
        self.pieces["\n"] = np.array([self.GAP], np.uint16).tobytes()
        new = [p for p in new if p != "\n"]
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            ids = np.array(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint16)
            end = (np.flatnonzero(self.last.take(ids)) + 1).tolist()
            raw = ids.tobytes()
            self.pieces.update((p, raw[2 * a : 2 * b]) for p, a, b in zip(part, [0, *end[:-1]], end, strict=True))
        ids = np.frombuffer(b"".join(map(self.pieces.__getitem__, flat)), np.uint16)
        gap = np.flatnonzero(ids == self.GAP)
        return ids[ids != self.GAP], np.diff(gap, prepend=-1) - 1

    def _other(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        need = _strings(words)
        new = [w for w in need if w not in self.words]
        if len(self.words) + len(new) > REMEMBER:
            self.words.clear()
            new = need
        for k in range(0, len(new), 2000):
            part = new[k : k + 2000]
            self.words.update((w, np.array(e.ids, np.uint16).tobytes()) for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False), strict=True))
        each = [self.words[w] for w in need]
        return np.frombuffer(b"".join(each), np.uint16), np.array(list(map(len, each)), np.int64) // 2

    def ids(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(pc.fill_null(pa.array(texts, pa.string()), ""))
        if not len(split):
            return []
        coded = split.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy()
        plain = pc.and_not(pc.match_substring_regex(words, self.PLAIN), pc.match_substring(words, "<|")) if self.known_cuts else pa.array(np.zeros(len(words), bool))
        (ids1, size1), (ids2, size2) = self._plain(words.filter(plain)), self._other(words.filter(pc.invert(plain)))
        ids, own, plain = np.concatenate([ids1, ids2]), np.concatenate([size1, size2]), plain.to_numpy(zero_copy_only=False)
        size, start = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        size[order], start[order] = own, np.cumsum(own) - own
        out, first = [], np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
        for a in range(0, len(split), common.SLICE_ROWS):
            words_of = first[a : a + common.SLICE_ROWS + 1]
            part = code[words_of[0] : words_of[-1]]
            n = size.take(part)
            end = np.concatenate([[0], np.cumsum(n)])
            own = ids.take(np.repeat(start.take(part) - end[:-1], n) + np.arange(end[-1]))
            cut = end.take(words_of - words_of[0]).tolist()
            out += [own[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
        return out


def _strings(words: pa.Array) -> list[str]:
    """Words without blanks as Python strings, brought over as one string, which is faster than one by one."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py().split("\n") if len(words) else []


FRAME = "part int, first long, n_ids long, doc_ids array<long>, counts array<int>, sizes array<int>, crcs array<long>, blocks array<binary>, known binary"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about SLICE_BYTES of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE_BYTES, side="right")))
        yield batch.slice(a, b - a)
        a = b


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids as numbers by falling frequency, so that most of their upper bytes are alike, and the id of each number."""
    count = np.bincount(ids)
    known = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
    rank = np.empty(len(count), np.uint16)
    rank[known] = np.arange(len(known))
    return rank.take(ids), known


def frames(docs: DataFrame, path: str | None = None, end_id: int = 1) -> DataFrame:
    """The file rows: documents dealt to ranges of doc_id, each range coded in order by one task."""
    path = path or default_path()
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    # by the text too, so that the rows of a repeated id can lie in several ranges
    plain = common.id_text(docs).withColumn("_h", F.xxhash64("text")).repartitionByRange(n, "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")

    def run(batches):
        tok = common.resident(("tokenizer", path), lambda: WordTokenizer(path))
        part, first = TaskContext.get().partitionId(), 0
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush(last: bool):
            nonlocal held, size, first
            rows, row, k = [], [], 0
            for doc in held:
                row.append(doc)
                k += len(doc[1])
                if k >= FRAME_IDS:
                    rows.append(row)
                    row, k = [], 0
            if row and last:
                rows.append(row)
                row = []
            held, size = row, sum(len(x) for _, x in row)
            streams, known = zip(*(_ranked(np.concatenate([x for _, x in r])) for r in rows), strict=True) if rows else ((), ())
            cut = [(i, s[a : a + BLOCK]) for i, s in enumerate(streams) for a in range(0, len(s), BLOCK)]
            order = sorted(range(len(cut)), key=lambda j: -len(cut[j][1]))
            coded: list = [b""] * len(cut)
            for j, b in zip(order, encode_blocks([cut[j][1] for j in order]), strict=True):
                coded[j] = b
            for i, r in enumerate(rows):
                mine = [j for j, (k, _) in enumerate(cut) if k == i]
                yield {
                    "part": part, "first": first, "n_ids": len(streams[i]), "doc_ids": [d for d, _ in r], "counts": [len(x) for _, x in r],
                    "sizes": [len(cut[j][1]) for j in mine], "crcs": [zlib.crc32(cut[j][1].tobytes()) for j in mine], "blocks": [coded[j] for j in mine], "known": known[i].astype("<u2").tobytes(),
                }
                first += len(streams[i])

        schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("crcs", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary())), ("known", pa.binary())])
        end = np.array([end_id], np.uint16)
        for batch in batches:
            for b in slices(batch):
                for doc_id, ids in zip(b.column(0).to_pylist(), tok.ids(b.column(1)), strict=True):
                    held.append((doc_id, np.concatenate([ids, end])))
                    size += len(ids) + 1
                if size >= LANES * BLOCK:
                    for row in flush(False):
                        yield pa.RecordBatch.from_pylist([row], schema)
        for row in flush(True):
            yield pa.RecordBatch.from_pylist([row], schema)

    return plain.mapInArrow(common.releasing(run), FRAME)


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the file rows alone. Starts need one number a range of documents."""
    before, total = {}, 0
    for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        before[r.part] = total
        total += r.n

    def run(batches):
        held: list[dict] = []

        def flush():
            data = [b for r in held for b in r["blocks"]]
            sizes = [n for r in held for n in r["sizes"]]
            got = iter(decode_blocks(data, sizes))
            out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for r in held:
                parts = []
                for crc in r["crcs"]:
                    parts.append(next(got))
                    if zlib.crc32(parts[-1].tobytes()) != crc:
                        raise ValueError("a block's checksum doesn't match its ids")
                ids, at = np.frombuffer(r["known"], "<u2").astype("<u4").take(np.concatenate(parts)), 0
                for doc_id, n in zip(r["doc_ids"], r["counts"], strict=True):
                    out["doc_id"].append(doc_id)
                    out["start"].append(before[r["part"]] + r["first"] + at)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(ids[at : at + n].tobytes()))
                    at += n
            held.clear()
            return pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.int64()) for k in out]))

        lanes = 0
        for batch in batches:
            for i in range(batch.num_rows):
                held += batch.slice(i, 1).to_pylist()
                lanes += len(held[-1]["blocks"])
                if lanes >= LANES:
                    yield flush()
                    lanes = 0
        if held:
            yield flush()

    return files.mapInArrow(common.releasing(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the documents' ids, each document with end id 1, in the shared folder, and reads the files back."""
    return read(common.Durable(docs.sparkSession, "token-ids").put(frames(docs, path)))
