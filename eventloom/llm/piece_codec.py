"""SentencePiece encoding and decoding: merge-type encoding without running the merges.

A sequence of pieces is the merge result of a text exactly if each two neighbours, merged again from their characters,
come out as those two. So the encoder walks a text with the longest match at each place (Aho-Corasick), checks each
piece against the one before it by re-merging the two (memoized), takes shorter matches where that fails, and goes back
where none is left; a bit field keeps the positions that can't be completed, so each is tried once. The result of a
prefix is unique, hence a failed position fails for every way that leads there.

Null and empty texts have no ids and decode to the empty text. Characters without a piece become byte pieces.
Long texts are cut into segments (see vocabulary.py), so memory follows the longest run without blanks. Repeated rows each
get their row, an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .vocabulary import MARK, PieceVocabulary, default_path


codecs.register_error("each_byte", lambda e: ("\ufffd", e.start + 1))

#: Score of what is no piece.
_NO = float("-inf")


class MergeEncoder:
    def __init__(self, path: str):
        self.vocab = v = PieceVocabulary(path)
        self.byte_of = {i: b for b, i in v.byte_id.items()}
        self.rank = {p: v.score[i] for p, i in v.id_of.items()}
        self.said = {p: str(i) for p, i in v.id_of.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo = common.Memo(self._entry)

    def remerge(self, text: str) -> list[str]:
        """The merges themselves: the neighbours with the best joint score, leftmost first, until none is a piece."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 200_000:
                self.pairs.clear()
            known = self.pairs[key] = self._stays_cut(left, right)
        return known

    def _stays_cut(self, left: str, right: str) -> bool:
        """Whether remerge(left + right) is [left, right]: given up at the first merge across the cut."""
        rank, no = self.rank.get, _NO
        parts, cut = [*left, *right], len(left)
        scores = [rank(a + b, no) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == no:
                break
            at = scores.index(best)
            if at == cut - 1:
                return False
            if at < cut:
                cut -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = rank(parts[at - 1] + parts[at], no)
            if at < len(scores):
                scores[at] = rank(parts[at] + parts[at + 1], no)
        return len(parts) == 2

    def tokens(self, segment: str) -> list[str]:
        """The merge result of a segment as its pieces; a character that is no piece stands alone."""
        n, known, pairs = len(segment), self.vocab.id_of, self.pairs
        longest = list(range(1, n + 1))
        length = self.vocab.length
        for last, piece in self.vocab.automaton.iter(segment):
            longest[last - length[piece] + 1] = last + 1
        quick: list[str] = []
        at, before = 0, None
        while at < n:  # mostly the longest piece at each place will do
            token = segment[at : longest[at]]
            if before is not None and not pairs.get((before, token)) and not self.compatible(before, token):
                break
            quick.append(token)
            at, before = longest[at], token
        else:
            return quick
        failed, at, end = 0, 0, longest[0]
        starts: list[int] = []
        found: list[str] = []
        while True:
            token = segment[at:end]
            if not failed >> end & 1 and (not found or (pairs.get((found[-1], token)) or self.compatible(found[-1], token))):
                found.append(token)
                if end == n:
                    return found
                starts.append(at)
                at, end = end, longest[end]
                continue
            end -= 1
            while end > at + 1 and segment[at:end] not in known:
                end -= 1
            while end <= at:  # nothing left to try here: back to the piece before, and on to its next shorter match
                failed |= 1 << at
                end, at = at, starts.pop()
                found.pop()
                end -= 1
                while end > at + 1 and segment[at:end] not in known:
                    end -= 1

    def ids(self, text: str | None) -> list[int]:
        out: list[int] = []
        for s in self.vocab.segments(text):
            for token in self.tokens(s):
                i = self.vocab.id_of.get(token)
                out.extend([i] if i is not None else [self.vocab.byte_id[b] for b in token.encode()])
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: marks are blanks, byte pieces are UTF-8 with U+FFFD for each byte of what is none, a leading mark goes."""
        first = bool(ids) and self.vocab.normal[ids[0]] and self.vocab.piece[ids[0]].startswith(MARK)
        return self._plain(ids)[first:]

    def _plain(self, ids: list[int]) -> str:
        v, out, run = self.vocab, [], bytearray()
        for i in ids:
            if v.normal[i]:
                if run:
                    out.append(run.decode(errors="each_byte"))
                    run.clear()
                out.append(v.piece[i])
            elif i in self.byte_of:
                run.append(self.byte_of[i])
        if run:
            out.append(run.decode(errors="each_byte"))
        return "".join(out).replace(MARK, " ")

    def _entry(self, segment: str) -> tuple[str, str]:
        tokens = self.tokens(segment)
        said = list(map(self.said.get, tokens))
        if None not in said:  # all are pieces, and together the segment
            return ",".join(said), segment.replace(MARK, " ")
        ids: list[int] = []
        for token in tokens:
            i = self.vocab.id_of.get(token)
            ids.extend([i] if i is not None else [self.vocab.byte_id[b] for b in token.encode()])
        return ",".join(map(str, ids)), self._plain(ids)

    def coded(self, text: str | None) -> tuple[str, str]:
        """Ids as decimals joined by commas, and the text decoded from them."""
        segments = self.vocab.segments(text)
        if not segments:
            return "", ""
        got = list(map(self.memo.__getitem__, segments))
        return ",".join([x for x, _ in got]), "".join([x for _, x in got]).removeprefix(" ")


def _encoder(path: str) -> MergeEncoder:
    return common.resident(("merge", path), lambda: MergeEncoder(path))


def encode(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded (string) for each row; null text counts as empty."""
    path = model_path or default_path()

    def start():
        enc = _encoder(path)

        def step(b: pa.RecordBatch):
            got = [enc.coded(t) for t in b.column(1).to_pylist()]
            ids = pa.array([list(map(int, x.split(","))) if x else [] for x, _ in got], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array([x for _, x in got], pa.string())], ["doc_id", "ids", "decoded"])

        return step

    return common.map_rows(common.id_text(docs), "doc_id long, ids array<int>, decoded string", start)


def encode_digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encode() gives, as digests made where the ids are."""
    path = model_path or default_path()

    def start():
        enc = _encoder(path)

        def step(b: pa.RecordBatch):
            n, a, d = [], [], []
            for text in b.column(1).to_pylist():
                ids, decoded = enc.coded(text)
                n.append(ids.count(",") + 1 if ids else 0)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                d.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return common.map_rows(common.id_text(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", start)
