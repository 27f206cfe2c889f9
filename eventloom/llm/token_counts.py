"""Token counts without tokens: a Viterbi that carries only the best score and the number of pieces.

The unigram vocabulary is the fixed public one with the scores that its file gives. Aho-Corasick enumerates the pieces
that end at each character; the state of a character is (best score, count). Ties follow the tokenizer: among equal
scores the piece that starts first, hence the longest, stays; a character that is no piece itself costs the least score
less ten and counts as its UTF-8 bytes. Scores are whole numbers, so sums are exact in any order and a segment's
result holds wherever it stands: segments are memoized. Null and empty texts have 0 tokens and score 0. A very long text
is counted segment by segment, in time linear in its length. Repeated rows each get their row, an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .vocabulary import PieceVocabulary, default_path

#: Fixed: what a character without a piece costs beyond the least score.
UNKNOWN_PENALTY = 10.0


class ViterbiCounter:
    def __init__(self, path: str):
        self.vocab = v = PieceVocabulary(path)
        own = [v.score[i] for i in v.id_of.values()]
        if any(s != int(s) for s in own):
            raise ValueError("scores must be whole numbers: sums of fractions depend on their order")
        self.unknown = min(own) - UNKNOWN_PENALTY
        self.memo = common.Memo(self.best)

    def best(self, segment: str) -> tuple[float, int]:
        v, n = self.vocab, len(segment)
        by_end: list[list[int]] = [[] for _ in range(n)]
        for last, piece in v.automaton.iter(segment):
            by_end[last].append(piece)
        score, count = [0.0] + [0.0] * n, [0] * (n + 1)
        for last in range(n):
            top, pieces = None, 0
            single = False
            for piece in sorted(by_end[last], key=v.length.__getitem__, reverse=True):
                start = last + 1 - v.length[piece]
                single |= start == last
                s = score[start] + v.score[piece]
                if top is None or s > top:
                    top, pieces = s, count[start] + 1
            if not single:
                s = score[last] + self.unknown
                if top is None or s > top:
                    top, pieces = s, count[last] + len(segment[last].encode())
            score[last + 1], count[last + 1] = top, pieces
        return score[n], count[n]

    def count(self, text: str | None) -> tuple[int, float]:
        got = list(map(self.memo.__getitem__, self.vocab.segments(text)))
        return sum([c for _, c in got]), float(sum([s for s, _ in got]))


def token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens (long), best_score (double): one narrow pass, no shuffle."""
    path = model_path or default_path()

    def start():
        counter = common.resident(("viterbi", path), lambda: ViterbiCounter(path))

        def step(b: pa.RecordBatch):
            got = [counter.count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([s for _, s in got], pa.float64())], ["doc_id", "n_tokens", "best_score"])

        return step

    return common.map_rows(common.id_text(docs), "doc_id long, n_tokens long, best_score double", start)
