"""The fixed public piece vocabulary: pieces, scores, one Aho-Corasick automaton, and the cut of a text into segments.

No piece has a word mark after another character, and no piece holds a newline; so no piece crosses a segment, and
what is computed for a segment holds wherever it stands. That is checked when a vocabulary is loaded.
"""

from __future__ import annotations

import re

import ahocorasick
import sentencepiece

MARK = "\u2581"
_RUNS = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
#: Fixed: marks that follow a letter in no piece of the public vocabulary (checked on loading), so a cut there is exact.
STOPS = ",.;:|!?\"'()%&$#*"
_AFTER_LETTER = re.compile(rf"([A-Za-z\u00C0-\u024F])([{re.escape(STOPS)}])")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceVocabulary:
    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(self.size)]
        self.normal = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(self.size)]
        self.score = [sp.get_score(i) for i in range(self.size)]
        self.id_of = {p: i for i, p in enumerate(self.piece) if self.normal[i]}
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        if any(MARK in p.lstrip(MARK) or "\n" in p or _AFTER_LETTER.search(p) for p in self.id_of):
            raise ValueError("a piece crosses the segments of this cut")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.piece]

    @staticmethod
    def segments(text: str | None) -> list[str]:
        """The text after a leading word mark, cut before each run of marks, around each newline and between a letter and a stop; empty text: none."""
        if not text:
            return []
        if "  " in text or MARK in text or text[-1] == " " or text[0] == " " or " \n" in text:
            cut = " ".join(_RUNS.findall(MARK + text.replace(" ", MARK)))
        else:
            cut = MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")
        return [s for s in _AFTER_LETTER.sub(r"\1 \2", cut).split(" ") if s]
