"""Encoders against the libraries: op1, op4, op9."""

import hashlib
import random
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm import piece_codec, token_binary, token_counts
from eventloom.llm.vocabulary import MARK, default_path

spm = pytest.importorskip("sentencepiece")
SP = spm.SentencePieceProcessor(model_file=default_path())
ENC = piece_codec.MergeEncoder(default_path())
COUNT = token_counts.ViterbiCounter(default_path())
odd_text = st.lists(st.one_of(st.sampled_from(["the", " ", "  ", "\n", MARK, "é", "́", "😀", "字", "<s>", "<0x0A>", "\x00", "ing", ".", ",", "x."]), st.text(max_size=3))).map("".join)


@settings(max_examples=400, deadline=None)
@given(odd_text)
def test_encoder_is_the_librarys(text):
    ids = SP.encode(text)
    assert ENC.ids(text) == ids
    assert ENC.coded(text) == (",".join(map(str, ids)), SP.decode(ids))
    assert ENC.decode(ids) == SP.decode(ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=12))
def test_decoder_takes_any_ids(ids):
    assert ENC.decode(ids) == SP.decode(ids)


@settings(max_examples=300, deadline=None)
@given(odd_text)
def test_counts_are_the_unigram_models(text):
    from tokenizers import models

    v = COUNT.vocab
    global UNI
    try:
        UNI
    except NameError:
        UNI = models.Unigram([(v.piece[i] if v.normal[i] or v.piece[i].startswith("<0x") or i == 0 else f"{i}", v.score[i]) for i in range(v.size)], unk_id=0, byte_fallback=True)
    if "<0x" in text or "<unk" in text:
        return
    expected = len(UNI.tokenize(MARK + text.replace(" ", MARK))) if text else 0
    assert COUNT.count(text)[0] == expected


def test_encode_table(spark, awkward, texts):
    got = {r.doc_id: r for r in piece_codec.encode_digests(awkward).collect()}
    assert piece_codec.encode_digests(awkward).count() == len(texts)
    for i, t in texts:
        ids = SP.encode(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(SP.decode(ids).encode()).hexdigest()
    assert piece_codec.encode(awkward.limit(0)).count() == 0


def test_count_table(awkward, texts):
    got = {r.doc_id: (r.n_tokens, r.best_score) for r in token_counts.token_counts(awkward).collect()}
    assert got[200] == got[201] == (0, 0.0)
    assert all(got[i][0] == COUNT.count(t)[0] for i, t in texts)


def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(0, hi, size=n).astype(np.uint16) for n, hi in ((token_binary.BLOCK, 65536), (token_binary.BLOCK, 3), (700, 500), (1, 10))]
    blocks.insert(1, np.tile(np.arange(7, dtype=np.uint16), 400)[: token_binary.BLOCK])
    data = token_binary.encode_blocks(blocks)
    back = token_binary.decode_blocks(data, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))
    assert len(data[1]) < len(blocks[1]) / 2  # repeated ids cost little
    alone = token_binary.decode_blocks([data[3]], [len(blocks[3])])[0]
    assert np.array_equal(alone, blocks[3])  # a block doesn't need the others


def test_word_tokenizer():
    from tokenizers import Tokenizer

    tok, lib = token_binary.WordTokenizer(token_binary.default_path()), Tokenizer.from_file(token_binary.default_path())
    rng = random.Random(1)
    parts = ["a", "'s", "the", " ", "\n", "é", "😀", "字", "İ", "Σ", "1", "\x02", "\x1c", "　", "\xa0", "<|endoftext|>", "-", "don't"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 10))) for _ in range(800)]
    for t, ids in zip(made, tok.ids(made), strict=True):
        assert list(ids) == lib.encode(t, add_special_tokens=False).ids


def test_files(awkward, texts):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(token_binary.default_path())
    got = token_binary.write_and_read(awkward).orderBy("start").collect()
    assert len(got) == len(texts)
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts}
    at = 0
    for r in got:
        own = np.array(ids[r.doc_id], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    assert token_binary.write_and_read(awkward.limit(0)).count() == 0


def test_damage_is_found(spark, awkward):
    files = token_binary.frames(awkward.limit(20)).collect()
    bad = [r.asDict() | {"crcs": [c ^ 1 for c in r.crcs]} for r in files]
    with pytest.raises(Exception, match="checksum"):
        token_binary.read(spark.createDataFrame(bad, token_binary.FRAME)).collect()


def test_empty_tables(awkward):
    assert token_counts.token_counts(awkward.limit(0)).count() == 0
    assert piece_codec.encode_digests(awkward.limit(0)).count() == 0


def test_rows_of_one_id_in_many_ranges(spark, monkeypatch):
    """A third of all rows have one id: they may lie in several ranges, and the order of the file stays that of the ids."""
    monkeypatch.setattr(token_binary, "RANGE_BYTES", 2000)
    rows = [(7 if i % 3 == 0 else i, f"some words number {i} of the text") for i in range(600)]
    got = token_binary.write_and_read(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("start").collect()
    assert len(got) == 600 and [r.doc_id for r in got] == sorted(r[0] for r in rows)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(600)]


def test_pairs_that_stay_cut_are_those_of_the_merges():
    import random

    from eventloom.llm.piece_codec import MergeEncoder
    from eventloom.llm.vocabulary import default_path

    enc, rng = MergeEncoder(default_path()), random.Random(1)
    pieces = [p for p in enc.vocab.id_of if len(p) < 7]
    seen = set()
    for _ in range(3000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        want = enc.remerge(a + b) == [a, b]
        assert enc._stays_cut(a, b) == want
        seen.add(want)
    assert seen == {True, False}


def test_blocks_go_in_even_groups(monkeypatch):
    """A few blocks over the number that goes in lockstep don't take a round of steps of their own."""
    monkeypatch.setattr(token_binary, "LANES", 8)
    steps, step = [], token_binary.Coder.step
    monkeypatch.setattr(token_binary.Coder, "step", lambda self, *a: (steps.append(1), step(self, *a))[1])
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 3000, size=100).astype(np.uint16) for _ in range(9)]
    data = token_binary.encode_blocks(blocks)
    assert len(steps) == 100
    assert all(np.array_equal(a, b) for a, b in zip(blocks, token_binary.decode_blocks(data, [100] * 9), strict=True))
    assert len(steps) == 200


def test_pieces_are_learned_once():
    """Words that differ in case and marks only share their pieces, and the library isn't asked for these again."""
    from tokenizers import Tokenizer

    tok, lib = token_binary.WordTokenizer(token_binary.default_path()), Tokenizer.from_file(token_binary.default_path())
    asked = []
    tok.bare = SimpleNamespace(encode_batch_fast=lambda x, f=tok.bare.encode_batch_fast, **k: (asked.extend(x), f(x, **k))[1])
    made = ["thnedly Thnedly, thnedly. (THNEDLY) éaiau Éaiau!", "thnedly; éaiau? nfß NFẞ", "\x85thnedly\xa0éaiau\u2028", "a\u0301 \u212b \u212a thnedly<|endoftext|>", None, ""]
    for t, ids in zip(made, tok.ids(made), strict=True):
        assert list(ids) == lib.encode(t or "", add_special_tokens=False).ids
    assert tok.ids(made[:2])[0].tolist() == lib.encode(made[0], add_special_tokens=False).ids
    pieces = " ".join(asked).split()
    assert len(pieces) == len(set(pieces)) and "thnedly" in pieces and "éaiau" in pieces
    assert all(np.array_equal(a, b) for a, b in zip(tok.ids(["nothing more"] * 2), token_binary.WordTokenizer(token_binary.default_path()).ids(["nothing more"] * 2), strict=True))


def test_numbers_by_frequency():
    """A frame's ids are coded as numbers by frequency, which its row gives back."""
    ids = np.array([40000, 7, 40000, 9, 40000, 7, 1], np.uint16)
    rank, known = token_binary._ranked(ids)
    assert rank.tolist() == [0, 1, 0, 3, 0, 1, 2] and known.tolist() == [40000, 7, 1, 9]
    assert np.array_equal(known.take(rank), ids)
