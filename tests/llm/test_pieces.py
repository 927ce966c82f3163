"""SentencePiece encoding and decoding against the library, with the public model and with made ones."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from llm_helpers import ODD, SF_DIR, docs, tables  # noqa: F401
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tradewinds.llm import pieces, queries, wordtable

WORDS = [
    "  two  spaces ", "▁ mark ▁▁", "<s> </s> <unk> <0x41>", "tab\tline\nbreak\r\n", "\x00\x7f", "日本語テキスト 漢字", "é ﬁ Ａ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaa", "12345 1,000.5", "🙂🙂 ü", "� ﻿", "(((([[[[{{{{ ;;;; ====",
]


def same(vocabulary, texts):
    got = [x.tolist() for x in vocabulary.encode(texts)]
    want = vocabulary.library.encode(texts)
    assert got == want
    assert [vocabulary.decode(x) for x in got] == [vocabulary.library.decode(x) for x in want]


def test_odd_texts_and_words():
    vocabulary = pieces.pieces(None)
    same(vocabulary, [t or "" for t in ODD] + WORDS + [a + b for a in WORDS for b in WORDS])


def test_random_texts():
    random = np.random.default_rng(2)
    letters = list(" abcdefghijklmnopqrstuvwxyz.,'-\n09ABÄß漢▁🙂́")
    same(pieces.pieces(None), ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(2_000)])


def test_documents(spark, tables):
    texts = {r.doc_id: r.text or "" for r in tables("documents").collect()}
    library = SentencePieceProcessor(model_file=pieces.default_model())
    got = queries.op11_sentencepiece(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        want = (len(ids), ",".join(map(str, ids)), library.decode(ids))
        assert r.agrees and r.n_tokens == want[0]
        assert [r.ids_sha256, r.decoded_sha256] == [hashlib.sha256(x.encode()).hexdigest() for x in want[1:]]


def test_odd_rows(docs):
    found = pieces.encode(docs([*enumerate(ODD), (None, "no id"), (50, "twice"), (50, "twice"), (2**60 + 1, "large id")]))
    library = SentencePieceProcessor(model_file=pieces.default_model())
    got = {(r.doc_id, r.decoded): r for r in found.collect()}
    assert len(got) == len(ODD) + 3 and all(r.agrees for r in got.values())
    for k, text in enumerate(ODD):
        assert list(got[k, library.decode(library.encode(text or ""))].ids) == library.encode(text or "")
    assert got[None, "no id"].ids and got[2**60 + 1, "large id"].ids
    empty = pieces.digest(found).where("doc_id = 0").first()
    assert empty.n_tokens == 0 and empty.ids_sha256 == empty.decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert pieces.digest(pieces.encode(docs([]))).collect() == []
    assert {r.agrees for r in pieces.encode(docs([(1, "a")]), check=False).collect()} == {None}


def made(seed: int, fallback: bool, user: bool = False, unused: bool = False, extra: bool = False, spanning: bool = False) -> bytes:
    """A small vocabulary of random pieces with many equal scores; nothing is trained."""
    random = np.random.default_rng(seed)
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = model.trainer_spec.BPE
    model.trainer_spec.byte_fallback = fallback
    model.normalizer_spec.add_dummy_prefix = bool(seed % 2)
    model.normalizer_spec.remove_extra_whitespaces = extra
    kinds = model.SentencePiece
    forms = [("<unk>", 0.0, kinds.UNKNOWN), ("<s>", 0.0, kinds.CONTROL), ("</s>", 0.0, kinds.CONTROL)]
    if fallback:
        forms += [(f"<0x{b:02X}>", 0.0, kinds.BYTE) for b in range(256)]
    if user:
        forms += [("abc", 0.0, kinds.USER_DEFINED), ("c▁", 0.0, kinds.USER_DEFINED), ("漢", 0.0, kinds.USER_DEFINED)]
    seen = {f[0] for f in forms}
    letters = ["a", "b", "c", "d", "▁", "ü"]
    for size in (1, 2, 2, 2, 3, 3, 4, 5):
        for _ in range(12):
            form = "".join(random.choice(letters, size))
            if form not in seen and (spanning or "▁" not in form[1:]):
                seen.add(form)
                kind = kinds.UNUSED if unused and size > 1 and random.random() < 0.3 else kinds.NORMAL
                forms.append((form, -float(random.integers(0, 12)), kind))
    for form, score, kind in forms:
        model.pieces.add(piece=form, score=score, type=kind)
    return model.SerializeToString()


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("more", [
    {}, {"user": True}, {"unused": True}, {"unused": True, "spanning": True, "user": True}, {"extra": True}, {"spanning": True},
])
@pytest.mark.parametrize("fallback", [True, False])
def test_made_vocabularies(seed, more, fallback):
    vocabulary = pieces.Pieces(made(seed, fallback, **more))
    random = np.random.default_rng(seed + 100)
    letters = list("aabbccdd  üx漢")
    texts = ["".join(random.choice(letters, random.integers(0, 40))) for _ in range(300)]
    got = [x.tolist() for x in vocabulary.encode(texts)]
    assert got == vocabulary.library.encode(texts)


def test_decoding_of_any_ids():
    vocabulary = pieces.pieces(None)
    random = np.random.default_rng(5)
    for _ in range(500):
        ids = np.where(random.random(12) < 0.6, random.integers(3, 259, 12), random.integers(0, 32_000, 12)).tolist()
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids)
    assert vocabulary.decode([]) == ""


def test_small_table(monkeypatch):
    monkeypatch.setattr(wordtable, "TABLE_BYTES", 1_500_000)
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 20_000)
    with open(pieces.default_model(), "rb") as file:
        vocabulary = pieces.Pieces(file.read())
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("abcdefgh"), 6)) for _ in range(20_000)]
    same(vocabulary, [" ".join(random.choice(words, 300)) for _ in range(100)])


@pytest.mark.parametrize("model", [None, 0, 1, 2, 3])
def test_new_words_of_letters_are_merged_many_at_once(monkeypatch, model):
    """The agenda, one word at a time, is left with the words that are long or have other characters."""
    if model is None:
        with open(pieces.default_model(), "rb") as file:
            vocabulary = pieces.Pieces(file.read())
    else:
        vocabulary = pieces.Pieces(made(model, True, spanning=bool(model % 2)))
    seen, agenda = [], vocabulary.agenda
    monkeypatch.setattr(vocabulary, "agenda", lambda text: seen.append(text) or agenda(text))
    random = np.random.default_rng(8)
    words = ["".join(random.choice(list("abcd"), random.integers(1, 9))) for _ in range(3_000)]
    same(vocabulary, [" ".join(words), "abc\u00fcd", "", " ".join(words[::-1]), "ab" * 30])
    plain = vocabulary.letters >= 0
    assert len(seen) < 50 or model is not None
    assert all(len(w) > pieces.LONGEST or not all(ord(c) < 128 and plain[ord(c)] for c in w) for w in seen)


def test_other_models_are_refused():
    model = sentencepiece_model_pb2.ModelProto.FromString(made(1, True))
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        pieces.Pieces(model.SerializeToString())
