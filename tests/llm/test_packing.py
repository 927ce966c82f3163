"""Packing: an exact round trip, gapless sequences, little padding."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
from llm_helpers import ODD, docs, tables  # noqa: F401
from tokenizers import Tokenizer

from tradewinds.llm import packing, text, wordtable


def check(docs, packed, size):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = {}
    for row in docs.collect():
        want.setdefault(row.doc_id, []).append(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2])
    pieces, sequences, got = {}, {}, packed.collect()
    for p in got:
        assert len(p.ids) == 4 * p.length > 0
        pieces.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert set(pieces) == set(want)
    for doc_id, own in pieces.items():
        if len(want[doc_id]) == 1:
            own.sort(key=lambda p: p.start)
            data = b"".join(p.ids for p in own)
            assert list(struct.unpack(f"<{len(data) // 4}I", data)) == want[doc_id][0]
            assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
            assert {p.doc_tokens for p in own} == {len(want[doc_id][0])}
        else:
            assert sum(p.length for p in own) == sum(map(len, want[doc_id]))
    short = []
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        n = sum(p.length for p in own)
        assert n <= size
        if n < size:
            short.append(n)
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)
    digests = {(p.sequence_id, p.offset): p.ids_crc32 for p in packing.digest(packed).collect()}
    assert digests == {(p.sequence_id, p.offset): zlib.crc32(p.ids) for p in got}


def test_odd_texts(docs):
    found = docs([*enumerate(ODD), (None, "no id"), (50, "twice"), (50, "twice"), (2**60 + 1, "It's 'S we've don't")])
    check(found, packing.pack(found, size=64, open_windows=3), 64)


def test_many_tasks(tables):
    found = tables("documents").select("doc_id", "text").repartition(9)
    check(found, packing.pack(found), packing.SIZE)


def test_one_task_with_few_documents(docs):
    found = docs([(1, "some words"), (2, "more")]).coalesce(1)
    check(found, packing.pack(found), packing.SIZE)


def test_empty_table(docs):
    assert packing.digest(packing.pack(docs([]))).collect() == []


WORDS = [
    "It's 'S we've don't o'clock 'tis", "A-b c.d, (e) f! 10,000.50 x1y2 3rd", "J\u030c I\u0307 \u212a A\u030a \u0130 \u01f0 e\u0301", "<|ENDOFTEXT|> a<|endoftext|>b <a>B</a>",
    "Mixed CASE Words\tand\x0bodd\x1cspace\u3000here\x85", "http://A.b/c?d=E&f=0", "00 0 a0b", "\u03a3\u03b1\u03a3 stra\u00dfe \ufb01 \u00bd\u00b2", "\x00 \x7f a\x00B",
]


def same(texts, path=None):
    tokenizer = Tokenizer.from_file(path or packing.default_tokenizer())
    got = [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in packing.token_ids(texts, path)]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_cut_and_lowered():
    same([*ODD, *WORDS])
    same([a + b for a in WORDS for b in WORDS])


def test_every_pair_of_bytes():
    characters = [chr(c) for c in range(128)]
    same(["".join(f"Q{a}{b}z {a}{b} " for b in characters) for a in characters])


def test_documents(tables):
    same([r.text for r in tables("documents").collect()])


def test_small_table(monkeypatch):
    monkeypatch.setattr(wordtable, "TABLE_BYTES", 2_000_000)
    monkeypatch.setattr(packing, "BLOCK_BYTES", 20_000)
    packing._known.clear()
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("abcdefgh"), 6)) for _ in range(40_000)]
    forgotten = []
    monkeypatch.setattr(wordtable.WordTable, "_forget", lambda self, old=wordtable.WordTable._forget: (old(self), forgotten.append(self.hash.size)))
    same([" ".join(random.choice(words, 500)) for _ in range(300)] + ["abc " * 9_000] * 3)
    assert len(forgotten) > 1
    packing._known.clear()


def test_equal_hashes_of_different_words(monkeypatch):
    monkeypatch.setattr(text, "_mixed", lambda value: value % np.uint64(7))
    packing._known.clear()
    same(["one two three four five six seven eight nine ten one two twelve", "ten nine seventeen"])
    packing._known.clear()


def test_another_tokenizer_goes_text_by_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    packing.token_ids([], path)
    assert not packing._known[path].by_word
    same([*ODD, *WORDS], path)
