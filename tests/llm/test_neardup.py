"""Near duplicates against brute force."""

from __future__ import annotations

import random

import numpy as np
from llm_helpers import ODD, docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tradewinds.llm import decontaminate, neardup
from tradewinds.llm.text import shingle_sets


def sets_of(texts):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(5, len(words))
        out.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def brute(found):
    ids, sets = [i for i, _ in found], sets_of([t for _, t in found])
    parent = list(range(len(ids)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                if ids[x] < ids[y]:
                    x, y = y, x
                parent[x] = y
    return sorted((i, len(s), ids[root(k)], ids[root(k)] == i) for k, (i, s) in enumerate(zip(ids, sets)))


def corpus(seed, groups, copies, edits):
    """Groups of texts, each an edited copy of the group's first, with exact copies and a shared passage."""
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [pick.choice(words) for _ in range(40)]
    out = []
    for g in range(groups):
        first = [pick.choice(words) for _ in range(pick.choice([3, 5, 30, 80]))] + (passage if g % 2 else [])
        for _ in range(copies):
            text = list(first)
            for _ in range(pick.randrange(edits)):
                text[pick.randrange(len(text))] = pick.choice(words)
            out.append(" ".join(text).title() if pick.random() < 0.2 else "  ".join(text))
    pick.shuffle(out)
    return list(enumerate(out, 100))


def test_against_brute_force(docs):
    found = corpus(1, 20, 8, 6)
    assert rows(neardup.near_duplicates(docs(found))) == sorted(brute(found), key=repr)


def test_large_group_is_compared_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    found = corpus(2, 3, 60, 25)
    assert rows(neardup.near_duplicates(docs(found))) == sorted(brute(found), key=repr)


def test_odd_texts_and_ids(docs):
    found = list(enumerate(ODD))
    assert rows(neardup.near_duplicates(docs(found))) == sorted(brute(found), key=repr)
    text = "one two three four five six"
    big = 2**62 + 1
    got = rows(neardup.near_duplicates(docs([(big, text), (big, text), (None, text), (7, ""), (None, None), (big + 1, text)])))
    assert got == sorted(
        [(big, 2, big, True)] * 2 + [(None, 2, None, True), (7, 0, 7, True), (None, 0, None, True), (big + 1, 2, big, False)],
        key=repr,
    )


def test_empty_table(docs):
    assert rows(neardup.near_duplicates(docs([]))) == []
    assert neardup.keep_one(docs([])).columns == docs([]).columns


def test_keep_one(docs):
    text = "one two three four five six"
    kept = neardup.keep_one(docs([(3, text), (2, text), (2, text), (9, "else"), (None, text)]))
    assert rows(kept, "doc_id") == [(2,), (9,), (None,)]
    assert kept.columns == docs([]).columns


def test_texts_that_share_a_doc_id(docs):
    pick = random.Random(4)
    first, second = (" ".join(f"{name}{pick.randrange(900)}" for _ in range(60)) for name in "ab")
    near = second + " more"
    found = [(5, first), (5, second), (5, second), (5, near), (9, near), (5, ""), (5, " "), (8, second.title())]
    want = [(5, 56, 5, True)] * 3 + [(5, 57, 5, True), (9, 57, 5, False), (5, 0, 5, True), (5, 0, 5, True), (8, 56, 5, False)]
    assert rows(neardup.near_duplicates(docs(found))) == sorted(want, key=repr)
    for order in (found, found[::-1]):
        kept = rows(neardup.keep_one(docs(order)), "doc_id", "text")
        assert len(kept) == 3 and {i for i, _ in kept} == {5}
        texts = {t.strip() for _, t in kept}
        assert first in texts and "" in texts and len(texts & {second, near}) == 1


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 99)], "a bigint, b bigint")
    assert rows(neardup.components(links)) == sorted([(k, 0) for k in range(41)] + [(99, 99), (100, 99)], key=repr)


def test_every_pair_within_the_radius_shares_a_key():
    pick = np.random.default_rng(3)
    slots = neardup.CHUNKS * neardup.SLOTS
    for _ in range(300):
        differ = np.zeros(slots, bool)
        differ[pick.choice(slots, neardup.RADIUS, replace=False)] = True
        assert (differ.reshape(neardup.CHUNKS, neardup.SLOTS).sum(1) <= neardup.ALLOWED).any()


def test_shingle_counts():
    assert [len(s) for s in shingle_sets(ODD)] == [len(s) for s in sets_of(ODD)]


def test_columns_named_like_the_operators_own(docs, spark):
    """Columns of the caller that have the names of helper and output columns are kept as they are."""
    names = ["kept", "text_hash", "__text", "__kept_id", "__kept_text", "found", "__found", "component_id", "rep", "signature"]
    text = "one two three four five six seven eight nine ten"
    table = docs([(3, text), (2, text), (9, "else"), (None, text)])
    for name in names:
        table = table.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    kept = neardup.keep_one(table)
    assert kept.columns == table.columns
    assert rows(kept, "doc_id", "kept", "__text") == [(2, "kept2", "__text2"), (9, "kept9", "__text9"), (None, None, None)]
    passage = " ".join(f"word{k}" for k in range(20))
    benchmark = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    dirty = table.unionByName(table.limit(1).withColumn("text", F.lit(passage)).withColumn("doc_id", F.lit(50).cast("bigint")))
    clean = decontaminate.clean(dirty, benchmark)
    assert clean.columns == table.columns and rows(clean, "doc_id") == [(2,), (3,), (9,), (None,)]
