"""Near-duplicate documents: a multi-index Hamming join over MinHash signatures.

A document's set holds its distinct five-word shingles (`text.shingle_sets`). Its signature
has `CHUNKS` x `SLOTS` minima of `BITS` bits. Two signatures that differ in at most
`RADIUS` slots differ, by pigeonhole, in at most `ALLOWED` slots of some chunk, so they share
one of the keys made by leaving out any `ALLOWED` slots of that chunk: no pair within the
radius is missed, and pairs beyond it that share a key are not thrown away either. At a
similarity of exactly 0.75 the chance that no chunk agrees is 1e-7. Every link is confirmed
on the full sets.

Bounded work for large groups: documents with equal sets are one class, whatever their
number. In every bucket (classes with the same key) all members are first compared with the
smallest id only. Members that these links have joined to one component need no more
comparisons among each other. In buckets that still have several components, blocks of members are
compared by signature inside a task, each pair at its first shared key only, and only pairs that
may reach the similarity leave the task. So neither copies nor groups of near copies are expanded
into pairs.

Defined cases: null text is empty; documents without words have `n_shingles` 0 and are linked
with nothing; rows with a null doc_id are left unlinked, with a null component, and kept;
rows that repeat a doc_id get a row each, and each of its texts is linked by its own set; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, map_documents, stage, unused
from tradewinds.llm.text import shingle_sets

CHUNKS, SLOTS, ALLOWED, BITS = 12, 4, 1, 16
RADIUS = CHUNKS * (ALLOWED + 1) - 1
#: Linked where 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A second signature of 4 bits a slot, only for members of buckets, to compare pairs before their
#: sets are fetched. Between sets of similarity 0.75, 240 of its 1,024 slots differ on average, with a
#: standard deviation of 13.6; pairs beyond MAX_DIFFERENT (6 deviations more) are not confirmed.
SKETCH_SLOTS = 1_024
MAX_DIFFERENT = 321
#: Members of a bucket that one task compares with as many others.
BLOCK = 512
_SIGN_AT_ONCE = 500_000

_RANDOM = np.random.default_rng(48)
_TIMES = _RANDOM.integers(0, 2**63, CHUNKS * SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**63, CHUNKS * SLOTS, dtype=np.uint64)
_SKETCH_TIMES = _RANDOM.integers(0, 2**31, SKETCH_SLOTS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SKETCH_PLUS = _RANDOM.integers(0, 2**32, SKETCH_SLOTS, dtype=np.uint32)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of every slot's permutation over each (non-empty) set, cut to `BITS` bits."""
    values = np.concatenate(sets)
    begins = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), len(_TIMES)), np.int32)
    for slot, (times, plus) in enumerate(zip(_TIMES, _PLUS)):
        minima = np.minimum.reduceat((values ^ plus) * times, begins)
        out[:, slot] = (minima >> np.uint64(20)) & np.uint64(2**BITS - 1)
    return out


def _sketch(values: np.ndarray) -> bytes:
    """Minima of 32-bit permutations of one set, cut to 4 bits, two to a byte."""
    values = (values >> np.uint64(32)).astype(np.uint32)
    minima = np.full(SKETCH_SLOTS, 2**32 - 1, np.uint32)
    for k in range(0, len(values), 256):
        part = (values[k:k + 256, None] ^ _SKETCH_PLUS) * _SKETCH_TIMES
        np.minimum(minima, part.min(0), out=minima)
    cut = ((minima * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint8)
    return (cut[::2] << 4 | cut[1::2]).tobytes()


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found, at_once, size = [], [], 0
        signatures = []

        def flush() -> None:
            full = [s for s in at_once if len(s)]
            rows = iter(_signatures(full) if full else ())
            signatures.extend(next(rows) if len(s) else None for s in at_once)
            at_once.clear()

        for values in shingle_sets(list(batch["text"])):
            digest = xxhash.xxh3_128_intdigest(values.tobytes())
            found.append((len(values), (digest >> 64) - 2**63, (digest & (2**64 - 1)) - 2**63))
            at_once.append(values)
            size += len(values)
            if size > _SIGN_AT_ONCE:
                flush()
                size = 0
        flush()
        counts = np.array(found, np.int64).reshape(-1, 3)
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].values, "text_hash": batch["text_hash"].values, "n_shingles": counts[:, 0], "high": counts[:, 1], "low": counts[:, 2],
            "signature": signatures,
        })


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = list(shingle_sets(list(batch["text"])))
        yield pd.DataFrame({
            "rep": batch["rep"].values, "members": [s.view(np.int64) for s in sets], "sketch": [_sketch(s) for s in sets],
        })


_KEYS_OF_CHUNK = math.comb(SLOTS, ALLOWED)


def _keys(signature: Column) -> Column:
    """For every chunk and every choice of slots that may differ, a hash of the other slots."""
    keys = []
    for chunk in range(CHUNKS):
        for number, kept in enumerate(itertools.combinations(range(SLOTS), SLOTS - ALLOWED)):
            slots = [signature[chunk * SLOTS + k] for k in kept]
            keys.append(F.xxhash64(F.lit(chunk), F.lit(number), *slots))
    return F.array(*keys)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("members").alias("of_b"))
    na, nb = F.size("of_a"), F.size("of_b")
    both = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(100 * F.least(na, nb) >= percent * F.greatest(na, nb))
        .where(100 * both >= percent * (na + nb - both))
        .select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of the links (a, b): the smallest id that can be reached.

    Every round each id takes the smallest component among its neighbours, then the
    component of that id; so long chains shorten by more than half a round.
    """
    both = stage(links.union(links.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("n"))
                   .select("id", F.least("id", "n").alias("component")), "labels")
    while True:
        heard = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard"))
        )
        nearer = labels.join(heard, "id").select("id", "component", F.least("component", "heard").alias("to"))
        onward = labels.select(F.col("id").alias("to"), F.col("component").alias("beyond"))
        moved = stage(
            nearer.join(onward, "to").select("id", F.col("component").alias("was"), F.least("to", "beyond").alias("component")),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.where("was <> component").limit(1).count() == 0:
            return labels


_DIFFERENT = np.array([(x >> 4 > 0) + (x & 15 > 0) for x in range(256)], np.uint8)


def _compared(left: pd.DataFrame, right: pd.DataFrame, chunk: int, omitted: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs in other components that may be similar and share no earlier key than this one."""
    na, nb = left["n_shingles"].to_numpy()[:, None], right["n_shingles"].to_numpy()[None]
    ok = (left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None])
    ok &= 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    rows, columns = np.nonzero(ok)
    keep_rows, keep_columns = [], []
    a_slots, b_slots = np.stack(left["signature"]), np.stack(right["signature"])
    a_sketch = np.stack([np.frombuffer(x, np.uint8) for x in left["sketch"]])
    b_sketch = np.stack([np.frombuffer(x, np.uint8) for x in right["sketch"]])
    for k in range(0, len(rows), 8_192):
        i, j = rows[k:k + 8_192], columns[k:k + 8_192]
        same = (a_slots[i] == b_slots[j]).reshape(len(i), CHUNKS, SLOTS).sum(2)
        # All slots of the chunk the same: its keys are all shared, and number 0 is the first.
        first = (same[:, :chunk] < SLOTS - ALLOWED).all(1) & ((same[:, chunk] < SLOTS) | (omitted == 0))
        i, j = i[first], j[first]
        near = _DIFFERENT[a_sketch[i] ^ b_sketch[j]].sum(1, dtype=np.int32) <= MAX_DIFFERENT
        keep_rows.append(i[near])
        keep_columns.append(j[near])
    return np.concatenate([*keep_rows, rows[:0]]), np.concatenate([*keep_columns, rows[:0]])


def _pairs(percent: int):
    def pairs(unit: pd.DataFrame) -> pd.DataFrame:
        found = [np.empty((0, 2), np.int64)]
        for _, members in unit.groupby("key"):
            chunk, omitted = int(members["chunk"].iloc[0]), int(members["omitted"].iloc[0])
            i, j = int(members["i"].iloc[0]), int(members["j"].iloc[0])
            left = members[members["block"] == i]
            right = left if i == j else members[members["block"] == j]
            if not len(left) or not len(right):
                continue
            rows, columns = _compared(left, right, chunk, omitted, percent)
            two = np.stack([left["rep"].to_numpy()[rows], right["rep"].to_numpy()[columns]], 1)
            found.append(np.unique(np.sort(two, 1), axis=0))
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    return pairs


def _left_over(buckets: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket that the first links have not joined and that may be similar enough."""
    named = labels.select(F.col("id").alias("rep"), "component")
    members = stage(
        buckets.join(named, "rep", "left")
        .select("key", "chunk", "omitted", "rep", F.coalesce("component", "rep").alias("component")), "members"
    )
    mixed = (
        members.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high").select("key", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    )
    left = stage(members.join(mixed, "key"), "mixed")
    # Small buckets share a task; of large ones every two blocks meet in a task.
    tasks = max(1, left.where("blocks = 1").count() // (4 * BLOCK))
    small = F.col("blocks") == 1
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    placed = (
        left.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks")).withColumn("other", other)
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .withColumn("unit", F.when(small, F.pmod(F.xxhash64("key"), F.lit(tasks))).otherwise(F.col("key")))
        .withColumn("small", small)
        .drop("blocks", "other")
        .join(classes.select("rep", "n_shingles", "signature"), "rep")
        .join(sets.select("rep", "sketch"), "rep")
    )
    return placed.groupBy("small", "unit", "i", "j").applyInPandas(_pairs(percent), "a bigint, b bigint")


#: Tells the texts of one doc_id apart; only compared within a doc_id.
_TEXT_HASH = "xxhash64(coalesce(text, ''))"


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (a number of this run), component_id for every row of `docs`."""
    docs = documents(docs).withColumn("text_hash", F.expr(_TEXT_HASH))
    signed = stage(map_documents(
        docs, _signed,
        "doc_id bigint, text_hash bigint, n_shingles bigint, high bigint, low bigint, signature array<int>",
    ), "signed")
    of_set = ["n_shingles", "high", "low"]
    classes = stage(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*of_set)
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("one"), F.first("signature").alias("signature"))
        # A number of its own for every class: a doc_id that repeats with other texts stands in several.
        .select(*of_set, "one.doc_id", "one.text_hash", "signature", F.monotonically_increasing_id().alias("rep")),
        "classes",
    )
    keyed = classes.select(F.posexplode(_keys(F.col("signature"))).alias("number", "key"), "rep", "doc_id").select(
        "key", F.floor(F.col("number") / _KEYS_OF_CHUNK).cast("int").alias("chunk"),
        (F.col("number") % _KEYS_OF_CHUNK).alias("omitted"), "rep", "doc_id",
    )
    # By doc_id, as the numbers follow the hash of a set: all buckets of a group should have the same first member.
    first = [F.min_by("rep", "doc_id").alias("first"), F.min("rep").alias("low"), F.max("rep").alias("high")]
    shared = keyed.groupBy("key").agg(*first).where("low <> high")
    buckets = stage(keyed.drop("doc_id").join(shared.select("key", "first"), "key"), "buckets")

    in_buckets = buckets.select("rep").distinct()
    texts = docs.join(classes.select("rep", "doc_id", "text_hash").join(in_buckets, "rep"), ["doc_id", "text_hash"])
    sets = stage(
        texts.groupBy("rep").agg(F.min("text").alias("text"))
        .mapInPandas(_sets, "rep bigint, members array<bigint>, sketch binary"),
        "sets",
    )
    stars = buckets.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_confirmed(stars, sets, percent), "links")
    labels = components(links)
    more = stage(_confirmed(_left_over(buckets, classes, sets, labels, percent), sets, percent), "links")
    if more.limit(1).count():
        labels = components(links.union(more))

    smallest = labels.join(classes.select(F.col("rep").alias("id"), "doc_id"), "id")
    smallest = smallest.groupBy("component").agg(F.min("doc_id").alias("smallest"))
    of_class = (
        classes.join(labels.join(smallest, "component").withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            *of_set, F.coalesce("component", "rep").alias("component"), F.coalesce("smallest", "doc_id").alias("component_id")
        )
    )
    with_id = F.col("doc_id").isNotNull()
    return signed.join(of_class, of_set, "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(with_id, F.col("component")).alias("component"),
        F.when(with_id, F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


_KEPT = "coalesce(doc_id = component_id, true)"


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text)."""
    return _grouped(docs, percent).select("doc_id", "n_shingles", "component_id", F.expr(_KEPT).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` without the documents that another of their group stands for.

    Of rows that share a doc_id and a group one stays; other texts of that doc_id stay too.
    """
    kept = (
        _grouped(docs, percent).where("doc_id IS NOT NULL").where(_KEPT).groupBy("doc_id", "component")
        .agg(F.min("text_hash").alias("text_hash"))
    )
    own, kept_id, kept_text = (unused(docs, name) for name in ("__text", "__kept_id", "__kept_text"))
    kept = kept.select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_text))
    hashed = docs.where("doc_id IS NOT NULL").withColumn(own, F.expr(_TEXT_HASH))
    same = (F.col("doc_id").cast("bigint") == F.col(kept_id)) & (F.col(own) == F.col(kept_text))
    with_id = hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", own])
    return with_id.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
