"""Benchmark passages in documents: spaced-seed hashing, joined by hash, verified around the hits.

Words are runs of letters and digits in lower case. Each of `PATTERNS` looks at 7 of the words it
spans, so a substituted word at an ignored position does not matter. Whichever two words of `SPAN` in a row are
substituted, some pattern fits between or around them; so every stretch described below holds a hit. The hashes
of all windows of the benchmark and of the documents are joined. To keep the join small, document
windows first pass a bit table of the benchmark's hashes, of fixed size `TABLE_BITS` with three bits for
each hash; a full table would only let more windows through. Around every hit the document's words are compared with the
item's along the hit's diagonal: a match is a stretch of `WINDOW` words (the whole item if it is
shorter) of which at least `EQUAL` are the same, with substitutions allowed anywhere in it.

Items of 5 to 11 words are found by the hash of all their words and must occur in full, without substitutions; items
of fewer words are no evidence and are not looked for.

Defined cases: null text is empty; empty texts match nothing; rows that repeat a doc_id (or have
none) are looked at each, and `contaminated` reports them under that doc_id; items that repeat an
item_id count as one; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, map_documents, prepared, stage, unused
from tradewinds.llm.text import CLEAN, Words, begins, blocks, chained, joined

#: 1 is looked at, 0 ignored.
PATTERNS = ("11110111", "1110100111", "100111111", "11011101001")
#: The shortest stretch that may hold substitutions.
SPAN = 12
#: The patterns at all their places in SPAN words. Any two words of SPAN are ignored by one of them.
MASKS = tuple("0" * k + p + "0" * (SPAN - len(p) - k) for p in PATTERNS for k in range(SPAN - len(p) + 1))
SHORTEST_ITEM = 5
WINDOW = 13
EQUAL = 0.8
#: Words kept on either side of a hit; a stretch of WINDOW words around it always fits.
MARGIN = 2 * WINDOW
TABLE_BITS = 2**23
#: The bits of a hash that say which bit of the table stands for it begin here; all have to be set.
TABLE_SHIFTS = (0, 20, 40)

_REGION = "doc_id bigint, region bigint, first bigint, words array<bigint>, seeds array<struct<at: int, hash: bigint>>"


def _words(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of the words of every text."""
    for _, block in blocks([(t or "").lower() for t in texts]):
        words = Words(CLEAN[joined(block)])
        hashes, at = words.hashes(), begins(block, words.starts)
        for begin, end in zip(at[:-1], at[1:]):
            yield hashes[begin:end]


def _window_hashes(words: np.ndarray) -> Iterator[np.ndarray]:
    """For every pattern a hash of each window of the words it spans."""
    for number, pattern in enumerate(PATTERNS):
        n = len(words) - len(pattern) + 1
        parts = [words[k:n + k] for k, c in enumerate(pattern) if c == "1"]
        yield chained([*parts, np.full(n, number, np.uint64)]) if n > 0 else words[:0]


def _whole_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    return chained([words[k:n + k] for k in range(size)]) if n > 0 else words[:0]


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for item, words in zip(batch["item_id"], _words(list(batch["text"]))):
            if len(words) >= SPAN:
                hashes, sizes = list(_window_hashes(words)), 0
            elif len(words) >= SHORTEST_ITEM:
                hashes, sizes = [_whole_hashes(words, len(words))], len(words)
            else:
                continue
            seeds = [(int(at), int(h)) for of_pattern in hashes for at, h in enumerate(of_pattern.view(np.int64))]
            rows.append((item, words.view(np.int64), sizes, seeds))
        yield pd.DataFrame(rows, columns=["item_id", "words", "whole", "seeds"])


def _regions(table: np.ndarray, sizes: list[int]):
    """Stretches of documents around windows whose hash may be the benchmark's."""
    mask = np.uint64(TABLE_BITS - 1)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows = []
            for doc_id, words in zip(batch["doc_id"], _words(list(batch["text"]))):
                at, found = [], []
                for hashes in [*_window_hashes(words), *(_whole_hashes(words, n) for n in sizes)]:
                    hits = np.arange(len(hashes))
                    for shift in TABLE_SHIFTS:
                        hits = hits[table[((hashes[hits] >> np.uint64(shift)) & mask).astype(np.int64)]]
                    at.append(hits)
                    found.append(hashes[hits])
                at, found = np.concatenate(at), np.concatenate(found).view(np.int64)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, found = at[order], found[order]
                cuts = np.flatnonzero(np.diff(at) > SPAN + 2 * MARGIN) + 1
                for some, those in zip(np.split(at, cuts), np.split(found, cuts)):
                    first = max(0, int(some[0]) - MARGIN)
                    rows.append((
                        doc_id, number, first, words[first:int(some[-1]) + SPAN + MARGIN].view(np.int64),
                        list(zip((some - first).tolist(), those.tolist())),
                    ))
                    number += 1
            yield pd.DataFrame(rows, columns=["doc_id", "region", "first", "words", "seeds"])

    return find


def stretch(doc: np.ndarray, item: np.ndarray, diagonal: int, whole: bool) -> tuple[int, int, int] | None:
    """The best stretch on a diagonal (doc position minus item position): start in doc, words, equal words."""
    first, last = max(0, diagonal), min(len(doc), diagonal + len(item))
    size = len(item) if whole else min(WINDOW, len(item))
    if last - first < size:
        return None
    same = np.concatenate([[0], np.cumsum(doc[first:last] == item[first - diagonal:last - diagonal])])
    counts = same[size:] - same[:-size]
    best = int(counts.argmax())
    need = size if whole else math.ceil(EQUAL * size)
    return (first + best, size, int(counts[best])) if counts[best] >= need else None


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            found = stretch(np.asarray(r.words), np.asarray(r.item_words), r.diagonal, r.whole > 0)
            if found:
                rows.append((r.doc_id, r.item_id, r.first + found[0], found[1], found[2]))
        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "word", "words", "equal"])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, word (position of the stretch), words, equal: one row per region and item."""
    prepared(docs.sparkSession)
    items = stage(
        benchmark.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("bigint").alias("item_id"))
        .agg(F.max("text").alias("text"))
        .mapInPandas(_items, "item_id bigint, words array<bigint>, whole int, seeds array<struct<at: int, hash: bigint>>"),
        "items",
    )
    seeds = items.select("item_id", "whole", F.explode("seeds").alias("seed")).select(
        "item_id", "whole", F.col("seed.at").alias("item_at"), F.col("seed.hash").alias("hash")
    )
    # At most TABLE_BITS / 64 rows, and the numbers 5 to 11, come to the driver.
    slots = [F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit(TABLE_BITS - 1)) for shift in TABLE_SHIFTS]
    cells = (
        seeds.select(F.explode(F.array(*slots)).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).collect()
    )
    packed = np.zeros(TABLE_BITS // 64, np.int64)
    for cell in cells:
        packed[cell["cell"]] = cell["bits"]
    bits = packed.astype("<i8").view(np.uint8)
    sizes = sorted(r.whole for r in items.select("whole").where("whole > 0").distinct().collect())

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _regions(np.unpackbits(bits, bitorder="little").view(bool), sizes)(batches)

    regions = stage(map_documents(documents(docs), find, _REGION), "regions")
    hits = regions.select("region", F.explode("seeds").alias("seed")).select(
        "region", F.col("seed.at").alias("at"), F.col("seed.hash").alias("hash")
    )
    candidates = (
        hits.join(seeds, "hash").select("region", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    )
    placed = (
        candidates.join(regions.select("region", "doc_id", "first", "words"), "region")
        .join(items.select("item_id", F.col("words").alias("item_words"), "whole"), "item_id")
        .select("doc_id", "first", "words", "item_id", "item_words", "whole", "diagonal")
    )
    return map_documents(placed, _verified, "doc_id bigint, item_id bigint, word bigint, words int, equal int")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_ids (sorted), most_equal for the documents that hold benchmark passages."""
    per_item = matches(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("equal").alias("equal"))
    return per_item.groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("item_ids"),
        F.max("equal").alias("most_equal"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that hold benchmark passages; rows without doc_id stay."""
    name = unused(docs, "__found")
    found = stage(
        matches(docs, benchmark).where("doc_id IS NOT NULL").select(F.col("doc_id").alias(name)).distinct(), "found"
    )
    return docs.join(found, F.col("doc_id").cast("bigint") == F.col(name), "left_anti")
