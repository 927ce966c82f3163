"""Hard negatives by segment summaries.

For an anchor and each of its positives (the best rows of its own label) the hard negatives are the best
rows of other labels whose score lies in a window below the positive's. Scores are inner products of
integer vectors, floor(scale * x).

Every vector is cut into `SEGMENTS` runs of components, and the mean and deviation (length of what is left
without the mean) of each run are stored with it. For two vectors the sum over runs of length * mean * mean,
plus or minus the sum of deviation * deviation, bounds their score from both sides (Cauchy-Schwarz in each
run). Pairs are filtered by the coarsest summaries first (the whole vector as one run), then by finer ones
(a parent's mean and deviation follow from its children's), and only what is left is scored exactly. A pair
stays while its bounds touch a window of its anchor above what the anchor has found there.

Anchors are cut into groups of `GROUP_ROWS` and rows into blocks of `BLOCK_ROWS`; a task compares one group
with one block, so a label may hold any share of the rows. Positives meet blocks of their own label only.
Only keys of more than one group or block (at most one for `BLOCK_ROWS` rows) are joined to the rows for
that, with a broadcast hint where they are counted to be few.

Bounds are compared with a slack above the rounding error and scores are integers, so the result is exact.

Defined cases: rows with a null vec_id, label or vector, an empty vector or one with null or non-finite
components take no part; vectors of different lengths never meet; rows that repeat a vec_id are candidates
each and one anchor (the smallest), and a row is never a candidate of an anchor of its own id; ties go to
the smaller vec_id; an anchor without positives, or a positive without negatives in its window, gives no
row; a score beyond 64 bits ends the query with an overflow error; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm.frames import prepared, stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Of a positive's score, in percent.
LOW, HIGH = 50, 95
#: Runs of the stored summaries, and how many of them make one on each level of the filter.
SEGMENTS = 16
LEVELS = (16, 4, 1)
GROUP_ROWS = 1_024
BLOCK_ROWS = 8_192
#: Keys of several groups or blocks that are broadcast at most.
BROADCAST_KEYS = 100_000
_CHUNK_ROWS = 1_024
_FIRST_ROWS = 64
_PAIRS = 65_536
#: Relative to the product of two lengths; rounding stays far below.
_SLACK = 1e-9
_MOST = 2**63 - 1

_SUMMARY = "vec_id bigint, label int, row bigint, size int, v array<bigint>, mean array<double>, deviation array<double>"
_FOUND = "anchor_id bigint, window int, vec_id bigint, score bigint"


def _runs(size: int) -> np.ndarray:
    """Borders of the runs; those of every fourth are those of a cut into fewer."""
    return np.arange(SEGMENTS + 1) * size // SEGMENTS


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every run of each row's components."""
    at = _runs(v.shape[1])
    mean, deviation = np.zeros((len(v), SEGMENTS)), np.zeros((len(v), SEGMENTS))
    for k, (begin, end) in enumerate(zip(at, at[1:])):
        if end > begin:
            part = v[:, begin:end].astype(np.float64)
            mean[:, k] = part.mean(1)
            deviation[:, k] = np.sqrt(((part - mean[:, k:k + 1]) ** 2).sum(1))
    return mean, deviation


def _stored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for size, rows in batch.groupby("size"):
            mean, deviation = summaries(np.stack(rows["v"]))
            yield rows.assign(mean=list(mean), deviation=list(deviation))


def summarised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """A written table of the rows that take part: vec_id, label, row, size, v (integers), mean, deviation."""
    prepared(embeddings.sparkSession)
    x = F.col("embedding").cast("array<double>")
    whole = (
        embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), x.alias("x"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND size(x) > 0")
        .where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
        .select(
            "vec_id", "label", F.monotonically_increasing_id().alias("row"), F.size("x").alias("size"),
            F.transform("x", lambda c: F.floor(c * scale)).alias("v"),
        )
    )
    return stage(whole.mapInPandas(_stored, _SUMMARY), "summaries")


class _Side:
    """Vectors of one side of a comparison, with their summaries on every level."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.whole = np.stack(rows["v"])
        self.v = self.whole.astype(np.float64)
        self.length = np.sqrt((self.v * self.v).sum(1))
        lengths = np.diff(_runs(self.v.shape[1])).astype(np.float64)
        mean, deviation = np.stack(rows["mean"]), np.stack(rows["deviation"])
        self.levels = []
        for n in LEVELS:
            own = lengths.reshape(-1, n).sum(1)
            total = (mean * lengths).reshape(len(mean), -1, n).sum(2)
            centre = np.divide(total, own, out=np.zeros_like(total), where=own > 0)
            apart = (mean - np.repeat(centre, n, axis=1)) ** 2 * lengths
            rest = (deviation**2 + apart).reshape(len(mean), -1, n).sum(2)
            self.levels.append((centre * np.sqrt(own), np.sqrt(rest)))


def _products(a: np.ndarray, b: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of the given pairs of rows: all at once where many of them are asked for."""
    if 8 * len(rows) > len(a) * len(b):
        return (a @ b.T)[rows, columns]
    out = np.empty(len(rows))
    for k in range(0, len(rows), _PAIRS):
        part = slice(k, k + _PAIRS)
        out[part] = np.einsum("ij,ij->i", a[rows[part]], b[columns[part]])
    return out


def _scores(a: _Side, b: _Side, part: slice, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact integer scores of the pairs of rows."""
    largest = a.length.max() * b.length[part].max()
    if largest < 2**52:
        return np.rint(_products(a.v, b.v[part], rows, columns)).astype(np.int64)
    whole = b.whole[part]
    return np.array([sum(int(x) * int(y) for x, y in zip(a.whole[i], whole[j])) for i, j in zip(rows, columns)], np.int64)


class _Best:
    """The `k` best (score, id) for each anchor in one of its windows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.need, self.high, self.k = low.copy(), high, k
        self.rows, self.scores, self.ids = (np.empty(0, np.int64) for _ in range(3))

    def touched(self, below: np.ndarray, above: np.ndarray, rows) -> np.ndarray:
        return (above >= self.need[rows]) & (below <= self.high[rows])

    def take(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.need[rows]) & (scores <= self.high[rows])
        if not inside.any():
            return
        rows, scores, ids = (
            np.concatenate([old, new[inside]]) for old, new in ((self.rows, rows), (self.scores, scores), (self.ids, ids))
        )
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < self.k
        self.rows, self.scores, self.ids = rows[kept], scores[kept], ids[kept]
        last = place[kept] == self.k - 1
        self.need[self.rows[last]] = self.scores[last]


def search(anchors: pd.DataFrame, block: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    """Up to `k` best rows of a block for each anchor and window, of its own label or of other ones.

    `anchors` has lists `low` and `high`, the borders of its windows.
    """
    # Long vectors first: they tend to have the high scores, which lets later ones be left out early.
    order = np.argsort([-float(np.dot(m, m) + np.dot(d, d)) for m, d in zip(block["mean"], block["deviation"])], kind="stable")
    block = block.iloc[order]
    a, b = _Side(anchors), _Side(block)
    ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
    own_ids, own_labels = anchors["anchor_id"].to_numpy(), anchors["label"].to_numpy()
    count = max(map(len, anchors["low"]))
    windows = []
    for j in range(count):
        low = np.array([x[j] if j < len(x) else _MOST for x in anchors["low"]], np.int64)
        high = np.array([x[j] if j < len(x) else -_MOST for x in anchors["high"]], np.int64)
        windows.append(_Best(low, high, k))
    begin, step = 0, _FIRST_ROWS
    while begin < len(ids):
        part = slice(begin, begin + step)
        allowed = (own_labels[:, None] == labels[None, part]) == same
        rows, columns = np.nonzero(allowed & (own_ids[:, None] != ids[None, part]))
        slack = _SLACK * a.length * b.length[part].max() + 1e-6
        for (a_mean, a_rest), (b_mean, b_rest) in zip(a.levels, b.levels):
            if not len(rows):
                break
            centre = _products(a_mean, b_mean[part], rows, columns)
            reach = _products(a_rest, b_rest[part], rows, columns) + slack[rows]
            stay = np.zeros(len(rows), bool)
            for window in windows:
                stay |= window.touched(centre - reach, centre + reach, rows)
            rows, columns = rows[stay], columns[stay]
        if len(rows):
            scores = _scores(a, b, part, rows, columns)
            for window in windows:
                window.take(rows, scores, ids[part][columns])
        begin, step = begin + step, min(2 * step, _CHUNK_ROWS)
    return pd.DataFrame({
        "anchor_id": np.concatenate([own_ids[w.rows] for w in windows]),
        "window": np.repeat(np.arange(count), [len(w.rows) for w in windows]).astype(np.int32),
        "vec_id": np.concatenate([w.ids for w in windows]),
        "score": np.concatenate([w.scores for w in windows]),
    })


def _meet(anchors: DataFrame, rows: DataFrame, by: list[str], same: bool, k: int, group_rows: int, block_rows: int) -> DataFrame:
    """What `search` finds for every group of anchors in every block of rows that have the same `by`."""
    groups = anchors.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("groups"))
    blocks = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    large = stage(groups.join(blocks, by).where("groups > 1 OR blocks > 1"), "large-keys")
    if large.count() <= BROADCAST_KEYS:
        large = F.broadcast(large)
    one = F.lit(1).cast("bigint")

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        """`df` with the number of its own part, repeated for each part of the other side."""
        sized = df.join(large, by, "left")
        parts, copies = F.coalesce(f"{own}s", one), F.coalesce(f"{other}s", one)
        return (
            sized.withColumn(own, F.pmod(F.xxhash64("row"), parts))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))).drop("groups", "blocks")
        )

    def work(_key, some: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if len(some) and len(block):
            return search(some, block, same, k)
        return pd.DataFrame({n: np.empty(0, np.int64) for n in ("anchor_id", "window", "vec_id", "score")})

    keys = [*by, "group", "block"]
    mine = cut(anchors, "group", "block")
    theirs = cut(rows, "block", "group").select(
        *keys, "vec_id", *([] if "label" in by else ["label"]), "v", "mean", "deviation"
    )
    return mine.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInPandas(work, _FOUND)


def _percent(score: Column, percent: int, up: bool) -> Column:
    """percent * score / 100, rounded to the integer above or below."""
    x = score.cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    return (F.ceil(x) if up else F.floor(x)).cast("bigint")


def hard_negatives(embeddings: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE, group_rows: int = GROUP_ROWS,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `embeddings` has vec_id, label and embedding; anchors are the rows where `is_anchor`, an expression over
    vec_id and label, holds.
    """
    rows = summarised(embeddings, scale)
    first = F.min(F.struct("label", "size", "v", "mean", "deviation", "row"))
    anchors = (
        rows.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id")).agg(first.alias("a"))
        .select("anchor_id", "a.*")
    )
    anchors = stage(anchors, "anchors")
    everything = {"low": F.array(F.lit(-_MOST)), "high": F.array(F.lit(_MOST))}
    near = _meet(anchors.withColumns(everything), rows, ["size", "label"], True, positives, group_rows, block_rows)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = stage(
        near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
        .select("anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # At most `positives` entries each.
    windows = (
        near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("w"))
        .select(
            "anchor_id",
            F.transform("w", lambda w: _percent(w["positive_score"], low, True)).alias("low"),
            F.transform("w", lambda w: _percent(w["positive_score"], high, False)).alias("high"),
        )
    )
    found = _meet(anchors.join(windows, "anchor_id"), rows, ["size"], False, negatives, group_rows, block_rows)
    best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (
        ranked.withColumn("place", F.col("window") + 1).join(near, ["anchor_id", "place"])
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
