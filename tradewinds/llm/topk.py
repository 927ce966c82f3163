"""Exact top-k by inner product: norm-sorted blocks, SVD-rotated partial sums, residual bounds.

Vectors become integers, floor(64 * x). A rotation by the eigenvectors of their second-moment
matrix (the right singular vectors of the whole table) puts most of the length of a vector in
its first `HEAD` coordinates. Vectors are cut into blocks by descending length.

1. Every query meets the first block, the longest vectors; its k-th score there is a lower
   bound of its final k-th score.
2. A query needs another block only if |query| * (largest length in the block) reaches its
   bound, by Cauchy-Schwarz. Only such (query, block) pairs are formed.
3. In a block candidates are taken by descending length, chunk by chunk. A chunk is left out
   once |query| * length falls below the bound; for the others the partial sum of the first
   `HEAD` rotated coordinates plus the product of the lengths of the rests bounds the score, and
   only candidates that reach the bound get their integer score. The bound rises as scores come in.

Bounds are compared with a slack above the rounding error, so the result is exact. Scores are
integers; ties go to the smaller vec_id.

A block is split into tasks by block of queries (`QUERY_ROWS`) and block of candidates
(`BLOCK_ROWS`), so no task holds more than these. Nothing is broadcast but the rotation
matrix (dimension squared) and the block borders (one number per `BLOCK_ROWS` rows).

Defined cases: vectors that are null, or hold null or non-finite components, take no part,
nor do rows with a null vec_id or with another number of components than most rows have;
rows that repeat a vec_id are candidates each and one query (the smallest vector), and a query is
never its own candidate; fewer candidates than k give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.llm.frames import prepared, stage

K = 20
SCALE = 64
HEAD = 16
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
_CHUNK_ROWS = 1_024
#: Relative to |query| * |candidate|; rounding of 64 products stays far below.
_SLACK = 1e-9

_RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of floor(scale * x)), norm2 for the rows that take part."""
    prepared(embeddings.sparkSession)
    x = F.col("embedding").cast("array<double>")
    whole = (
        embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))
        .where("vec_id IS NOT NULL AND size(x) > 0")
        .where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    )
    return whole.withColumn(
        "norm2", F.aggregate("v", F.lit(0).cast("double"), lambda t, c: t + c.cast("double") * c.cast("double"))
    )


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task, the sum of outer products of its vectors, cell by cell."""
    total = None
    for batch in batches:
        if len(batch):
            v = np.stack(batch["v"]).astype(np.float64)
            total = v.T @ v + (0 if total is None else total)
    if total is not None:
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": total.ravel()})


def rotation(vectors: DataFrame, dimension: int) -> np.ndarray:
    """Columns: right singular vectors of the table, largest singular value first."""
    cells = vectors.mapInPandas(_moments, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros((dimension, dimension))
    for cell in cells:
        gram[cell.i, cell.j] = cell.x
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search(queries: pd.DataFrame, block: pd.DataFrame, turn: np.ndarray, k: int, head: int) -> pd.DataFrame:
    """Up to k best candidates of one block for every query (query_id, v, bound)."""
    block = block.sort_values(["norm2", "vec_id"], ascending=[False, True], kind="stable")
    ids, c = block["vec_id"].to_numpy(), np.stack(block["v"]).astype(np.float64)
    q = np.stack(queries["v"]).astype(np.float64)
    c_len, q_len = np.sqrt((c * c).sum(1)), np.sqrt((q * q).sum(1))
    c_turned, q_turned = c @ turn, q @ turn
    c_rest = np.sqrt((c_turned[:, head:] ** 2).sum(1))
    q_rest = np.sqrt((q_turned[:, head:] ** 2).sum(1))
    c_head, q_head = c_turned[:, :head], q_turned[:, :head]
    bounds = queries["bound"].to_numpy(np.float64, na_value=-np.inf).copy()
    query_ids = queries["query_id"].to_numpy()
    best_ids = [np.empty(0, np.int64) for _ in query_ids]
    best_scores = [np.empty(0, np.int64) for _ in query_ids]
    for start in range(0, len(ids), _CHUNK_ROWS):
        part = slice(start, start + _CHUNK_ROWS)
        slack = _SLACK * q_len * c_len[start] + 1e-6
        open_ = np.flatnonzero(q_len * c_len[start] + slack >= bounds)
        if not len(open_):
            break
        reach = q_head[open_] @ c_head[part].T + np.outer(q_rest[open_], c_rest[part]) + slack[open_, None]
        rows, columns = np.nonzero(reach >= bounds[open_, None])
        ends = np.searchsorted(rows, np.arange(len(open_) + 1))
        for n, row in enumerate(open_):
            picked = columns[ends[n]:ends[n + 1]] + start
            picked = picked[ids[picked] != query_ids[row]]
            if not len(picked):
                continue
            new_ids = np.concatenate([best_ids[row], ids[picked]])
            new_scores = np.concatenate([best_scores[row], np.rint(c[picked] @ q[row]).astype(np.int64)])
            top = _best(new_ids, new_scores, k)
            best_ids[row], best_scores[row] = new_ids[top], new_scores[top]
            if len(top) == k:
                bounds[row] = max(bounds[row], new_scores[top[-1]])
    return pd.DataFrame({
        "query_id": np.repeat(query_ids, list(map(len, best_ids))),
        "vec_id": np.concatenate([*best_ids, np.empty(0, np.int64)]),
        "score": np.concatenate([*best_scores, np.empty(0, np.int64)]),
    })


def _blocks(vectors: DataFrame, block_rows: int) -> DataFrame:
    """The vectors with `block`: 0 for the `block_rows` longest, and so on, by borders of the squared length.

    Borders are cut from counts per squared length, an integer; rows of one length may split
    at random by id, as any split of equal lengths is right.
    """
    rows = vectors.count()
    count = max(1, -(-rows // block_rows))
    if count == 1:
        return vectors.withColumn("block", F.lit(0))
    shares = [1 - n / count for n in range(1, count)]
    borders = vectors.select(F.percentile_approx("norm2", shares, 100 * count).alias("b")).first()["b"]
    block = F.size(F.filter(F.array(*map(F.lit, sorted(set(borders), reverse=True))), lambda b: F.col("norm2") < b))
    blocked = vectors.withColumn("block", block)
    # A length that very many share would make one large block: cut it by id.
    sizes = blocked.groupBy("block").count().withColumn("parts", F.ceil(F.col("count") / (2 * block_rows)).cast("int"))
    part = F.pmod(F.xxhash64("vec_id"), "parts")
    return blocked.join(sizes.drop("count"), "block").withColumn("part", part).drop("parts")


def top_k(embeddings: DataFrame, is_query, k: int = K, head: int = HEAD, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors for the rows where `is_query` holds."""
    vectors = integer_vectors(embeddings)
    usual = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = usual["n"] if usual else 1
    vectors = _blocks(stage(vectors.where(F.size("v") == dimension), "vectors"), block_rows)
    if "part" not in vectors.columns:
        vectors = vectors.withColumn("part", F.lit(0).cast("bigint"))
    vectors = stage(vectors, "blocks")
    turn, head = rotation(vectors, dimension), min(head, dimension)
    queries = vectors.where(is_query)
    groups = max(1, -(-queries.count() // query_rows))
    queries = (
        queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("v", "norm2")).alias("q"))
        .select("query_id", "q.v", "q.norm2", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group"))
    )

    def found(pairs: DataFrame) -> DataFrame:
        """`pairs`: queries with bound, block and part; each (group, block, part) is a task's work."""
        wanted = pairs.select("group", "block", "part").distinct().toDF("to", "block", "part")
        sent = vectors.join(wanted, ["block", "part"])

        def work(_key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            if len(q) and len(c):
                return _search(q, c, turn, k, head)
            return pd.DataFrame({n: np.empty(0, np.int64) for n in ("query_id", "vec_id", "score")})

        by = ("group", "block", "part")
        return (
            pairs.select(*by, "query_id", "v", "bound").groupBy(*by)
            .cogroup(sent.select("to", "block", "part", "vec_id", "v", "norm2").toDF(*by, "vec_id", "v", "norm2").groupBy(*by))
            .applyInPandas(work, _RESULT)
        )

    # One length and one number of parts for every `block_rows` vectors.
    lengths = vectors.groupBy("block").agg(F.max("norm2").alias("longest"), (F.max("part") + 1).alias("parts"))
    borders = sorted(lengths.collect(), key=lambda r: -r["longest"])
    if not borders:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    numbers, longest, parts = ([r[c] for r in borders] for c in ("block", "longest", "parts"))

    def meeting(queries: DataFrame, first: int, last) -> DataFrame:
        """A row for each query and each of the blocks from `first` to `last` by length."""
        n = F.explode(F.when(F.lit(first) <= last, F.sequence(F.lit(first), last)).otherwise(F.expr("CAST(array() AS array<int>)")))
        return (
            queries.withColumn("n", n)
            .withColumn("block", F.lit(numbers)[F.col("n")])
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts)[F.col("n")] - 1)))
        )

    seen = stage(found(meeting(queries.withColumn("bound", F.lit(None).cast("double")), 0, F.lit(0))), "found")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = (
        seen.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
        .select("query_id", F.col("score").cast("double").alias("bound"))
    )
    bounded = queries.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    reach = F.filter(F.lit(longest), lambda x: F.sqrt(F.col("norm2") * x) * (1 + _SLACK) + 1e-6 >= F.col("bound"))
    everything = seen
    if len(borders) > 1:
        everything = seen.union(found(meeting(bounded, 1, F.size(reach) - 1)))
    return (
        everything.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
