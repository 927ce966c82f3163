"""Quality of documents: naive Bayes support vectors over n-gram indicators.

Features of a whole text are indicators of one to three words in a row, each word taken by its
shape (runs of small letters, capitals and digits as one character, marks as they are) and
by whether it repeats the word before it, and of single words themselves, all hashed into
`FEATURES` numbers. Every indicator is scaled by the log of the ratio of its share in the two
classes, rows have unit length, and a linear model with hinge loss is fitted by dual coordinate
descent. The score is the margin after logistic calibration on a fifth of the sample.

The model is fitted on a bounded sample: up to `SAMPLE_DOCS` labelled documents of each class,
those whose ids hash lowest, none of them held out.

Defined cases: null text is empty; the empty text has no features and the score of the offset;
where a class has no labelled document every score is that of the other (0.5 without any); labels
other than 0 and 1 are not learned from; a document with several labels is learned from with each;
rows that repeat get a row each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm.frames import documents, held_out, map_documents, prepared, sampled
from tradewinds.llm.linear import calibrated, hinge_by_dual_descent, sigmoid
from tradewinds.llm.text import Words, begins, blocks, chained, joined, word_hashes

SAMPLE_DOCS = 1_500
FEATURES = 2**18
SHAPES_IN_A_ROW = 3
SMOOTHING = 1.0
COST = 1.0

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")
_SHAPE[[9, 10, 11, 12, 13]] = ord(" ")


def features(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For every text the sorted numbers of the n-grams that it has."""
    for _, block in blocks(texts):
        plain, at = word_hashes(block)
        shape = _SHAPE[joined(block)]
        shape = Words(shape[np.concatenate([[True], shape[1:] != shape[:-1]])]).hashes()
        again = np.concatenate([[False], plain[1:] == plain[:-1]]).astype(np.uint64)
        again[at[:-1][at[:-1] < len(again)]] = 0
        shape = chained([shape, again])
        grams = [chained([shape[k:len(shape) - n + 1 + k] for k in range(n)]) if len(shape) >= n else shape[:0]
                 for n in range(1, SHAPES_IN_A_ROW + 1)]
        for begin, end in zip(at[:-1], at[1:]):
            own = [g[begin:max(begin, end - n)] for n, g in enumerate(grams)]
            yield np.unique(np.concatenate([plain[begin:end], *own]) % np.uint64(FEATURES)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # of every indicator, log ratio included
    ratios: np.ndarray
    slope: float
    offset: float

    def margin(self, row: np.ndarray) -> float:
        length = np.sqrt((self.ratios[row] ** 2).sum())
        return float(self.weights[row].sum() / length) if length else 0.0

    def score(self, row: np.ndarray) -> float:
        return float(sigmoid(self.slope * self.margin(row) + self.offset))


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "label": batch["label"],
            "row": [r.tobytes() for r in features(list(batch["text"]))],
        })


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 3, part: int = 1) -> Model:
    """A model of `labels` (doc_id and the label column, 0 or 1) from documents that are not held out."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("label IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"), parts, part))
        .withColumn("text", F.lit(""))
    )
    # At most 2 * SAMPLE_DOCS ids, so they can be sent to where the texts are.
    sample = sampled(known, SAMPLE_DOCS, "label").drop("text")
    drawn = (
        map_documents(documents(docs).join(F.broadcast(sample), "doc_id"), _rows, "doc_id bigint, label int, row binary")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label", "row").collect()
    )
    rows = [np.frombuffer(bytes(r.row), np.int32) for r in drawn]
    y = np.array([r.label for r in drawn], float)
    nothing = np.zeros(FEATURES, np.float32)
    if len(set(y)) < 2:
        return Model(nothing, nothing, 0.0, 0.0 if not len(y) else 40.0 * (2 * y[0] - 1))

    def learned(chosen: np.ndarray) -> Model:
        counts = {c: np.full(FEATURES, SMOOTHING) for c in (0, 1)}
        for i in chosen:
            counts[int(y[i])][rows[i]] += 1
        ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        scaled = []
        for i in chosen:
            values = ratios[rows[i]]
            scaled.append(values / max(1e-12, np.sqrt(values @ values)))
        signs = 2 * y[chosen] - 1
        share = np.maximum(1, np.array([(signs == s).sum() for s in signs]))
        weights = hinge_by_dual_descent([rows[i] for i in chosen], scaled, signs, FEATURES, COST * len(chosen) / 2 / share)
        return Model((weights * ratios).astype(np.float32), ratios.astype(np.float32), 1.0, 0.0)

    every = np.arange(len(rows))
    apart = every % 5 == 4
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart = every >= 0
        model = learned(every)
    else:
        model = learned(every[~apart])
    margins = np.array([model.margin(rows[i]) for i in every[apart]])
    model.slope, model.offset = calibrated(margins, y[apart])
    return model


def score(docs: DataFrame, model: Model, parts: int = 3, part: int = 1, label_from: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = np.array([model.score(r) for r in features(list(batch["text"]))], float)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores,
                "predicted": (scores >= label_from).astype(np.int32),
            })

    return map_documents(
        documents(docs).withColumn("held_out", held_out(F.col("doc_id"), parts, part)),
        scored, "doc_id bigint, held_out boolean, score double, predicted int"
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, that the model does not reject."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(r) >= 0.5 for r in features(batch["text"].to_pylist())], pa.bool_()))

    prepared(docs.sparkSession)
    return docs.mapInArrow(passing, docs.schema)
