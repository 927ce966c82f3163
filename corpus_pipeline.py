"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last
return the columns of `documents`. `run` writes what a stage returns to the shared folder and reads it
again, so a stage starts from a table and a lost executor costs no earlier stage.

Defined cases: a null text counts as empty and is kept as null up to packing, where it is the closing id alone;
empty texts are linked with nothing, hold nothing and stay unless the classifier rejects them; very long texts are
taken whole; of rows that repeat a doc_id with the same text one stays, with other texts each that is no near
duplicate; rows without doc_id are linked with nothing and stay; of a group of equal or near documents the smallest
doc_id stays; columns beside doc_id, text and n_chars, whatever their names, pass all stages but the last unchanged;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.llm import decontaminate, neardup, packing, pii, quality
from tradewinds.llm.frames import stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of every group of near duplicates."""
    return neardup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs, pii.fit(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids and a checksum of these."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", good_quality),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", sequences),
]

# Learned models and tokenizers are not SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
