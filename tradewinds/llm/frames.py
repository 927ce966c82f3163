"""What several operators need around their own work on DataFrames."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewinds.sources.staging import new_path, stage

__all__ = ["documents", "held_out", "map_documents", "new_path", "prepared", "sampled", "stage", "table", "unused"]

#: Rows of a batch that goes to Python: some are very long.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves `part` when divided by `parts`; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


_sent_by: set[str] = set()


def prepared(spark: SparkSession) -> None:
    """Bound the rows that one Python batch holds, and send this package to the executors once.

    The archive is the driver's own file, which Spark's file server hands to every executor.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    application = spark.sparkContext.applicationId
    if application in _sent_by:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _sent_by.add(application)


def map_documents(df: DataFrame, function, schema: str) -> DataFrame:
    """`mapInPandas` with doc_id, first in `schema`, carried as text: among nulls pandas would make it a float."""
    in_text = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = in_text.mapInPandas(function, schema.replace("doc_id bigint", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def sampled(df: DataFrame, rows: int, of: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Up to `rows` rows, for every value of `of` if given: those whose doc_id hashes lowest.

    A count (of `counted`, by default `df`) tells how low a hash must be for twice as many rows, so that
    only about these are ranked. Rows without doc_id or `of` are not taken. Needs a column `text`.
    """
    grain = 2**30
    whole = df if counted is None else counted
    if of is None:
        sized, by = df.withColumn("__n", F.lit(whole.count())), F.lit(0)
    else:
        # One number for every value: classes or languages, of which a model has few.
        sizes = whole.where(F.col(of).isNotNull()).groupBy(of).count().collect()
        if not sizes:
            return df.limit(0)
        count = F.create_map(*[F.lit(x) for r in sizes for x in (r[of], r["count"])])
        sized, by = df.where(F.col(of).isNotNull()).withColumn("__n", F.try_element_at(count, F.col(of))), F.col(of)
    low = F.pmod(F.xxhash64("doc_id"), F.lit(grain)) * F.col("__n").cast("double") < float(2 * rows * grain)
    order = Window.partitionBy(by).orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    return (
        sized.where(F.col("doc_id").isNotNull() & low).drop("__n")
        .withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= rows).drop("__rank")
    )


def unused(df: DataFrame, name: str) -> str:
    """`name`, made longer until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text (null: empty), and more columns; nothing else a caller's table may have."""
    prepared(df.sparkSession)
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)
