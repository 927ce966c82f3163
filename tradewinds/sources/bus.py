"""The stream of order events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_bus(spark: SparkSession, source: str, options: dict[str, str] | None = None,
             path: str | None = None) -> DataFrame:
    """A streaming DataFrame with the message in `value`.

    `source` is a message bus format such as "kafka" with its `options`, or "text" for
    JSON-lines files arriving in `path`.
    """
    reader = spark.readStream.format(source).options(**(options or {}))
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same messages as a bounded DataFrame."""
    return spark.read.text(path)
