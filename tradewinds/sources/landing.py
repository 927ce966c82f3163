"""The landing folder: dated CSV files, their completeness, and loads into the raw layer."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds import schemas
from tradewinds.operators.frames import side_by_side
from tradewinds.sources.csv import BadRecordLimit, Loaded, infer_csv, load_csv
from tradewinds.sources.writers import overwrite


def landing_path(root: str, day: dt.date, stem: str) -> str:
    return f"{root}/{day.isoformat()}/{stem}.csv"


def daily_stems(prefix: str = "") -> list[str]:
    """File stems of the tables a daily run needs."""
    return [f"{prefix}{table}_dataset" for table in schemas.DAILY_TABLES]


def missing_files(spark: SparkSession, root: str, day: dt.date, prefix: str = "") -> DataFrame:
    """Required files of a day that have not landed, as `path`."""
    folder = f"{root}/{day.isoformat()}"
    expected = spark.createDataFrame([(f"{s}.csv",) for s in daily_stems(prefix)], "file string")
    path = F.concat(F.lit(f"{folder}/"), "file").alias("path")
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException:  # no such folder
        return expected.select(path)
    # Only the names are read, not the content.
    landed = listing.select(F.regexp_extract("path", r"([^/]+\.csv)(/[^/]*)?$", 1).alias("file")).distinct()
    return expected.join(landed, "file", "left_anti").select(path)


def require_files(spark: SparkSession, root: str, day: dt.date, prefix: str = "") -> None:
    missing = [r["path"] for r in missing_files(spark, root, day, prefix).collect()]
    if missing:
        raise FileNotFoundError(f"missing {len(missing)} required files: {', '.join(missing)}")


def load_all(
    spark: SparkSession, files: dict[str, str], target: str, max_bad_records: dict[str, int] | None = None
) -> DataFrame:
    """Load files (stem -> path) into tables below `target`; a failed one is reported.

    A stem without a declared schema is loaded under its own name with an inferred one. Rejected rows are
    counted and kept (`csv.rejects_path`); `max_bad_records` limits them by table.
    """
    limits = max_bad_records or {}

    def load(stem: str, path: str) -> tuple:
        table = schemas.table_of(stem)
        try:
            if table in schemas.RAW:
                done = load_csv(spark, path, table, f"{target}/{table}", limits.get(table))
            else:
                overwrite(infer_csv(spark, path), f"{target}/{table}")
                done = Loaded(spark.read.parquet(f"{target}/{table}").count(), 0)
            return table, True, done.n_loaded, done.n_rejected, None
        except (PySparkException, BadRecordLimit) as error:
            return table, False, None, None, str(error).splitlines()[0]

    results = side_by_side(spark, [partial(load, stem, path) for stem, path in files.items()])
    return spark.createDataFrame(
        results, "table_name string, loaded boolean, n_loaded bigint, n_rejected bigint, error string"
    )


def load_day(
    spark: SparkSession, root: str, day: dt.date, target: str, prefix: str = "", max_bad_records: dict[str, int] | None = None
) -> dict[str, DataFrame]:
    """Load the required files of a day into partition `load_date` of their tables.

    A second run for the same day replaces that partition and leaves the others.
    """
    require_files(spark, root, day, prefix)
    loaded = {}
    for stem in daily_stems(prefix):
        table, limits = schemas.table_of(stem), max_bad_records or {}
        load_csv(spark, landing_path(root, day, stem), table, f"{target}/{table}", limits.get(table), day)
        loaded[table] = spark.read.parquet(f"{target}/{table}")
    return loaded
