"""CSV files into the declared schema, with rejected rows kept apart."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewinds import schemas
from tradewinds.sources.writers import publish, remove


@dataclass(frozen=True)
class CsvRules:
    """How far a file may depart from its schema."""

    quoted_newlines: bool = False
    short_rows: bool = False


# Reviews hold free text.
RULES = {"order_reviews": CsvRules(quoted_newlines=True, short_rows=True)}


class BadRecordLimit(ValueError):
    """More rows were rejected than the caller allows."""


@dataclass(frozen=True)
class Loaded:
    """What a load did: rows in the table, and rows in the table of rejects."""

    n_loaded: int
    n_rejected: int


def rules_of(table: str) -> CsvRules:
    return RULES.get(table, CsvRules())


def infer_csv(spark: SparkSession, path: str) -> DataFrame:
    """A file without a declared schema."""
    return spark.read.csv(path, header=True, inferSchema=True, multiLine=False, escape='"')


def read_csv(spark: SparkSession, path: str | list[str], table: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the raw table `table`, and the rejected rows (as text) with a `reason`."""
    records = _records(spark, path, table)
    good = records.where(F.col("reason").isNull()).select("row.*")
    rejects = records.where(F.col("reason").isNotNull()).select("text.*", "reason")
    return good, rejects


def rejects_path(target: str) -> str:
    return f"{target}__rejects"


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    target: str,
    max_bad_records: int | None = None,
    day: dt.date | None = None,
) -> Loaded:
    """Load files into the table at `target` (with `day`: its partition `load_date`), in place of what is there.

    Good rows get an `ingestion_timestamp`; every rejected row goes to the table at `rejects_path(target)` with
    its reason. With more than `max_bad_records` of them nothing is changed and `BadRecordLimit` raised. Rows are
    written once, counted as they are written, and published by renaming their folder.
    """
    records, counts = _records(spark, path, table), Observation()
    part = f"/load_date={day.isoformat()}" if day else ""
    bad = F.col("reason").isNotNull()
    written = f"{target}__loading-{uuid.uuid4().hex}"
    (
        records.observe(counts, F.count("*").alias("n"), F.count_if(bad).alias("bad"))
        .where(~bad).select("row.*", F.current_timestamp().alias("ingestion_timestamp"))
        .write.parquet(written)
    )
    n, n_bad = counts.get["n"], counts.get["bad"]
    if max_bad_records is not None and n_bad > max_bad_records:
        remove(spark, written)
        raise BadRecordLimit(f"{table}: {n_bad} bad rows, {max_bad_records} allowed")
    # The files are read again only for their rejects, if there are any.
    rejects = records.where(bad) if n_bad else records.limit(0)
    rejects.select("text.*", "reason").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        rejects_path(target) + part
    )
    publish(spark, written, target + part)
    return Loaded(n - n_bad, n_bad)


def _records(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """Every record as typed `row` and as `text`, with a `reason` where it is rejected.

    Fields are read as text and converted one by one, so that a bad value rejects its
    row with a reason instead of ending the read. With quoted newlines a file cannot be
    split, so such files should be cut to a size one task can read.
    """
    schema, rules = schemas.RAW[table], rules_of(table)
    names = schema.fieldNames()
    # With short rows allowed, `_extra` is one more field, filled by a row that is too
    # long; otherwise it takes the text of every row with a wrong number of fields.
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_extra"]])
    options = {} if rules.short_rows else {"columnNameOfCorruptRecord": "_extra"}
    rows = (
        spark.read.schema(text)
        .options(header=True, quote='"', escape='"', multiLine=rules.quoted_newlines,
                 columnPruning=False, **options)
        .csv(path)
    )
    # Columns of their own, so that a value is converted once for its row and its reason.
    kept = [f.name for f in schema.fields if f.dataType == T.StringType()]
    typed = {n: F.col(n if n in kept else f"__typed_{n}") for n in names}
    rows = rows.select(*names, "_extra", *[
        _convert(F.col(f.name), f.dataType).alias(f"__typed_{f.name}") for f in schema.fields if f.name not in kept
    ])
    reason = F.coalesce(
        F.when(F.col("_extra").isNotNull(), "wrong number of fields"),
        *[
            F.when(F.col(f.name).isNull(), f"missing {f.name}")
            for f in schema.fields
            if not f.nullable
        ],
        *[
            F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), f"bad {f.name}")
            for f in schema.fields
            if f.dataType != T.StringType()
        ],
    )
    return rows.select(
        F.struct(*[c.alias(n) for n, c in typed.items()]).alias("row"), F.struct(*names).alias("text"), reason.alias("reason")
    )


def _convert(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(value)
    return value if isinstance(kind, T.StringType) else value.try_cast(kind)
