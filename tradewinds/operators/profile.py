"""Building blocks of the profiles: frequencies, summaries, null counts, each over a table in one pass.

A profile is a long table of `section, item, value, text`; `section_of` gives a small
result that shape.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.operators.positions import percentiles

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def section_of(df: DataFrame, section: str, item: str | Column, value: str | Column | None = None,
               text: str | Column | None = None) -> DataFrame:
    def as_col(c: str | Column | None, kind: str) -> Column:
        c = F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c
        return c.cast(kind)

    return df.select(
        F.lit(section).alias("section"),
        as_col(item, "string").alias("item"),
        as_col(value, "double").alias("value"),
        as_col(text, "string").alias("text"),
    )


def value_counts(df: DataFrame, columns: dict[str, int | None]) -> DataFrame:
    """Frequencies of several columns in one pass; each column is a section, with its `n` most frequent values.

    Ties go by value; nulls are left out.
    """
    text = {name for name, kind in df.dtypes if kind == "string"}
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("section"), F.col(c).cast("string").alias("item"),
            (F.lit(None) if c in text else F.col(c)).cast("double").alias("number"),
        )
        for c in columns
    ])
    counts = (
        df.select(F.explode(entries).alias("e")).select("e.*").where(F.col("item").isNotNull())
        .groupBy("section", "item", "number").agg(F.count("*").alias("n"))
    )
    limits = F.create_map(*[F.lit(x) for c, n in columns.items() if n is not None for x in (c, n)])
    if any(n is not None for n in columns.values()):
        rank = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("n"), "number", "item"))
        most = max(n or 0 for n in columns.values())
        kept = [counts.where(F.col("section") == c) for c, n in columns.items() if n is None]
        limited = counts.where(F.col("section").isin([c for c, n in columns.items() if n is not None]))
        # The first comparison with a plain number lets every task keep that many rows before the shuffle.
        limited = limited.withColumn("rank", rank).where(F.col("rank") <= most)
        limited = limited.where(F.col("rank") <= F.try_element_at(limits, "section")).drop("rank")
        counts = reduce(DataFrame.unionByName, kept, limited)
    return counts.select("section", "item", F.col("n").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))


Facts = dict[tuple[str, str], Column]


def facts(df: DataFrame, values: Facts) -> DataFrame:
    """Aggregates of `df` in one pass, a row for each (section, item)."""
    row = df.agg(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values.values())])
    entries = F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), F.col(f"v{i}").alias("value"))
        for i, (section, item) in enumerate(values)
    ])
    return row.select(F.explode(entries).alias("e")).select("e.*", F.lit(None).cast("string").alias("text"))


def null_facts(df: DataFrame) -> Facts:
    return {("nulls", c): F.count("*") - F.count(c) for c in df.columns}


def summary_facts(columns: list[str]) -> Facts:
    """Count, mean, standard deviation, minimum and maximum per column; `quartiles` has the rest."""
    steps = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return {("describe", f"{c}.{name}"): f(c) for c in columns for name, f in steps.items()}


def quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact quartiles per column."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("grp"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    found = percentiles(df.select(F.explode(entries).alias("e")).select("e.*"), QUARTILES)
    return percentile_rows(found, list(QUARTILES), "describe")


def percentile_rows(wide: DataFrame, names: list[str], section: str) -> DataFrame:
    entries = F.array(*[
        F.struct(F.concat_ws(".", "grp", F.lit(n)).alias("item"), F.col(f"`{n}`").alias("value")) for n in names
    ])
    return section_of(wide.select(F.explode(entries).alias("e")).select("e.*"), section, "item", "value")
