"""Checks of the raw tables and of what is built from them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds import schemas
from tradewinds.functions import dates
from tradewinds.functions.numbers import percent
from tradewinds.operators.joins import join_lines
from tradewinds.operators.days import orders_between
from tradewinds.operators.frames import stack
from tradewinds.tables import RawTables

# An order id is 32 letters or digits; a payment lies between these, exclusive.
ORDER_ID_LENGTH = 32
PAYMENT_RANGE = (0, 10000)

# Child table, key and parent table of each reference between raw tables.
REFERENCES = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its rows, and whether it has any."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") > 0).alias("not_empty")
        )
        for name, df in tables.items()
    ]
    return stack(counts)


def require_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """`row_counts`, failing where a table is empty."""
    counts = row_counts(tables)
    empty = [r["table_name"] for r in counts.where(~F.col("not_empty")).collect()]
    if empty:
        raise ValueError(f"empty tables: {', '.join(empty)}")
    return counts


def orders_gate(orders: DataFrame) -> DataFrame:
    """One row: not empty, required columns present, order ids unique; `passed` if all hold.

    Nulls in the required columns are counted and do not fail the gate.
    """
    missing = [c for c in schemas.GATE_COLUMNS if c not in orders.columns]
    present = [c for c in schemas.GATE_COLUMNS if c in orders.columns]
    if "order_id" in missing:
        rows = orders.agg(F.count("*").alias("total_orders")).withColumn(
            "duplicate_order_ids", F.lit(None).cast("bigint")
        ).withColumn("null_values", F.lit(None).cast("bigint"))
    else:
        nulls = reduce(Column.__add__, [F.col(c).isNull().cast("int") for c in present])
        rows = (
            orders.groupBy("order_id")
            .agg(F.count("*").alias("n"), F.sum(nulls).alias("nulls"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_order_ids"),
                F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
            )
        )
    passed = (F.col("total_orders") > 0) & (F.lit(len(missing)) == 0) & (F.col("duplicate_order_ids") == 0)
    return rows.withColumn("missing_columns", F.lit(",".join(missing))).withColumn(
        "passed", F.coalesce(passed, F.lit(False))
    )


def daily_load_check(orders: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Did any order of `day` arrive."""
    of_day = orders_between(orders, dates.run_date(day), dates.run_date(day))
    return of_day.agg((F.count("*") > 0).alias("arrived"))


def load_summary(orders: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Rows of one load (`load_date`) and of the whole table."""
    return orders.agg(
        F.count_if(F.col("load_date") == dates.run_date(day)).alias("rows_loaded"),
        F.count("*").alias("total_rows"),
    )


def schema_check(name: str, df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Per required column: is it there, and how many rows have a value in it."""
    required = required or schemas.required_columns(name)
    counts = df.agg(*[
        (F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(c) for c in required
    ])
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in df.columns).alias("present"),
            F.col(c).alias("n_values"),
        )
        for c in required
    ])
    return counts.select(F.lit(name).alias("table_name"), F.explode(entries).alias("e")).select(
        "table_name", "e.*"
    )


def freshness(orders: DataFrame) -> DataFrame:
    return orders.agg(F.max("order_purchase_timestamp").alias("last_order"))


def is_order_id(order_id: Column) -> Column:
    return F.coalesce(
        (F.length(order_id) == ORDER_ID_LENGTH) & order_id.rlike(r"^[\p{L}\p{N}]+\z"), F.lit(False)
    )


def is_payment_value(value: Column) -> Column:
    low, high = PAYMENT_RANGE
    return F.coalesce((value > low) & (value < high), F.lit(False))


def orphans(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Distinct keys of `child` that `parent` lacks."""
    keys = child.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(parent.select(key), key, "left_anti")


def orphan_orders(raw: RawTables) -> DataFrame:
    """How many orders have no customer."""
    return (
        raw.orders.select("customer_id")
        .join(raw.customers.select("customer_id"), "customer_id", "left_anti")
        .agg(F.count("*").alias("orphan_count"))
    )


def integrity_report(raw: RawTables) -> DataFrame:
    """Per reference between raw tables: distinct keys without a parent row."""
    return stack([
        orphans(getattr(raw, child), key, getattr(raw, parent))
        .agg(F.count("*").alias("orphan_keys"))
        .select(
            F.lit(child).alias("child"), F.lit(key).alias("key"), F.lit(parent).alias("parent"), "orphan_keys"
        )
        for child, key, parent in REFERENCES
    ])


def null_report(raw: RawTables) -> DataFrame:
    """Per table: missing cells and their share of all cells."""

    def one(name: str, df: DataFrame) -> DataFrame:
        # Counts per column first: `count` skips nulls and needs no expression per cell.
        filled = df.agg(F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in df.columns])
        cells = F.col("n_rows") * len(df.columns)
        present = reduce(Column.__add__, [F.col(c) for c in df.columns])
        return filled.select(
            F.lit(name).alias("table_name"),
            (cells - present).alias("null_cells"),
            percent(cells - present, cells).alias("null_pct"),
        )

    return stack([one(name, df) for name, df in raw.items()])


def duplicate_report(raw: RawTables) -> DataFrame:
    """Per table: rows that repeat an earlier row in every column, and their share.

    Rows are first counted by a 128-bit hash; only rows whose hash repeats are compared in full.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        hashed = df.withColumns({"__a": F.xxhash64(*df.columns), "__b": F.xxhash64(F.lit(name), *df.columns)})
        counts = hashed.groupBy("__a", "__b").agg(F.count("*").alias("n"))
        repeated = join_lines(hashed, counts.where("n > 1").select("__a", F.col("__b").alias("__c")), "__a")
        copies = repeated.where("__b = __c").groupBy(*df.columns).agg(F.count("*").alias("copies"))
        surplus = copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)))
        return counts.agg(F.sum("n").alias("n")).withColumn("duplicate_rows", surplus.scalar()).select(
            F.lit(name).alias("table_name"),
            "duplicate_rows",
            percent(F.col("duplicate_rows"), F.col("n")).alias("duplicate_pct"),
        )

    return stack([one(name, df) for name, df in raw.items()])
