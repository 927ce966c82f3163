"""`daily_metrics` kept in a table: a run rebuilds the days that changed and leaves the others.

A day is one row, so the table has a folder for each month and not for each day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.operators.days import ORDER_DAY
from tradewinds.plans.marts import daily_metrics, day_tables
from tradewinds.sources.staging import stage
from tradewinds.sources.writers import read_newest, remove, replace_days
from tradewinds.tables import RawTables

MONTH = "order_month"


def changed_days(raw: RawTables, loaded: dict[str, DataFrame]) -> list[dt.date]:
    """Purchase days of the orders that have rows in `loaded` (raw table name -> rows of a load).

    A row of orders, payments or items changes the day of its order, one of customers the days of all orders
    of the customer. An order that moves to another day needs its earlier row among the loaded ones too.
    """
    ids = [loaded[t].select("order_id") for t in ("orders", "order_payments", "order_items") if t in loaded]
    day = F.to_date("order_purchase_timestamp").alias(ORDER_DAY)
    found = [loaded["orders"].select(day)] if "orders" in loaded else []
    for rows in ids:
        found.append(raw.orders.join(rows.distinct(), "order_id", "left_semi").select(day))
    if "customers" in loaded:
        people = loaded["customers"].select("customer_id").distinct()
        found.append(raw.orders.join(people, "customer_id", "left_semi").select(day))
    every = None
    for days in found:
        every = days if every is None else every.unionByName(days)
    # One row per day of the calendar.
    return sorted(r[ORDER_DAY] for r in every.distinct().collect() if r[ORDER_DAY]) if every is not None else []


def build_daily_metrics(raw: RawTables, path: str, as_of: dt.date | None = None, grain_safe: bool = False) -> None:
    """Write all days, in a folder for each month."""
    _replace_months(daily_metrics(raw, as_of, grain_safe=grain_safe, run=day_tables(raw, as_of)), path)


def update_daily_metrics(
    raw: RawTables, path: str, loaded: dict[str, DataFrame], as_of: dt.date | None = None, grain_safe: bool = False
) -> list[dt.date]:
    """Bring the table at `path` up to date with `raw`, of which `loaded` is new; the days that were rebuilt.

    Only orders of these days and their children are read (their folders alone where orders are the copy
    partitioned by day), and only the months they lie in are written.
    """
    days = changed_days(raw, loaded)
    if not days:
        return days
    spark = raw.orders.sparkSession
    months = sorted({f"{day:%Y-%m}" for day in days})
    stored = spark.read.parquet(path)
    # Where most days change, nearly all payments and items are theirs.
    run = day_tables(raw, as_of, days, few=2 * len(days) < stored.count())
    rebuilt = daily_metrics(raw, as_of, days=days, grain_safe=grain_safe, run=run)
    others = stored.where(F.col(MONTH).isin(months) & ~F.col(ORDER_DAY).isin(days)).drop(MONTH)
    # The rows to write are read from the months that they replace.
    merged = stage(others.unionByName(rebuilt), "months")
    _replace_months(merged, path)
    # A month without days left has no row that could replace its folder.
    kept = {f"{r[0]:%Y-%m}" for r in merged.select(F.trunc(ORDER_DAY, "month")).distinct().collect()}
    for month in set(months) - kept:
        remove(spark, f"{path}/{MONTH}={month}")
    return days


def _replace_months(rows: DataFrame, path: str) -> None:
    replace_days(rows.withColumn(MONTH, F.date_format(ORDER_DAY, "yyyy-MM")), path, MONTH)


def latest_daily_metrics(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The newest `n` days of the table; of its folders only the newest `n`, each of which has a day or more, are opened."""
    return read_newest(spark, path, MONTH, n).drop(MONTH).orderBy(F.desc(ORDER_DAY)).limit(n)
