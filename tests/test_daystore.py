"""daily_metrics kept in a table: rebuilt days, untouched days, days that empty; the newest folders alone are read."""

from __future__ import annotations

import dataclasses
import datetime as dt

from conftest import rows, ts
from pyspark.sql import functions as F

from tradewinds.plans import daystore, features, marts, reports
from tradewinds.sources import writers

AS_OF = dt.date(2024, 1, 10)


def stored(spark, path):
    return spark.read.parquet(path).drop(daystore.MONTH)


def full(raw):
    return rows(marts.daily_metrics(raw, AS_OF), *sorted(marts.daily_metrics(raw, AS_OF).columns))


def same(spark, path, raw):
    df = stored(spark, path)
    assert rows(df, *sorted(df.columns)) == full(raw)


def test_update_equals_a_full_build(spark, small, tmp_path):
    path = str(tmp_path / "daily")
    late = {"orders": F.col("order_id").isin("o7", "o2"), "order_payments": F.col("order_id") == "o4", "order_items": F.col("order_id") == "o1"}
    every = dict(small.items())
    before = dataclasses.replace(small, **{t: every[t].where(~c) for t, c in late.items()})
    daystore.build_daily_metrics(before, path, AS_OF)
    same(spark, path, before)
    days = daystore.update_daily_metrics(small, path, {t: every[t].where(c) for t, c in late.items()}, AS_OF)
    assert days == [dt.date(2024, 1, d) for d in (1, 3, 9)] or dt.date(2024, 1, 1) in days
    same(spark, path, small)
    assert daystore.update_daily_metrics(small, path, {}, AS_OF) == []


def test_changed_customers_and_emptied_days(spark, small, table, tmp_path):
    path = str(tmp_path / "daily")
    daystore.build_daily_metrics(small, path, AS_OF)
    moved = small.customers.withColumn("customer_state", F.when(F.col("customer_id") == "c1", "XX").otherwise(F.col("customer_state")))
    # o6 moves to another month and leaves its day empty
    orders = small.orders.withColumn("order_purchase_timestamp", F.when(
        F.col("order_id") == "o6", F.lit(ts("2023-12-30 10:00:00"))).otherwise(F.col("order_purchase_timestamp")))
    raw = dataclasses.replace(small, customers=moved, orders=orders)
    loaded = {
        "customers": moved.where("customer_id = 'c1'"),
        "orders": orders.where("order_id = 'o6'").unionByName(small.orders.where("order_id = 'o6'")),
    }
    daystore.update_daily_metrics(raw, path, loaded, AS_OF)
    same(spark, path, raw)


def test_update_reads_the_changed_days_only(spark, small, tmp_path):
    by_day = dataclasses.replace(small, orders=writers.orders_partitioned(small.orders, str(tmp_path / "orders")))
    df = marts.daily_metrics(by_day, AS_OF, days=[dt.date(2024, 1, 3)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line and "order_date" in line]
    assert filters and all("order_date" in line.split("PartitionFilters:")[1].split("]")[0] for line in filters)
    assert rows(df, "order_date", "num_orders") == [(dt.date(2024, 1, 3), 1)]


def test_newest_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.range(40).select(F.col("id"), F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("day"))
    df.unionByName(spark.sql("SELECT 99L AS id, CAST(NULL AS DATE) AS day")).write.partitionBy("day").parquet(path)
    assert writers.partitions(spark, path, "day")[:2] == ["2024-02-09", "2024-02-08"]
    newest = writers.read_newest(spark, path, "day", 3)
    assert rows(newest, "id") == [(37,), (38,), (39,)]
    assert {f.rsplit("/", 2)[-2] for f in newest.inputFiles()} == {f"day=2024-02-0{d}" for d in (7, 8, 9)}
    # only these are opened for the statistics too
    assert rows(writers.partition_stats(spark, path, "day", 2), "total_rows") == [(1,), (1,)]


def test_latest_days_and_last_orders(spark, small):
    want = rows(marts.daily_metrics(small, AS_OF).orderBy(F.desc("order_date")).limit(2), "order_date", "num_orders", "total_revenue")
    assert rows(reports.latest_days(small, AS_OF, 2), "order_date", "num_orders", "total_revenue") == want
    later = dt.date(2024, 3, 10)
    for days in (None, 90):
        assert reports.inactive_customers(reports.last_orders(small, later, days)).first().at_risk_count == \
            reports.inactive_customers(features.customer_features(small, later)).first().at_risk_count
    plan = reports.last_orders(small, later, 90)._jdf.queryExecution().optimizedPlan().toString()
    assert "order_purchase_timestamp" in plan and ">=" in plan


def test_scores_are_those_of_the_features(small):
    names = ["customer_unique_id", "days_since_last_order", "churn_risk", "customer_segment"]
    assert rows(features.customer_scores(small, AS_OF), *names) == rows(features.customer_features(small, AS_OF), *names)


def test_days_are_counted_without_copies_of_orders(spark, small, tmp_path):
    """Distinct counts beside the sums copy no row, and orders that repeat or all change give what a full build gives."""
    twice = dataclasses.replace(small, orders=small.orders.unionAll(small.orders))
    path = str(tmp_path / "daily")
    daystore.build_daily_metrics(small, path, AS_OF)
    days = daystore.update_daily_metrics(twice, path, {"orders": small.orders}, AS_OF)
    assert 2 * len(days) >= spark.read.parquet(path).count()
    same(spark, path, twice)
    df = marts.daily_metrics(small, AS_OF, run=marts.day_tables(small, AS_OF))
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    few = marts.day_tables(small, AS_OF, [dt.date(2024, 1, 3)])
    assert rows(few.orders, "order_id", "n_items") == [("o4", 1)]
    assert rows(few.lines, "order_id") == [("o4",)]
