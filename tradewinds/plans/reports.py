"""Daily reports, alerts and the ready-made questions about the raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.functions import dates, labels
from tradewinds.functions.numbers import percent, percent_change, ratio
from tradewinds.operators.days import ORDER_DAY, orders_between
from tradewinds.operators.joins import join_lines, of_orders
from tradewinds.operators.rollups import copies, payments_per_order, reviews_per_order
from tradewinds.plans.marts import daily_metrics
from tradewinds.tables import RawTables

# Alert limits and the rough conversion of the local currency.
REVENUE_DROP_PERCENT = -20
CANCEL_RATE_PERCENT = 5
INACTIVE_CUSTOMERS = 100
INACTIVE_DAYS = (60, 90)
USD_PER_BRL = 0.20


def daily_kpis(
    daily: DataFrame, features: DataFrame, products: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """One row: yesterday's sales, 7-day average, customer and product counts.

    `daily`, `features`, `products` are daily_metrics, customer_features and
    product_analytics.
    """
    today = dates.run_date(as_of)
    is_yesterday = F.col("order_date") == F.date_sub(today, 1)
    person = F.col("customer_unique_id")  # one row per customer in `features`
    champions = F.count(F.when(F.col("customer_segment") == "champions", person))
    at_risk = F.count(F.when(F.col("churn_risk").isin("high", "very_high"), person))
    customers = features.agg(F.struct(champions.alias("champions"), at_risk.alias("at_risk")).alias("c"))
    rated = products.agg(F.count_if(F.col("avg_review_score") >= 4.5))
    return (
        daily.where(F.col("order_date") >= F.date_sub(today, 7))
        .agg(
            F.coalesce(F.sum(F.when(is_yesterday, F.col("num_orders"))), F.lit(0)).alias("orders_yesterday"),
            F.sum(F.when(is_yesterday, F.col("total_revenue"))).alias("revenue_yesterday"),
            F.avg("total_revenue").alias("avg_revenue_7d"),
        )
        .withColumn("c", customers.scalar())
        .select(
            today.alias("report_date"),
            "orders_yesterday",
            "revenue_yesterday",
            "avg_revenue_7d",
            F.col("c.champions").alias("champions_count"),
            F.col("c.at_risk").alias("at_risk_customers"),
            rated.scalar().alias("top_rated_products"),
            F.current_timestamp().alias("generated_at"),
        )
    )


def top_products_daily(raw: RawTables, as_of: dt.date | None = None, n: int = 10) -> DataFrame:
    """Yesterday's delivered products with the highest revenue, ranked."""
    yesterday = F.date_sub(dates.run_date(as_of), 1)
    ids = orders_between(raw.orders, yesterday, yesterday).where(F.col("order_status") == "delivered").select("order_id")
    orders = ids.join(reviews_per_order(of_orders(raw.order_reviews, ids)), "order_id", "left")
    items = of_orders(raw.order_items.select("order_id", "product_id", "price"), ids)
    top = (
        join_lines(items, orders, "order_id")
        .groupBy("product_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum(F.col("price") * copies("n_reviews")).alias("revenue"),
            F.sum("score").alias("score"),
            F.sum("n_scores").alias("n_scores"),
        )
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
    )
    rank = F.row_number().over(Window.orderBy(F.desc("revenue"), "product_id"))
    return (
        top.withColumn("rank", rank)  # at most n rows here
        .join(raw.products.select("product_id", "product_category_name"), "product_id", "left")
        .join(raw.product_category_translation, "product_category_name", "left")
        .select(
            "rank",
            "product_id",
            F.col("product_category_name_english").alias("category"),
            "orders",
            "revenue",
            F.round(ratio(F.col("score"), F.col("n_scores")), 2).alias("avg_rating"),
            yesterday.alias("report_date"),
            F.current_timestamp().alias("generated_at"),
        )
        .orderBy("rank")
    )


def revenue_drop(daily: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Yesterday's revenue against the 7 days before it; no baseline, no alert."""
    today, day, revenue = dates.run_date(as_of), F.col("order_date"), F.col("total_revenue")
    before = day.between(F.date_sub(today, 8), F.date_sub(today, 2))
    return (
        daily.where(day.between(F.date_sub(today, 8), F.date_sub(today, 1)))
        .agg(
            F.coalesce(F.sum(F.when(day == F.date_sub(today, 1), revenue)), F.lit(0.0)).alias("yesterday"),
            F.avg(F.when(before, revenue)).alias("avg_7d_before"),
        )
        .withColumn("pct_change", percent_change(F.col("yesterday"), F.col("avg_7d_before")))
        .withColumn("alert", F.coalesce(F.col("pct_change") < REVENUE_DROP_PERCENT, F.lit(False)))
    )


def cancellation_rate(raw: RawTables, as_of: dt.date | None = None) -> DataFrame:
    """Share of yesterday's orders that were canceled."""
    yesterday = F.date_sub(dates.run_date(as_of), 1)
    canceled = F.count_if(F.col("order_status") == "canceled")
    return (
        orders_between(raw.orders, yesterday, yesterday)
        .agg(F.round(percent(canceled, F.count("*")), 2).alias("cancel_rate"))
        .withColumn("alert", F.coalesce(F.col("cancel_rate") > CANCEL_RATE_PERCENT, F.lit(False)))
    )


def last_orders(raw: RawTables, as_of: dt.date | None = None, days: int | None = None) -> DataFrame:
    """Per customer the days since the last delivered order, without the rest of the features.

    With `days` only customers whose last order is not older; older orders are not read.
    """
    orders = raw.orders
    if days is not None:
        first = F.date_sub(dates.run_date(as_of), days)
        orders = orders.where(F.col("order_purchase_timestamp") >= first.cast("timestamp"))
        if ORDER_DAY in orders.columns:
            orders = orders.where(F.col(ORDER_DAY) >= first)
    delivered = orders.where(F.col("order_status") == "delivered").select("customer_id", "order_purchase_timestamp")
    return (
        delivered.groupBy("customer_id").agg(F.max("order_purchase_timestamp").alias("last"))
        .join(raw.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id").agg(F.max(F.to_date("last")).alias("last"))
        .select("customer_unique_id", F.date_diff(dates.run_date(as_of), "last").alias("days_since_last_order"))
    )


def inactive_customers(features: DataFrame) -> DataFrame:
    """Customers whose last order is 60 to 90 days old, of customer_features or `last_orders`."""
    return (
        features.where(F.col("days_since_last_order").between(*INACTIVE_DAYS))
        .agg(F.count("*").alias("at_risk_count"))
        .withColumn("alert", F.col("at_risk_count") > INACTIVE_CUSTOMERS)
    )


def business_alerts(
    raw: RawTables, daily: DataFrame, features: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """The alerts that fire, as type, title and message."""

    def alert(df: DataFrame, kind: str, title: str, message: Column) -> DataFrame:
        return df.where("alert").select(
            F.lit(kind).alias("type"), F.lit(title).alias("title"), message.alias("message")
        )

    drop = F.format_string("Revenue dropped %.1f%% vs 7-day average", F.abs("pct_change"))
    rate = F.format_string("Cancellation rate at %s%% (threshold: 5%%)", F.col("cancel_rate").cast("string"))
    idle = F.format_string("%d customers at risk of churning (60-90 days inactive)", F.col("at_risk_count"))
    return (
        alert(revenue_drop(daily, as_of), "CRITICAL", "Revenue Drop Alert", drop)
        .unionByName(alert(cancellation_rate(raw, as_of), "WARNING", "High Cancellation Rate", rate))
        .unionByName(alert(inactive_customers(features), "INFO", "Churn Risk Alert", idle))
    )


def daily_report(kpis: DataFrame, alerts: DataFrame) -> DataFrame:
    """The newest KPI row with the list of alerts (three at most)."""
    entries = alerts.agg(F.sort_array(F.collect_list(F.struct("type", "title", "message"))))
    return kpis.orderBy(F.desc("report_date")).limit(1).withColumn("alerts", entries.scalar())


def top_cities(raw: RawTables, n: int = 10) -> DataFrame:
    return (
        raw.customers.groupBy("customer_city", "customer_state")
        .agg(F.count("*").alias("num_customers"))
        .orderBy(F.desc("num_customers"), "customer_city", "customer_state")
        .limit(n)
    )


def revenue_by_month(raw: RawTables, n: int = 12, usd_rate: float = USD_PER_BRL) -> DataFrame:
    """The newest `n` months of delivered and paid orders."""
    delivered = raw.orders.where(F.col("order_status") == "delivered").select(
        "order_id", dates.month_key(F.col("order_purchase_timestamp")).alias("year_month")
    )
    per_order = (
        delivered.join(payments_per_order(raw.order_payments), "order_id")
        .groupBy("order_id", "year_month")  # no shuffle after the join by order_id
        .agg(F.sum("paid").alias("paid"))
    )
    return (
        per_order.groupBy("year_month")
        .agg(F.count("*").alias("num_orders"), F.sum("paid").alias("total_revenue"))
        .withColumn("revenue_usd", F.col("total_revenue") * F.lit(usd_rate))
        .orderBy(F.desc("year_month"))
        .limit(n)
    )


def top_categories(raw: RawTables, n: int = 10) -> DataFrame:
    """Categories by number of orders; the local name where no English one exists."""
    product = raw.products.where(F.col("product_category_name").isNotNull()).select(
        "product_id", "product_category_name"
    )
    english = F.col("product_category_name_english")
    return (
        join_lines(raw.order_items.select("order_id", "product_id"), product, "product_id")
        .groupBy("product_category_name")
        .agg(F.count_distinct("order_id").alias("num_orders"))
        .join(raw.product_category_translation, "product_category_name", "left")
        .select(
            "product_category_name",
            "product_category_name_english",
            F.coalesce(F.nullif(english, F.lit("")), "product_category_name").alias("category"),
            "num_orders",
        )
        .orderBy(F.desc("num_orders"), "product_category_name")
        .limit(n)
    )


def volume_class(raw: RawTables, as_of: dt.date | None = None) -> DataFrame:
    """How many orders came yesterday and which processing that calls for."""
    yesterday = F.date_sub(dates.run_date(as_of), 1)
    return (
        orders_between(raw.orders, yesterday, yesterday)
        .agg(F.count("*").alias("order_count"))
        .withColumn("strategy", labels.volume_class(F.col("order_count")))
    )


def segment_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy("customer_segment").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "customer_segment"
    )


def latest_days(raw: RawTables, as_of: dt.date | None = None, n: int = 5) -> DataFrame:
    """daily_metrics of the newest `n` days with orders: the dates first, then nothing but their orders and children."""
    day = F.to_date("order_purchase_timestamp").alias(ORDER_DAY)
    newest = orders_between(raw.orders, None, dates.run_date(as_of)).select(day).distinct().orderBy(F.desc(ORDER_DAY)).limit(n)
    days = [r[0] for r in newest.collect() if r[0]]
    return daily_metrics(raw, as_of, days=days).orderBy(F.desc(ORDER_DAY))


def latest(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The `n` rows with the highest `by`."""
    return df.orderBy(F.desc(by), key).limit(n)


def orders_by_month(raw: RawTables) -> DataFrame:
    month = dates.month_key(F.col("order_purchase_timestamp")).alias("year_month")
    return raw.orders.groupBy(month).agg(F.count("*").alias("n")).orderBy("year_month")


def top_states(raw: RawTables, n: int = 10) -> DataFrame:
    """States by number of orders."""
    state = raw.customers.select("customer_id", "customer_state")
    return (
        raw.orders.select("customer_id")
        .join(state, "customer_id")
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "customer_state")
        .limit(n)
    )
