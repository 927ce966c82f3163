"""Profiles of the raw tables, as long tables of section, item, value and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.functions import dates
from tradewinds.functions.numbers import percent
from tradewinds.operators.frames import stack
from tradewinds.operators.positions import percentiles
from tradewinds.operators.profile import (
    Facts,
    facts,
    null_facts,
    percentile_rows,
    quartiles,
    section_of,
    summary_facts,
    value_counts,
)
from tradewinds.plans.reports import USD_PER_BRL
from tradewinds.tables import RawTables


def _shape(df: DataFrame, **more: Column) -> Facts:
    shape = {"rows": F.count("*"), "columns": F.max(F.lit(len(df.columns))), **more}
    return {("shape", name): value for name, value in shape.items()}


def profile_customers(raw: RawTables) -> DataFrame:
    df = raw.customers
    people, ids = F.count_distinct("customer_unique_id"), F.count_distinct("customer_id")
    return stack([
        facts(df, {**_shape(df, unique_people=people, customer_ids=ids, difference=ids - people), **null_facts(df)}),
        value_counts(df, {"customer_state": 10, "customer_city": 10}),
    ])


def tolerant_timestamps(df: DataFrame) -> DataFrame:
    """Text columns named after a date or timestamp, parsed; null where that fails."""
    text = [n for n, kind in df.dtypes if kind == "string" and ("timestamp" in n or "date" in n)]
    return df.withColumns({n: F.try_to_timestamp(F.col(n)) for n in text}) if text else df


def profile_orders(raw: RawTables) -> DataFrame:
    df = tolerant_timestamps(raw.orders)
    purchase = F.col("order_purchase_timestamp")
    days = dates.floor_days(F.col("order_delivered_customer_date"), purchase).cast("double")
    delivery = df.select(F.lit("delivery_days").alias("grp"), days.alias("value"))
    about_days = {("delivery_days", name): f(days) for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))}
    span = df.agg(F.min(purchase).alias("first"), F.max(purchase).alias("last"))
    months = (
        df.groupBy(dates.month_key(purchase).alias("item"))
        .agg(F.count("*").alias("n"))
        .where(F.col("item").isNotNull())
        .orderBy(F.desc("item"))
        .limit(12)
    )
    return stack([
        facts(df, {**_shape(df), **about_days, **null_facts(df)}),
        value_counts(df, {"order_status": None}),
        section_of(span, "range", F.lit("first"), text=dates.iso_utc(F.col("first"))),
        section_of(span, "range", F.lit("last"), text=dates.iso_utc(F.col("last"))),
        section_of(months, "year_month", "item", "n"),
        percentile_rows(percentiles(delivery, {"median": 0.5}), ["median"], "delivery_days"),
    ])


def profile_items(raw: RawTables) -> DataFrame:
    df = raw.order_items
    money = ["price", "freight_value"]
    # How many orders have how many items: a few rows, from which the mean and the maximum follow too.
    sizes = df.groupBy("order_id").agg(F.count("*").alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    mean = F.sum(F.col("k") * F.col("n")) / F.sum("n")
    return stack([
        facts(df, {**_shape(df), **summary_facts(money)}),
        quartiles(df, money),
        facts(sizes, {("per_order", "mean"): mean, ("per_order", "max"): F.max("k")}),
        section_of(sizes.orderBy(F.desc("n"), "k").limit(10), "items_per_order", "k", "n"),
        value_counts(df, {"product_id": 10, "seller_id": 10}),
    ])


def profile_payments(raw: RawTables) -> DataFrame:
    df = raw.order_payments
    total = F.sum("payment_value")
    by_type = df.where(F.col("payment_type").isNotNull())
    values = by_type.groupBy("payment_type").agg(
        F.avg("payment_value").alias("mean"), F.count("payment_value").alias("n")
    )
    medians = percentiles(
        by_type.select(F.col("payment_type").alias("grp"), F.col("payment_value").alias("value")), {"median": 0.5}
    )
    return stack([
        facts(df, {
            **_shape(df), **summary_facts(["payment_value"]),
            ("revenue", "total"): total, ("revenue", "total_usd"): total * F.lit(USD_PER_BRL),
        }),
        value_counts(df, {"payment_type": None, "payment_installments": 15}),
        quartiles(df, ["payment_value"]),
        section_of(values, "mean_by_type", "payment_type", "mean"),
        section_of(values, "count_by_type", "payment_type", "n"),
        section_of(medians, "median_by_type", "grp", "median"),
    ])


def profile_reviews(raw: RawTables, examples: int = 3) -> DataFrame:
    """Scores, share of commented reviews, and the first comments with 1 and 5 stars."""
    df = raw.order_reviews
    rows, message = F.count("*"), F.col("review_comment_message")
    titles, messages = F.count("review_comment_title"), F.count("review_comment_message")
    preview = F.concat(F.substring(message, 1, 200), F.lit("..."))

    def comments(score: int) -> DataFrame:
        first = (
            df.where((F.col("review_score") == score) & message.isNotNull())
            .orderBy("review_id")
            .limit(examples)
        )
        return section_of(first, f"comments_{score}", "review_id", text=preview)

    return stack([
        facts(df, {
            **_shape(df),
            ("content", "mean_score"): F.avg("review_score"),
            ("content", "with_title"): titles,
            ("content", "with_title_pct"): percent(titles, rows),
            ("content", "with_message"): messages,
            ("content", "with_message_pct"): percent(messages, rows),
        }),
        value_counts(df, {"review_score": None}),
        comments(1),
        comments(5),
    ])


def profile_products(raw: RawTables) -> DataFrame:
    df = raw.products
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    return stack([
        facts(df, {**_shape(df, without_category=F.count("*") - F.count("product_category_name")), **summary_facts(sizes)}),
        value_counts(df, {"product_category_name": 20, "product_photos_qty": 10}),
        quartiles(df, sizes),
    ])


def profile_sellers(raw: RawTables) -> DataFrame:
    df = raw.sellers
    return stack([facts(df, _shape(df)), value_counts(df, {"seller_state": None, "seller_city": 15})])
