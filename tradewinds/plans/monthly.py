"""Monthly metrics of delivered orders with the payment looked up per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.functions.dates import month_key
from tradewinds.functions.numbers import ratio
from tradewinds.operators.joins import one_payment
from tradewinds.tables import RawTables


def parse_orders(orders: DataFrame) -> DataFrame:
    """Named fields with year and month; rows that lack a required field are dropped."""
    needed = ["order_id", "customer_id", "order_purchase_timestamp"]
    return orders.dropna(subset=needed).select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").alias("order_date"),
        F.year("order_purchase_timestamp").alias("year"),
        F.month("order_purchase_timestamp").alias("month"),
    )


def with_payment(orders: DataFrame, payments: DataFrame, mode: str = "sum") -> DataFrame:
    """Add the order's payment type and value; `no_payment` and 0 where it has none."""
    lookup = one_payment(payments, mode).withColumn("paid", F.lit(True))
    found = F.col("paid").isNotNull()
    return orders.join(lookup, "order_id", "left").select(
        *orders.columns,
        F.when(found, F.coalesce("payment_type", F.lit("unknown"))).otherwise("no_payment").alias("payment_type"),
        F.when(found, F.col("payment_value")).otherwise(0.0).alias("payment_value"),
    )


def order_payment_lookup(raw: RawTables, mode: str = "sum") -> DataFrame:
    """Delivered orders with all that was paid for them; `mode="first"` leaves out all but the first payment."""
    orders = raw.orders.where(F.col("order_status") == "delivered")
    return with_payment(parse_orders(orders), raw.order_payments, mode)


def monthly_metrics(raw: RawTables, mode: str = "sum") -> DataFrame:
    """Per month: orders, revenue, average order value; the maps drop out of the plan."""
    return monthly_histograms(raw, mode).select(
        "year_month", "total_orders", "total_revenue", "avg_order_value"
    )


def monthly_labels(raw: RawTables, mode: str = "sum") -> DataFrame:
    """Per month and label (a payment type or an order status): orders and revenue, as rows."""
    return (
        order_payment_lookup(raw, mode)
        .groupBy(month_key(F.col("order_date")).alias("year_month"), "payment_type", "order_status")
        .agg(F.count("*").alias("n"), F.sum("payment_value").alias("revenue"))
        .select(
            "year_month",
            "n",
            "revenue",
            F.explode(F.array(
                F.struct(F.lit("type").alias("kind"), F.col("payment_type").alias("label")),
                F.struct(F.lit("status").alias("kind"), F.coalesce("order_status", F.lit("unknown")).alias("label")),
            )).alias("e"),
        )
        .groupBy("year_month", "e.kind", "e.label")
        .agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"))
    )


def monthly_histograms(raw: RawTables, mode: str = "sum") -> DataFrame:
    """`monthly_metrics` with the number of orders per payment type and status as maps.

    A map holds one entry per label of the month; `monthly_labels` has the same as rows.
    """
    is_type = F.col("kind") == "type"

    def histogram(test):
        return F.map_from_entries(F.sort_array(F.collect_list(F.when(test, F.struct("label", "n")))))

    return (
        monthly_labels(raw, mode)
        .groupBy("year_month")
        .agg(
            F.sum(F.when(is_type, F.col("n"))).alias("total_orders"),
            F.sum(F.when(is_type, F.col("revenue"))).alias("total_revenue"),
            histogram(is_type).alias("payment_types"),
            histogram(~is_type).alias("order_statuses"),
        )
        .withColumn("avg_order_value", F.coalesce(ratio(F.col("total_revenue"), F.col("total_orders")), F.lit(0.0)))
    )
