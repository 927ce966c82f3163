"""Windowed metrics of events; the same code serves a stream and a bounded table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.functions.dates import iso_utc
from tradewinds.functions.numbers import money_mean
from tradewinds.operators.rollups import rollup_with_members

MINUTE, FIVE_MINUTES = "60 seconds", "5 minutes"
#: Minutes of a rolling window.
PANES = 5


def realtime_metrics(events: DataFrame, delay: str = "0 seconds", time_col: str = "event_ts") -> DataFrame:
    """Per event type and minute: events, revenue, average, customers, orders.

    `delay` is how long a stream waits for late events; later ones are dropped.
    `time_col` may be "processing_ts" for windows by arrival.
    """
    framed = _timed(events, delay, time_col).select(
        F.window(time_col, MINUTE).alias("window"), "event_type", "customer_id", "order_id", F.lit(1).alias("event_count"),
        F.coalesce("payment_value", F.lit(0.0)).alias("revenue"),
    )
    return _metrics(_totals(framed, ["event_type"]), ["event_type"])


def rolling_metrics(events: DataFrame, delay: str = "0 seconds", time_col: str = "event_ts") -> DataFrame:
    """Every minute, the totals of the last five minutes.

    Events are first grouped into panes of a minute, by customer and order, so no event is copied into the
    five windows that it belongs to.
    """
    pane = F.window(time_col, MINUTE).alias("pane")
    panes = _timed(events, delay, time_col).groupBy(pane, "customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(F.coalesce("payment_value", F.lit(0.0))).alias("revenue")
    )
    if not events.isStreaming:
        return _metrics(_over_panes(panes), [])
    framed = panes.select(F.window("pane", FIVE_MINUTES, MINUTE).alias("window"), "customer_id", "order_id", "event_count", "revenue")
    return _metrics(_totals(framed, []), [])


def _timed(events: DataFrame, delay: str, time_col: str) -> DataFrame:
    return events.withWatermark(time_col, delay) if events.isStreaming else events


def _totals(framed: DataFrame, keys: list[str]) -> DataFrame:
    return rollup_with_members(
        framed,
        ["window", *keys],
        members={"unique_customers": F.col("customer_id"), "unique_orders": F.col("order_id")},
        sums={"event_count": F.col("event_count"), "revenue": F.col("revenue")},
        count_missing=True,
    )


def _over_panes(panes: DataFrame) -> DataFrame:
    """Totals of five panes in a row, from one row per minute.

    A window counts a member in the last of its panes that the member has. So a pane adds to the window that
    ends `d` minutes after it those of its members that come back later than in `d` minutes, or never.
    """
    member = F.explode(F.array(
        F.struct(F.lit(True).alias("customer"), F.col("customer_id").alias("member")),
        F.struct(F.lit(False).alias("customer"), F.col("order_id").alias("member")),
    )).alias("m")
    # At most a row per minute for a member, however many events it has.
    seen = (
        panes.select(F.col("pane.start").alias("minute"), member, "event_count", "revenue")
        .groupBy("minute", "m.customer", "m.member")
        .agg(F.sum("event_count").alias("event_count"), F.sum("revenue").alias("revenue"))
    )
    back = F.lead("minute").over(Window.partitionBy("customer", "member").orderBy("minute"))
    away = F.coalesce((F.unix_seconds(back) - F.unix_seconds("minute")) / 60, F.lit(float(PANES)))
    customer = F.col("customer")
    minutes = seen.withColumn("away", away).groupBy("minute").agg(
        F.sum(F.when(customer, F.col("event_count"))).alias("event_count"),
        F.sum(F.when(customer, F.col("revenue"))).alias("revenue"),
        *[
            F.array(*[F.count_if(kind & (F.col("away") > d)) for d in range(PANES)]).alias(name)
            for name, kind in (("customers", customer), ("orders", ~customer))
        ],
    )
    start = F.col("minute") - F.make_interval(mins=F.lit(PANES - 1) - F.col("d"))
    return (
        minutes.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(PANES - 1))))
        .groupBy(start.alias("start"))
        .agg(
            F.sum("event_count").alias("event_count"), F.sum("revenue").alias("revenue"),
            F.sum(F.get("customers", "d")).alias("unique_customers"), F.sum(F.get("orders", "d")).alias("unique_orders"),
        )
        .withColumn("window", F.struct("start", (F.col("start") + F.expr(f"INTERVAL {FIVE_MINUTES}")).alias("end")))
    )


def _metrics(totals: DataFrame, keys: list[str]) -> DataFrame:
    return totals.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.current_timestamp().alias("processing_ts"),
        "event_count",
        F.round("revenue", 2).alias("total_revenue"),
        money_mean(F.col("revenue"), F.col("event_count")).alias("avg_order_value"),
        "unique_customers",
        "unique_orders",
    )


def metric_rows(metrics: DataFrame) -> DataFrame:
    """Sink form: times as ISO text."""
    return metrics.select(*[
        iso_utc(F.col(n)).alias("processing_timestamp" if n == "processing_ts" else n) if kind == "timestamp"
        else F.col(n)
        for n, kind in metrics.dtypes
    ])
