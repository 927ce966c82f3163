"""Orders of a span of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.functions.dates import up_to_day

# The partition column of the copy that `writers.orders_partitioned` makes.
ORDER_DAY = "order_date"


def orders_between(orders: DataFrame, first: Column | None, last: Column) -> DataFrame:
    """Orders bought from day `first` (null: from the beginning) to day `last`.

    The days are a range of the timestamp, which prunes by file statistics, and of the
    partition column too where `orders` is the partitioned copy, which prunes folders.
    """
    stamp = F.col("order_purchase_timestamp")
    wanted = up_to_day(stamp, last)
    if first is not None:
        wanted &= stamp >= first.cast("timestamp")
    if ORDER_DAY in orders.columns:
        day = F.col(ORDER_DAY)
        wanted &= (day <= last) if first is None else day.between(first, last)
    return orders.where(wanted)


def orders_on(orders: DataFrame, days: list[dt.date]) -> DataFrame:
    """Orders bought on the given days: a range of the timestamp, and folders where `orders` is the partitioned copy."""
    stamp = F.col("order_purchase_timestamp")
    if not days:
        return orders.where(F.lit(False))
    wanted = F.to_date(stamp).isin(days) & (stamp >= F.lit(min(days)).cast("timestamp"))
    wanted &= stamp < F.lit(max(days) + dt.timedelta(days=1)).cast("timestamp")
    if ORDER_DAY in orders.columns:
        wanted &= F.col(ORDER_DAY).isin(days)
    return orders.where(wanted)
