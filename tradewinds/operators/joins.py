"""Joins that survive a hot key, and the payment lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SPREAD = "__key_hash"


def join_lines(lines: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join many `lines` per key with `per_key` (inner, left, left_semi or left_anti).

    A key may own a large part of the lines. Adaptive execution splits such a
    partition, but only where both inputs come straight from a shuffle; a side that
    is already grouped by `key` would skip it. Joining on a hash of the key as well
    makes both sides shuffle, and costs a shuffle of `per_key`, which is much the smaller one.
    """
    left = lines.withColumn(_SPREAD, F.xxhash64(key))
    right = per_key.withColumn(_SPREAD, F.xxhash64(key))
    return left.join(right, [key, _SPREAD], how).drop(_SPREAD)


def of_orders(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """The lines whose order is among `ids`, a small part of all orders.

    Below the roll-up, so that Spark can broadcast the ids where they are small.
    """
    return lines.join(ids.select("order_id").distinct(), "order_id", "left_semi")


def one_payment(payments: DataFrame, mode: str = "sum") -> DataFrame:
    """One payment row per order: the sum of all, with the type of the first (lowest `payment_sequential`).

    `mode="first"` takes the first alone and leaves out the rest of a split payment.
    """
    if mode not in ("first", "sum"):
        raise ValueError(f"unknown mode {mode!r}")
    line = F.struct("payment_sequential", "payment_type", "payment_value")
    value = F.col("pick.payment_value") if mode == "first" else F.col("paid")
    return (
        payments.groupBy("order_id")
        .agg(F.min(line).alias("pick"), F.sum("payment_value").alias("paid"))
        .select("order_id", F.col("pick.payment_type").alias("payment_type"), value.alias("payment_value"))
    )


def latest_rows(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first `n` rows per key; each task keeps `n` per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
