"""One row per order for each child table of orders.

The analytics tables join orders with payments, items and reviews at once, so a sum
over payments counts each payment once per item and review of its order. Joining the
rolled-up children and multiplying by their row counts gives the same sums without
ever building those combinations, and a shuffle moves one row per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.functions.numbers import unit_squares, units

# The payment types that have columns of their own.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")


def payments_per_order(payments: DataFrame) -> DataFrame:
    value, kind = F.col("payment_value"), F.col("payment_type")
    return payments.groupBy("order_id").agg(
        F.count("*").alias("n_payments"),
        F.count(value).alias("n_payment_values"),
        F.sum(value).alias("paid"),
        F.count(units(value)).alias("n_paid_units"),
        F.try_sum(units(value)).alias("paid_units"),
        F.try_sum(unit_squares(value)).alias("paid_unit_squares"),
        F.min(value).alias("paid_min"),
        F.max(value).alias("paid_max"),
        F.count("payment_installments").alias("n_installments"),
        F.sum("payment_installments").alias("installments"),
        F.max("payment_installments").alias("max_installments"),
        *[F.count_if(kind == name).alias(f"n_{name}") for name in PAYMENT_TYPES],
        *[F.sum(F.when(kind == name, value)).alias(f"{name}_amount") for name in PAYMENT_TYPES],
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("n_items"),
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("n_reviews"),
        F.count("review_id").alias("n_review_ids"),
        F.count(score).alias("n_scores"),
        F.sum(score).alias("score"),
        F.sum(score * score).alias("score_squares"),
        F.max(score).alias("max_score"),
        F.max("review_comment_message").alias("max_message"),
    )


def copies(n: str, inflate: bool = True) -> Column:
    """How often a left join with a child repeats the order's row."""
    return F.greatest(F.coalesce(F.col(n), F.lit(0)), F.lit(1)) if inflate else F.lit(1)


def count_of(n: str) -> Column:
    return F.coalesce(F.col(n), F.lit(0))


def rollup_with_members(
    df: DataFrame,
    keys: list[str],
    members: dict[str, Column],
    sums: dict[str, Column],
    once: dict[str, Column] | None = None,
    low: dict[str, Column] | None = None,
    high: dict[str, Column] | None = None,
    count_missing: bool = False,
) -> DataFrame:
    """Sums per `keys` and the exact number of distinct `members`, in two groupings.

    The first grouping is by member as well, so a hot key is spread over its members
    and no set is held in memory; it also runs on streams, which refuse a distinct
    count. Every measure is taken from the rows of the first member: `sums` add up,
    `once` adds one value per distinct first member, `low` and `high` are extremes.
    A missing member counts as one of its own with `count_missing`, else not at all.
    """
    once, low, high = once or {}, low or {}, high or {}
    measures = {**sums, **once, **low, **high}
    tagged = F.array(*[
        F.struct(F.lit(i).alias("kind"), member.cast("string").alias("member"))
        for i, member in enumerate(members.values())
    ])
    if not count_missing:
        tagged = F.filter(tagged, lambda m: m["member"].isNotNull())
    rows = df.select(
        *keys, *[c.alias(name) for name, c in measures.items()], F.explode(tagged).alias("m")
    ).select(*keys, "m.*", *measures)
    steps = [(sums, F.sum, F.sum), (once, F.max, F.sum), (low, F.min, F.min), (high, F.max, F.max)]
    per_member = rows.groupBy(*keys, "kind", "member").agg(*[
        first(F.when(F.col("kind") == 0, F.col(name))).alias(name) for group, first, _ in steps for name in group
    ])
    return per_member.groupBy(*keys).agg(
        *[second(name).alias(name) for group, _, second in steps for name in group],
        *[F.count_if(F.col("kind") == i).alias(name) for i, name in enumerate(members)],
    )
