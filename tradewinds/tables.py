"""The nine raw tables as one argument for the plans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewinds import schemas


@dataclass(frozen=True)
class RawTables:
    """Raw tables.

    The plans take `orders.order_id`, `customers.customer_id`,
    `products.product_id` and `product_category_translation.product_category_name`
    as keys of their tables; `plans.quality` has the checks for them.
    """

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    product_category_translation: DataFrame

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> RawTables:
        """Tables written by `sources.landing.load_all` below `root`."""
        return cls(**{name: spark.read.parquet(f"{root}/{name}") for name in schemas.RAW})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> RawTables:
        return cls(**{name: spark.table(f"{database}.{name}") for name in schemas.RAW})

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        return ((name, getattr(self, name)) for name in schemas.RAW)
