"""Feature tables for models: customers and products."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.functions import dates, labels
from tradewinds.functions.numbers import exact_stddev, ratio
from tradewinds.operators.joins import join_lines
from tradewinds.operators.positions import ntile_cuts, tile_of
from tradewinds.plans.marts import RunTables, customer_metrics, delivered_with_reviews, product_sales, with_category
from tradewinds.sources.staging import stage
from tradewinds.tables import RawTables


def customer_features(
    raw: RawTables, as_of: dt.date | None = None, grain_safe: bool = False, run: RunTables | None = None
) -> DataFrame:
    """Per customer: spend statistics, recency, scores 1-5, tier, churn risk, segment.

    `customer_state` and `customer_city` are the smallest pair of the customer.
    """
    last, first = F.to_date("last_order_date"), F.to_date("first_order_date")
    lifetime = F.col("customer_lifetime_days")
    spread = exact_stddev(F.col("n_paid_units"), F.col("paid_units"), F.col("paid_unit_squares"))
    features = (
        customer_metrics(raw, ["customer_unique_id"], grain_safe, run=run)
        .withColumn("stddev_order_value", spread)
        .withColumn("customer_lifetime_days", dates.calendar_days(last, first))
        .withColumn("days_since_last_order", dates.calendar_days(dates.run_date(as_of), last))
        .select(
            "customer_unique_id",
            last.alias("last_order_date"),
            "total_orders",
            "total_spent",
            "avg_order_value",
            "stddev_order_value",
            "min_order_value",
            "max_order_value",
            first.alias("first_order_date"),
            "avg_installments",
            "unique_products_bought",
            "unique_categories",
            "avg_review_score",
            F.col("total_reviews").alias("total_reviews_given"),
            F.col("place.customer_state").alias("customer_state"),
            F.col("place.customer_city").alias("customer_city"),
            "days_since_last_order",
            "customer_lifetime_days",
            F.when(lifetime > 0, F.col("total_orders") * F.lit(30.0) / lifetime)
            .otherwise(F.lit(0.0)).alias("orders_per_month"),
            F.when(F.col("total_orders") > 1, lifetime / (F.col("total_orders") - F.lit(1.0)))
            .alias("avg_days_between_orders"),
        )
    )
    features = stage(features, "customer-features")
    ranked = {
        "recency_score": -F.col("days_since_last_order"),
        "frequency_score": F.col("total_orders"),
        "monetary_score": F.col("total_spent"),
        "products_score": F.col("unique_products_bought"),
        "categories_score": F.col("unique_categories"),
    }
    recency, frequency, monetary, products, categories = (F.col(name) for name in ranked)
    return (
        _scored(features, ranked)
        .withColumn("engagement_score", (frequency + products + categories) / F.lit(3.0))
        .drop("products_score", "categories_score")
        .withColumn("value_tier", labels.spend_tier(F.col("total_spent")))
        .withColumn("churn_risk", labels.churn_risk(F.col("days_since_last_order")))
        .withColumn("customer_segment", labels.rfm_segment(recency, frequency, monetary))
        .withColumn("feature_timestamp", F.current_timestamp())
    )


def customer_scores(raw: RawTables, as_of: dt.date | None = None, grain_safe: bool = False) -> DataFrame:
    """Per customer: days since the last order, churn risk and segment, as in `customer_features`.

    For reports that need no more: three rankings, and neither products nor categories.
    """
    metrics = customer_metrics(raw, ["customer_unique_id"], grain_safe, diversity=False)
    days = dates.calendar_days(dates.run_date(as_of), F.to_date("last_order_date"))
    facts = stage(
        metrics.select("customer_unique_id", days.alias("days_since_last_order"), "total_orders", "total_spent"), "customer-scores"
    )
    scored = _scored(facts, {
        "recency": -F.col("days_since_last_order"), "frequency": F.col("total_orders"), "monetary": F.col("total_spent"),
    })
    return scored.select(
        "customer_unique_id",
        "days_since_last_order",
        labels.churn_risk(F.col("days_since_last_order")).alias("churn_risk"),
        labels.rfm_segment(F.col("recency"), F.col("frequency"), F.col("monetary")).alias("customer_segment"),
    )


def _scored(customers: DataFrame, ranked: dict[str, Column]) -> DataFrame:
    """`customers` with the quintile (ties by customer) of each ranking.

    At most four cuts for each ranking: a row is compared with those, and the customers are neither sorted
    nor moved.
    """
    person = F.col("customer_unique_id")
    entries = F.array(*[
        F.struct(F.lit(name).alias("grp"), value.cast("double").alias("value")) for name, value in ranked.items()
    ])
    ranking = customers.select(F.explode(entries).alias("e"), person.alias("id")).select("e.*", "id")
    cuts = ntile_cuts(ranking, 5).agg(F.map_from_entries(F.collect_list(F.struct("grp", "cuts"))))
    return (
        customers.withColumn("cuts", cuts.scalar())
        .withColumns({
            name: tile_of(value, person, F.try_element_at("cuts", F.lit(name))) for name, value in ranked.items()
        })
        .drop("cuts")
    )


def product_features(raw: RawTables, run: RunTables | None = None) -> DataFrame:
    """Per sold product: sales, prices, ratings, popularity decile, quality and price tiers."""
    if run is not None:
        per_product = run.sales
    else:
        sales = join_lines(
            raw.order_items.select("order_id", "product_id", "seller_id", "price"), delivered_with_reviews(raw), "order_id"
        )
        per_product = product_sales(sales, None, analytics=False)
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    n_scores = F.col("n_scores").cast("double")
    stats = with_category(per_product, raw).select(
        "product_id",
        "product_category_name",
        F.col("product_category_name_english").alias("category"),
        F.col("total_orders").alias("total_sales"),
        "unique_buyers",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("n_prices")).alias("avg_price"),
        exact_stddev(F.col("n_price_units"), F.col("price_units"), F.col("price_unit_squares")).alias("price_stddev"),
        ratio(F.col("score"), n_scores).alias("avg_rating"),
        # Scores are whole numbers, so n * squares - sum^2 has no rounding before the division.
        F.when(
            n_scores > 1,
            F.sqrt((n_scores * F.col("score_squares") - F.col("score") * F.col("score").cast("double"))
                   / n_scores / (n_scores - 1)),
        ).alias("rating_stddev"),
        F.coalesce("n_review_ids", F.lit(0)).alias("review_count"),
        F.col("product_weight_g").cast("double").alias("avg_weight_g"),
        volume.cast("double").alias("avg_volume_cm3"),
        "unique_sellers",
        ratio(F.col("delivery_days"), F.col("n_deliveries")).alias("avg_delivery_days"),
    )
    stats = stage(stats, "product-features")
    # A missing category is a group of its own, kept apart from every category name.
    group = F.coalesce(F.concat(F.lit("="), "category"), F.lit("none"))
    sales, product = F.lit("sales"), F.col("product_id")
    entries = F.array(
        F.struct(sales.alias("grp"), F.col("total_sales").cast("double").alias("value")),
        F.struct(group.alias("grp"), F.col("avg_price").alias("value")),
    )
    ranking = stats.select(F.explode(entries).alias("e"), product.alias("id")).select("e.*", "id")
    cuts = stage(ntile_cuts(ranking, F.when(F.col("grp") == sales, 10).otherwise(5)), "cuts")
    return (
        stats.withColumn("sales_cuts", cuts.where(F.col("grp") == sales).select("cuts").scalar())
        .withColumn("popularity_decile", tile_of(F.col("total_sales"), product, F.col("sales_cuts")))
        .withColumn("quality_tier", labels.quality_tier(F.col("avg_rating"), F.col("review_count")))
        .withColumn("grp", group)
        .join(cuts, "grp", "left")
        .withColumn("price_tier_in_category", tile_of(F.col("avg_price"), product, F.col("cuts")))
        .drop("grp", "cuts", "sales_cuts")
        .withColumn("feature_timestamp", F.current_timestamp())
    )
