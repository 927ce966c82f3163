"""Every registered query, as (spark, directory of the test tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import files
from registry.model import AS_OF, OFF_TIE, PIPELINES, RUN_TIME, raw_tables, view
from tradewinds.plans import daily, features, health, marts, monthly, profiles, quality, reports
from tradewinds.session import prepare
from tradewinds.sources.staging import new_path, stage
from tradewinds.tables import RawTables

Query = Callable[[SparkSession, str], DataFrame]

# Columns that hold the time of the run itself.
_CLOCKS = ["processed_at", "feature_timestamp", "generated_at", "processing_timestamp", "ingestion_timestamp"]


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, run-time clocks left out."""
    return df.select(*[
        F.round(F.col(name) + OFF_TIE, 6).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
        if name not in _CLOCKS
    ])


def _on_raw(plan: Callable[[RawTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(raw_tables(spark, sf_dir)))


def _recent_days(raw: RawTables) -> DataFrame:
    """As many days of daily_metrics as the reports look back."""
    return marts.daily_metrics(raw, AS_OF, since=AS_OF - dt.timedelta(days=8))


def _kpis(raw: RawTables) -> DataFrame:
    customers = features.customer_scores(raw, AS_OF)
    return reports.daily_kpis(_recent_days(raw), customers, marts.product_analytics(raw), AS_OF)


def _alerts(raw: RawTables) -> DataFrame:
    return reports.business_alerts(raw, _recent_days(raw), reports.last_orders(raw, AS_OF, reports.INACTIVE_DAYS[1]), AS_OF)


def _daily_report(raw: RawTables) -> DataFrame:
    customers, days = features.customer_scores(raw, AS_OF), stage(_recent_days(raw), "days")
    kpis = reports.daily_kpis(days, customers, marts.product_analytics(raw), AS_OF)
    report = reports.daily_report(kpis, reports.business_alerts(raw, days, customers, AS_OF))
    return report.withColumn("alerts", F.array_join(F.transform("alerts", lambda a: a["message"]), "; "))


def _output_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run, and the rows of what it wrote."""
    raw, root = raw_tables(spark, sf_dir), new_path(spark, "analytics")
    tables = daily.build_analytics(raw, root, AS_OF)
    return quality.row_counts({**tables, **daily.build_reports(raw, tables, root, AS_OF)})


def _order_ids(raw: RawTables) -> DataFrame:
    """Order ids of several shapes: short, a 32 character digest, one with a dash, too long."""
    n, digest = F.col("order_id").cast("bigint"), F.md5("order_id")
    shaped = (
        F.when(n % 4 == 0, F.col("order_id"))
        .when(n % 4 == 1, digest)
        .when(n % 4 == 2, F.concat(F.substring(digest, 1, 31), F.lit("-")))
        .otherwise(F.concat(digest, F.lit("a")))
    )
    return raw.orders.select(shaped.alias("order_id")).withColumn("valid", quality.is_order_id(F.col("order_id")))


def _payment_checks(raw: RawTables) -> DataFrame:
    """Payment values spread over and beyond the valid range."""
    value = (F.col("payment_value") - 100) * 60
    return raw.order_payments.select("order_id", "payment_sequential", value.alias("value")).withColumn(
        "valid", quality.is_payment_value(F.col("value"))
    )


def _on_view(name: str, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(view(prepare(spark), sf_dir, name)))


def _rounded(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # analytics and feature tables
    "orders_enriched": _on_raw(lambda raw: marts.orders_enriched(raw, AS_OF)),
    "orders_enriched_grain_safe": _on_raw(lambda raw: marts.orders_enriched(raw, AS_OF, grain_safe=True)),
    "order_payment_lines": _on_raw(lambda raw: marts.order_payment_lines(raw, AS_OF)),
    "product_analytics": _on_raw(marts.product_analytics),
    "daily_metrics": _on_raw(lambda raw: marts.daily_metrics(raw, AS_OF).orderBy("order_date")),
    "daily_metrics_grain_safe": _on_raw(lambda raw: marts.daily_metrics(raw, AS_OF, grain_safe=True)),
    "customer_segments": _on_raw(lambda raw: marts.customer_segments(raw, AS_OF)),
    "customer_segments_grain_safe": _on_raw(lambda raw: marts.customer_segments(raw, AS_OF, grain_safe=True)),
    "customer_features": _on_raw(lambda raw: features.customer_features(raw, AS_OF)),
    "product_features": _on_raw(features.product_features),
    # monthly metrics
    "monthly_metrics": _on_raw(monthly.monthly_metrics),
    "monthly_metrics_first_payment": _on_raw(lambda raw: monthly.monthly_metrics(raw, mode="first")),
    "monthly_labels": _on_raw(monthly.monthly_labels),
    "monthly_metrics_json": _rounded(files.monthly_metrics_json),
    "order_payment_lookup": _on_raw(monthly.order_payment_lookup),
    "order_payment_lookup_first": _on_raw(lambda raw: monthly.order_payment_lookup(raw, mode="first")),
    # reports and alerts
    "daily_kpis": _on_raw(_kpis),
    "top_products_daily": _on_raw(lambda raw: reports.top_products_daily(raw, AS_OF)),
    "revenue_drop_alert": _on_raw(lambda raw: reports.revenue_drop(_recent_days(raw), AS_OF)),
    "cancellation_alert": _on_raw(lambda raw: reports.cancellation_rate(raw, AS_OF)),
    "churn_alert": _on_raw(lambda raw: reports.inactive_customers(reports.last_orders(raw, AS_OF, reports.INACTIVE_DAYS[1]))),
    "business_alerts": _on_raw(_alerts),
    "daily_report": _on_raw(_daily_report),
    "top_cities": _on_raw(reports.top_cities),
    "revenue_by_month": _on_raw(reports.revenue_by_month),
    "top_categories": _on_raw(reports.top_categories),
    "volume_class": _on_raw(lambda raw: reports.volume_class(raw, AS_OF)),
    "segment_distribution": _on_raw(
        lambda raw: reports.segment_distribution(features.customer_scores(raw, AS_OF))
    ),
    "latest_daily_metrics": _on_raw(lambda raw: reports.latest_days(raw, AS_OF, 5)),
    "latest_daily_metrics_stored": _rounded(files.latest_daily_metrics_stored),
    "daily_metrics_incremental": _rounded(files.daily_metrics_incremental),
    "orders_by_month": _on_raw(reports.orders_by_month),
    "top_states": _on_raw(reports.top_states),
    # run logs
    "run_health": _on_view("m_run_log", lambda log: health.run_health(log, PIPELINES, RUN_TIME)),
    "slow_tasks": _on_view("m_task_log", lambda log: health.slow_tasks(log, RUN_TIME)),
    # checks
    "output_row_counts": _output_row_counts,
    "table_row_counts": _on_raw(lambda raw: quality.row_counts(dict(raw.items()))),
    "orders_quality_gate": _on_raw(lambda raw: quality.orders_gate(raw.orders)),
    "daily_load_check": _on_raw(lambda raw: quality.daily_load_check(raw.orders, AS_OF)),
    "schema_check": _on_raw(lambda raw: quality.schema_check("orders", raw.orders)),
    "data_freshness": _on_raw(lambda raw: quality.freshness(raw.orders)),
    "valid_order_ids": _on_raw(_order_ids),
    "valid_payments": _on_raw(_payment_checks),
    "orphan_orders": _on_raw(quality.orphan_orders),
    "integrity_report": _on_raw(quality.integrity_report),
    "null_report": _on_raw(quality.null_report),
    "duplicate_report": _on_raw(quality.duplicate_report),
    # profiles
    "profile_customers": _on_raw(profiles.profile_customers),
    "profile_orders": _on_raw(profiles.profile_orders),
    "profile_items": _on_raw(profiles.profile_items),
    "profile_payments": _on_raw(profiles.profile_payments),
    "profile_reviews": _on_raw(profiles.profile_reviews),
    "profile_products": _on_raw(profiles.profile_products),
    "profile_sellers": _on_raw(profiles.profile_sellers),
    # files
    "load_csv": _rounded(files.load_csv),
    "load_csv_infer": _rounded(files.load_csv_infer),
    "load_reviews": _rounded(files.load_reviews),
    "load_reviews_rejects": _rounded(files.load_reviews_rejects),
    "load_rejects": _rounded(files.load_rejects),
    "load_counts": _rounded(files.load_counts),
    "load_all": _rounded(files.load_all),
    "load_daily_orders": _rounded(files.load_daily_orders),
    "load_summary": _rounded(files.load_summary),
    "landing_missing": _rounded(files.landing_missing),
    "orders_partitioned": _rounded(files.orders_partitioned),
    "partition_stats": _rounded(files.partition_stats),
    # events
    "realtime_orders": _rounded(files.realtime_orders),
    "realtime_rejects": _rounded(files.realtime_rejects),
    "realtime_metrics": _rounded(files.realtime_metrics_batch),
    "rolling_metrics": _rounded(files.rolling_metrics_batch),
    "latest_events": _rounded(files.latest_events),
    "stream_realtime_orders": _rounded(files.stream_realtime_orders),
    "stream_realtime_rejects": _rounded(files.stream_realtime_rejects),
    "stream_realtime_metrics": _rounded(files.stream_realtime_metrics),
    "stream_rolling_metrics": _rounded(files.stream_rolling_metrics),
    "stream_late_events": _rounded(files.stream_late_events),
    "stream_redelivered": _rounded(files.stream_redelivered),
    "binary_messages": _rounded(files.binary_messages),
    # sizes and catalog tables
    "table_sizes": _rounded(files.table_sizes),
    "catalog_revenue_by_month": _rounded(files.catalog_source),
}
