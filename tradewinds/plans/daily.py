"""The daily run: analytics tables, feature tables and reports, written in that order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tradewinds.plans import features, marts, monthly, quality, reports
from tradewinds.sources.writers import overwrite
from tradewinds.tables import RawTables


def build_analytics(raw: RawTables, root: str, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Write the analytics and feature tables below `root`; fail where one is empty.

    They share joins and roll-ups (`marts.run_tables`), which are written once instead of built by each.
    """
    run = marts.run_tables(raw)
    plans = {
        "orders_enriched": lambda: marts.orders_enriched(raw, as_of, run=run),
        "order_payment_lines": lambda: marts.order_payment_lines(raw, as_of, run=run),
        "product_analytics": lambda: marts.product_analytics(raw, run),
        "daily_metrics": lambda: marts.daily_metrics(raw, as_of, run=run),
        "customer_segments": lambda: marts.customer_segments(raw, as_of, run=run),
        "monthly_metrics": lambda: monthly.monthly_metrics(raw),
        "ml_customer_features": lambda: features.customer_features(raw, as_of, run=run),
        "ml_product_features": lambda: features.product_features(raw, run),
    }
    tables = {name: _written(plan(), root, name) for name, plan in plans.items()}
    quality.require_rows({n: t for n, t in tables.items() if n != "order_payment_lines"})
    return tables


def build_reports(
    raw: RawTables, tables: dict[str, DataFrame], root: str, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """Write the reports of the day from the tables of `build_analytics`."""
    daily, customers = tables["daily_metrics"], tables["ml_customer_features"]
    kpis = reports.daily_kpis(daily, customers, tables["product_analytics"], as_of)
    written = {
        "report_daily_kpis": _written(kpis, root, "report_daily_kpis"),
        "report_top_products_daily": _written(
            reports.top_products_daily(raw, as_of), root, "report_top_products_daily"
        ),
        "business_alerts": _written(
            reports.business_alerts(raw, daily, customers, as_of), root, "business_alerts"
        ),
    }
    written["daily_report"] = reports.daily_report(written["report_daily_kpis"], written["business_alerts"])
    return written


def _written(df: DataFrame, root: str, name: str) -> DataFrame:
    path = f"{root}/{name}"
    overwrite(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
