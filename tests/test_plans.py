"""Plans over a small fixture, against the plain joins they stand for."""

from __future__ import annotations

import dataclasses
import datetime as dt
import statistics
from fractions import Fraction

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from tradewinds.functions import dates
from tradewinds.plans import features, marts, monthly, profiles, quality, reports

AS_OF = dt.date(2024, 1, 10)


def delivered_lines(raw):
    return (
        raw.orders.where("order_status = 'delivered'")
        .join(raw.order_items, "order_id")
        .join(raw.products, "product_id")
        .join(raw.product_category_translation, "product_category_name", "left")
        .join(raw.order_reviews, "order_id", "left")
    )


def bought(raw):
    return (
        raw.orders.where("order_status = 'delivered'")
        .join(raw.customers, "customer_id")
        .join(raw.order_payments, "order_id", "left")
        .join(raw.order_items, "order_id", "left")
        .join(raw.products, "product_id", "left")
        .join(raw.product_category_translation, "product_category_name", "left")
        .join(raw.order_reviews, "order_id", "left")
    )


def test_daily_metrics_counts_as_the_joins_do(small):
    joined = (
        small.orders.join(small.customers, "customer_id", "left")
        .join(small.order_payments, "order_id", "left")
        .join(small.order_items, "order_id", "left")
    )
    names = ["order_date", "num_orders", "total_revenue", "avg_order_value", "delivered_orders",
             "voucher_orders", "unique_states", "unique_products", "items_revenue", "freight_revenue"]
    want = joined.groupBy(F.to_date("order_purchase_timestamp").alias("order_date")).agg(
        F.count_distinct("order_id"), F.sum("payment_value"), F.avg("payment_value"),
        F.count_if(F.col("order_status") == "delivered"), F.count_if(F.col("payment_type") == "voucher"),
        F.count_distinct("customer_state"), F.count_distinct("product_id"), F.sum("price"), F.sum("freight_value"),
    )
    assert rows(marts.daily_metrics(small, AS_OF), *names) == rows(want)


def test_daily_metrics_grain_safe_and_since(small):
    got = rows(
        marts.daily_metrics(small, AS_OF, since=dt.date(2024, 1, 9), grain_safe=True),
        "order_date", "total_revenue", "voucher_orders", "items_revenue", "delivered_orders",
    )
    assert got == [(dt.date(2024, 1, 9), 21.75, 3, 24.5, 1)]


def test_as_of_leaves_out_later_days(small):
    assert marts.daily_metrics(small, dt.date(2024, 1, 2)).count() == 2
    assert marts.orders_enriched(small, dt.date(2024, 1, 1)).count() == 2


def test_copies_of_an_order_count_once_as_an_order(small):
    import dataclasses

    twice = dataclasses.replace(small, orders=small.orders.unionByName(small.orders))
    once, double = (
        rows(marts.daily_metrics(raw, AS_OF), "order_date", "num_orders") for raw in (small, twice)
    )
    assert once == double
    people = [rows(marts.customer_segments(raw, AS_OF), "customer_unique_id", "total_orders") for raw in (small, twice)]
    assert people[0] == people[1]


def test_product_analytics_counts_as_the_joins_do(small):
    want = delivered_lines(small).groupBy("product_id").agg(
        F.count_distinct("order_id"), F.count("*"), F.sum("price"), F.avg("price"), F.sum("freight_value"),
        F.count_distinct("seller_id"), F.avg("review_score"), F.count_distinct("review_id"),
        F.min("order_purchase_timestamp"), F.max("order_purchase_timestamp"),
    )
    names = ["product_id", "total_orders", "total_items_sold", "total_revenue", "avg_price", "total_freight",
             "unique_sellers", "avg_review_score", "total_reviews", "first_sale_date", "last_sale_date"]
    assert rows(marts.product_analytics(small), *names) == rows(want)


def test_product_features_count_as_the_joins_do(small):
    days = dates.whole_days(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))
    want = delivered_lines(small).groupBy("product_id").agg(
        F.count_distinct("order_id"), F.count_distinct("customer_id"), F.stddev_samp("price"),
        F.avg("review_score"), F.stddev_samp("review_score"), F.count("review_id"), F.avg(days),
    )
    names = ["product_id", "total_sales", "unique_buyers", "price_stddev", "avg_rating", "rating_stddev",
             "review_count", "avg_delivery_days"]
    assert rows(features.product_features(small), *names) == rows(want)


def test_customer_segments_count_as_the_joins_do(small):
    keys = ["customer_unique_id", "customer_state", "customer_city"]
    want = bought(small).groupBy(*keys).agg(
        F.count_distinct("order_id"), F.sum("payment_value"), F.avg("payment_value"),
        F.count_distinct("product_id"), F.count_distinct("product_category_name_english"),
        F.avg("review_score"), F.count("review_id"),
    )
    names = ["total_orders", "total_spent", "avg_order_value", "unique_products_bought", "unique_categories",
             "avg_review_score", "total_reviews"]
    assert rows(marts.customer_segments(small, AS_OF), *keys, *names) == rows(want)


def test_customer_features_count_as_the_joins_do(small):
    want = bought(small).groupBy("customer_unique_id").agg(
        F.count_distinct("order_id"), F.stddev_samp("payment_value"), F.min("payment_value"),
        F.max("payment_value"), F.avg("payment_installments"), F.count("review_id"),
    )
    names = ["customer_unique_id", "total_orders", "stddev_order_value", "min_order_value", "max_order_value",
             "avg_installments", "total_reviews_given"]
    df = features.customer_features(small, AS_OF)
    assert rows(df, *names) == rows(want)
    places = {r["customer_unique_id"]: (r["customer_state"], r["customer_city"]) for r in df.collect()}
    assert places == {"u1": ("RJ", "rio"), "u2": ("SP", None), "u3": (None, "rio")}
    # Equal payments have no spread at all, however often they are repeated.
    assert {r["stddev_order_value"] for r in df.where("customer_unique_id = 'u3'").collect()} == {0.0}


def test_deviation_of_large_close_amounts(small, table):
    """Amounts a cent apart at a million: a sum of squares of doubles has lost the difference."""
    n, stamp = 40, ts("2024-01-05 12:00:00")
    amount = [1_000_000.0 + k % 2 / 100 for k in range(n)]
    raw = dataclasses.replace(
        small,
        customers=table("customers", [dict(customer_id=f"c{k}", customer_unique_id="u", customer_city="x", customer_state="S") for k in range(n)]),
        orders=table("orders", [dict(order_id=f"o{k}", customer_id=f"c{k}", order_status="delivered", order_purchase_timestamp=stamp) for k in range(n)]),
        order_items=table("order_items", [dict(order_id=f"o{k}", order_item_id=1, product_id="p1", seller_id="s", price=a, freight_value=1.0) for k, a in enumerate(amount)]),
        order_payments=table("order_payments", [dict(order_id=f"o{k}", payment_sequential=1, payment_type="boleto", payment_installments=1, payment_value=a) for k, a in enumerate(amount)]),
        order_reviews=table("order_reviews", []),
    )
    want = statistics.stdev(Fraction(str(a)) for a in amount)
    assert round(want, 4) == 0.0051  # 0.0050 with many rows
    assert features.customer_features(raw, AS_OF).first().stddev_order_value == pytest.approx(want, rel=1e-9)
    assert features.product_features(raw).first().price_stddev == pytest.approx(want, rel=1e-9)


def test_shared_reviews_meet_products_not_items(small):
    """The branch of reviews that several orders share takes an order's products, not its items."""
    plan = marts.product_analytics(small)._jdf.queryExecution().optimizedPlan().toString()
    branch = plan[plan.index("shared_review"):]
    assert "Aggregate [order_id" in branch and "product_id" in branch


def test_orders_enriched(small):
    df = {r["order_id"]: r for r in marts.orders_enriched(small, AS_OF).collect()}
    assert len(df) == 7
    assert df["o1"]["n_payment_entries"] == 4 and df["o1"]["max_installments"] == 3
    assert (df["o1"]["n_credit_card"], df["o1"]["credit_card_amount"]) == (2, 39.0)
    assert (df["o1"]["n_voucher"], df["o1"]["voucher_amount"]) == (2, 25.0)
    assert (df["o1"]["n_boleto"], df["o1"]["boleto_amount"]) == (0, None)
    assert df["o1"]["total_payment"] == 64.0 and df["o1"]["review_score"] == 5
    assert df["o3"]["n_payment_entries"] == 0 and df["o3"]["total_payment"] is None
    # 13 hours before the purchase: no whole day
    assert df["o2"]["delivery_time_days"] == 0
    assert df["o5"]["customer_unique_id"] is None and df["o5"]["delivery_delay_days"] == 2
    safe = {r["order_id"]: r for r in marts.orders_enriched(small, AS_OF, grain_safe=True).collect()}
    assert safe["o1"]["total_payment"] == 32.0 and safe["o1"]["n_payment_entries"] == 2


def test_orders_with_many_payments_keep_them_all(small, table):
    lines = [dict(order_id="o1", payment_sequential=n, payment_type="voucher", payment_installments=1, payment_value=0.5)
             for n in range(20_000)]
    raw = dataclasses.replace(small, order_payments=table("order_payments", lines))
    enriched = {r["order_id"]: r for r in marts.orders_enriched(raw, AS_OF).collect()}["o1"]
    assert (enriched["n_payment_entries"], enriched["n_voucher"]) == (40_000, 40_000)
    assert enriched["total_payment"] == enriched["voucher_amount"] == 20_000.0
    kept = marts.order_payment_lines(raw, AS_OF)
    assert kept.count() == 20_000 and rows(kept, "copies")[0] == (2,)


def test_monthly_metrics(small, table):
    lookup = rows(monthly.order_payment_lookup(small), "order_id", "payment_type", "payment_value")
    assert lookup == [
        ("o1", "credit_card", 32.0), ("o2", "boleto", 17.0), ("o3", "no_payment", 0.0), ("o5", "unknown", 3.1),
        ("o7", "voucher", 21.75),
    ]
    assert rows(monthly.monthly_metrics(small, mode="first")) == [("2024-01", 5, 46.85, 9.37)]
    assert rows(monthly.monthly_metrics(small), "total_revenue") == [(73.85,)]
    assert "collect_list" not in monthly.monthly_metrics(small)._jdf.queryExecution().executedPlan().toString()
    month = monthly.monthly_histograms(small).collect()[0]
    assert month["payment_types"] == {"boleto": 1, "credit_card": 1, "no_payment": 1, "unknown": 1, "voucher": 1}
    assert month["order_statuses"] == {"delivered": 5}


def test_parse_orders_drops_rows_without_a_required_field(table):
    orders = table("orders", [
        dict(order_id="abc123", customer_id="cust456", order_status="delivered",
             order_purchase_timestamp=dt.datetime(2024, 1, 15)),
        dict(order_id="abc123", order_purchase_timestamp=dt.datetime(2024, 1, 15)),
        dict(order_id="abc123", customer_id="cust456"),
    ])
    assert rows(monthly.parse_orders(orders), "order_id", "customer_id", "order_status", "year", "month") == [
        ("abc123", "cust456", "delivered", 2024, 1)
    ]


def test_filters_and_columns_reach_the_files(spark, small, tmp_path):
    from tradewinds import RawTables
    from tradewinds.sources import writers

    for name, df in small.items():
        writers.overwrite(df, f"{tmp_path}/{name}")
    raw = RawTables.from_parquet(spark, str(tmp_path))
    plan = reports.cancellation_rate(raw, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp," in plan and "LessThan(order_purchase_timestamp," in plan
    assert "ReadSchema: struct<order_status:string,order_purchase_timestamp:timestamp>" in plan
    plan = reports.revenue_by_month(raw)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    assert "ReadSchema: struct<order_id:string,payment_value:double>" in plan


def test_quality(small, table):
    assert rows(quality.integrity_report(small)) == [
        ("order_items", "order_id", "orders", 0), ("order_items", "product_id", "products", 1),
        ("orders", "customer_id", "customers", 1),
    ]
    assert rows(quality.orphan_orders(small)) == [(1,)]
    nulls = {r["table_name"]: r["null_cells"] for r in quality.null_report(small).collect()}
    assert nulls["customers"] == 4 + 2 and nulls["geolocation"] == 0
    twice = small.sellers.unionByName(small.sellers)
    copies = quality.duplicate_report(type(small)(**{**dict(small.items()), "sellers": twice}))
    assert rows(copies.where("duplicate_rows > 0")) == [("sellers", 1, 50.0)]
    gate = quality.orders_gate(small.orders.unionByName(small.orders.limit(2))).collect()[0]
    assert (gate["total_orders"], gate["duplicate_order_ids"], gate["passed"]) == (9, 2, False)
    assert quality.orders_gate(small.orders).collect()[0]["passed"]
    assert not quality.orders_gate(small.orders.limit(0)).collect()[0]["passed"]
    bare = quality.orders_gate(small.orders.drop("order_status")).collect()[0]
    assert (bare["missing_columns"], bare["passed"]) == ("order_status", False)
    assert not quality.orders_gate(small.orders.drop("order_id")).collect()[0]["passed"]
    check = quality.schema_check("orders", small.orders.drop("customer_id"))
    assert rows(check, "column_name", "present") == [
        ("customer_id", False), ("order_id", True), ("order_purchase_timestamp", True)
    ]
    assert rows(quality.daily_load_check(small.orders, dt.date(2024, 1, 9))) == [(True,)]
    assert rows(quality.daily_load_check(small.orders, dt.date(2024, 1, 8))) == [(False,)]
    try:
        quality.require_rows({"geolocation": small.geolocation, "orders": small.orders})
    except ValueError as error:
        assert "geolocation" in str(error) and "orders" not in str(error)
    else:
        raise AssertionError("an empty table must fail")


def test_order_ids_and_payment_values(spark):
    ids = {
        "abc123def456ghi789jkl012mno345pq": True, "short": False,
        "abc123-def456-ghi789-jkl012-mno345": False, "abc123def456ghi789jkl012mno345pqrst": False,
        "abc123def456ghi789jkl012mno345p\n": False, None: False,
    }
    df = spark.createDataFrame(list(ids.items()), "id string, want boolean")
    assert df.where(quality.is_order_id(F.col("id")) != F.col("want")).count() == 0
    values = {100.5: True, 9999.99: True, -10.0: False, 0.0: False, 10000.0: False, 15000.0: False, None: False}
    df = spark.createDataFrame(list(values.items()), "v double, want boolean")
    assert df.where(quality.is_payment_value(F.col("v")) != F.col("want")).count() == 0


def daily(spark, *days):
    return spark.createDataFrame(list(days), "order_date date, num_orders bigint, total_revenue double")


def test_revenue_drop(spark):
    day = dt.date(2024, 1, 9)
    before = [(day - dt.timedelta(days=n), 1, 100.0) for n in range(1, 8)]

    def one(*days):
        return tuple(reports.revenue_drop(daily(spark, *days), AS_OF).collect()[0])

    assert one((day, 1, 80.0), *before) == (80.0, 100.0, -20.0, False)
    assert one((day, 1, 79.99), *before) == (79.99, 100.0, -20.01, True)
    assert one(*before) == (0.0, 100.0, -100.0, True)
    assert one((day, 1, 80.0)) == (80.0, None, None, False)
    # a baseline of zero cannot drop
    assert one((day, 1, 80.0), (day - dt.timedelta(days=1), 1, 0.0)) == (80.0, 0.0, None, False)


def test_alerts_and_report(spark, small, table):
    day = dt.date(2024, 1, 9)
    days = daily(spark, (day, 3, 50.0), (day - dt.timedelta(days=1), 4, 100.0))
    people = spark.range(101).select(
        F.col("id").cast("string").alias("customer_unique_id"), F.lit(75).alias("days_since_last_order"),
        F.lit("champions").alias("customer_segment"), F.lit("high").alias("churn_risk"),
    )
    raw = type(small)(**{**dict(small.items()), "orders": table("orders", [
        dict(order_id=str(i), order_status="canceled" if i == 0 else "delivered",
             order_purchase_timestamp=dt.datetime(2024, 1, 9, 3)) for i in range(16)
    ])})
    alerts = reports.business_alerts(raw, days, people, AS_OF)
    assert rows(alerts, "message") == [
        ("101 customers at risk of churning (60-90 days inactive)",),
        ("Cancellation rate at 6.25% (threshold: 5%)",),
        ("Revenue dropped 50.0% vs 7-day average",),
    ]
    products = spark.createDataFrame([(4.5,), (4.4,), (None,)], "avg_review_score double")
    kpis = reports.daily_kpis(days, people, products, AS_OF)
    assert rows(kpis.drop("generated_at")) == [(AS_OF, 3, 50.0, 75.0, 101, 101, 1)]
    report = reports.daily_report(kpis, alerts).collect()[0]
    assert [a["type"] for a in report["alerts"]] == ["CRITICAL", "INFO", "WARNING"]
    empty = reports.daily_kpis(daily(spark).limit(0), people.limit(0), products.limit(0), AS_OF)
    assert rows(empty, "orders_yesterday", "revenue_yesterday", "champions_count") == [(0, None, 0)]


def test_cancellation_rate_of_exactly_five_percent(small, table):
    orders = table("orders", [
        dict(order_id=str(i), order_status="canceled" if i == 0 else "delivered",
             order_purchase_timestamp=dt.datetime(2024, 1, 9, 23, 59, 59)) for i in range(20)
    ])
    raw = type(small)(**{**dict(small.items()), "orders": orders})
    assert rows(reports.cancellation_rate(raw, AS_OF)) == [(5.0, False)]
    assert rows(reports.cancellation_rate(raw, dt.date(2024, 3, 1))) == [(None, False)]
    assert rows(reports.volume_class(raw, AS_OF)) == [(20, "quick_processing")]


def test_top_products(small):
    got = rows(reports.top_products_daily(small, AS_OF), "rank", "product_id", "category", "orders", "revenue", "avg_rating")
    assert got == [(1, "p3", None, 1, 14.0, 4.0), (2, "p2", "Books", 1, 11.0, 4.0), (3, "p4", None, 1, 2.0, 4.0)]


def test_top_categories_fall_back_to_the_local_name(small):
    assert rows(reports.top_categories(small), "category", "num_orders") == [("Books", 2), ("Toys", 3), ("misc", 1)]


def test_profiles(small, spark):
    orders = {(r["section"], r["item"]): r["value"] for r in profiles.profile_orders(small).collect()}
    # whole days rounded down: 13 hours early is a day early
    assert orders[("delivery_days", "min")] == -1.0
    assert orders[("delivery_days", "delivery_days.median")] == 6.0
    assert orders[("nulls", "order_delivered_customer_date")] == 2.0
    text = small.orders.withColumn("order_approved_date", F.lit("not a date"))
    assert profiles.tolerant_timestamps(text).where("order_approved_date is not null").count() == 0
    items = {(r["section"], r["item"]): r["value"] for r in profiles.profile_items(small).collect()}
    assert items[("describe", "freight_value.count")] == 9.0 and items[("per_order", "max")] == 3.0
    assert items[("items_per_order", "1")] == 3.0
    reviews = [r["text"] for r in profiles.profile_reviews(small).where("section = 'comments_5'").collect()]
    assert reviews == ["good...", "good..."]


def test_run_tables_give_what_the_plans_give(spark, small, tmp_path):
    """The tables of a daily run, which share their joins, are those of the plans alone; also where orders repeat."""
    from tradewinds.plans import daily

    clocks = ("processed_at", "feature_timestamp")
    for name, raw in (("once", small), ("twice", dataclasses.replace(small, orders=small.orders.unionAll(small.orders)))):
        tables = daily.build_analytics(raw, str(tmp_path / name), AS_OF)
        alone = {
            "orders_enriched": marts.orders_enriched(raw, AS_OF), "order_payment_lines": marts.order_payment_lines(raw, AS_OF),
            "product_analytics": marts.product_analytics(raw), "daily_metrics": marts.daily_metrics(raw, AS_OF),
            "customer_segments": marts.customer_segments(raw, AS_OF),
            "ml_customer_features": features.customer_features(raw, AS_OF), "ml_product_features": features.product_features(raw),
        }
        for table, want in alone.items():
            names = [c for c in want.columns if c not in clocks]
            assert [c for c in tables[table].columns if c not in clocks] == names
            assert rows(tables[table], *names) == rows(want, *names), table
    run = marts.run_tables(small)
    shared = marts.orders_enriched(small, AS_OF, run=run), marts.daily_metrics(small, AS_OF, grain_safe=True, run=run)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in shared]
    # Nothing is joined anew, and orders are shuffled by order only where they repeat.
    assert "Join" not in plans[0] and "Exchange" not in plans[0]
    assert rows(shared[1]) == rows(marts.daily_metrics(small, AS_OF, grain_safe=True))
