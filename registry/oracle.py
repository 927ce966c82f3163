"""The SQL each registered query is checked against.

An order's payments, items and reviews are first summed up per order (`order_facts`). The analytics
tables count a payment once for every item and review of its order, and so on, so their sums are an
order's sum times the numbers of the other lines (`per_payment`, `per_item`, `per_review`: at least 1).
"""

from __future__ import annotations

import re

from registry.model import AS_OF, OFF_TIE, PIPELINES, VIEWS, _names

_TODAY = f"DATE '{AS_OF}'"
_DELIVERED = "order_status = 'delivered'"
_PAST = f"CAST(order_purchase_timestamp AS DATE) <= {_TODAY}"

# Keys that must have a parent row: child table, key, parent table.
REFERENCES = [("order_items", "order_id", "orders"), ("order_items", "product_id", "products"), ("orders", "customer_id", "customers")]
# The columns of the raw tables.
RAW = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at order_delivered_carrier_date "
    "order_delivered_customer_date order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message review_creation_date "
    "review_answer_timestamp",
    "products": "product_id product_category_name product_name_length product_description_length product_photos_qty "
    "product_weight_g product_length_cm product_height_cm product_width_cm",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "product_category_translation": "product_category_name product_category_name_english",
}
REQUIRED_OF_ORDERS = "order_id customer_id order_purchase_timestamp"


def _rounded(source: str, *doubles: str) -> str:
    """All of `source` with the named doubles rounded."""
    return f"SELECT * REPLACE ({', '.join(f'ROUND({c}, 6) AS {c}' for c in doubles)}) FROM {source}"


# Results that other checks build on.
DERIVED = {
    "order_paid": """
SELECT order_id, COUNT(*) AS n_payments, COUNT(payment_value) AS n_values, SUM(payment_value) AS paid,
       COUNT(payment_installments) AS n_installments, SUM(payment_installments) AS installments,
       MAX(payment_installments) AS max_installments,
       COUNT(*) FILTER (payment_type = 'credit_card') AS n_credit_card,
       COUNT(*) FILTER (payment_type = 'boleto') AS n_boleto,
       COUNT(*) FILTER (payment_type = 'voucher') AS n_voucher,
       COUNT(*) FILTER (payment_type = 'debit_card') AS n_debit_card,
       SUM(payment_value) FILTER (payment_type = 'credit_card') AS credit_card_amount,
       SUM(payment_value) FILTER (payment_type = 'boleto') AS boleto_amount,
       SUM(payment_value) FILTER (payment_type = 'voucher') AS voucher_amount,
       SUM(payment_value) FILTER (payment_type = 'debit_card') AS debit_card_amount
FROM m_order_payments GROUP BY order_id""",
    "order_sold": """
SELECT order_id, COUNT(*) AS n_items, SUM(price) AS price, SUM(freight_value) AS freight
FROM m_order_items GROUP BY order_id""",
    "order_rated": """
SELECT order_id, COUNT(*) AS n_reviews, COUNT(review_id) AS n_review_ids, COUNT(review_score) AS n_scores,
       SUM(review_score) AS score, MAX(review_score) AS max_score, MAX(review_comment_message) AS max_message
FROM m_order_reviews GROUP BY order_id""",
    "order_facts": """
SELECT o.*, CAST(o.order_purchase_timestamp AS DATE) AS day, c.customer_unique_id, c.customer_state, c.customer_city,
       p.* EXCLUDE (order_id), i.* EXCLUDE (order_id), r.* EXCLUDE (order_id),
       GREATEST(COALESCE(n_payments, 0), 1) AS per_payment, GREATEST(COALESCE(n_items, 0), 1) AS per_item,
       GREATEST(COALESCE(n_reviews, 0), 1) AS per_review
FROM m_orders o
LEFT JOIN m_customers c ON c.customer_id = o.customer_id
LEFT JOIN order_paid p ON p.order_id = o.order_id
LEFT JOIN order_sold i ON i.order_id = o.order_id
LEFT JOIN order_rated r ON r.order_id = o.order_id""",
    "day_products": """
SELECT CAST(o.order_purchase_timestamp AS DATE) AS day, COUNT(DISTINCT i.product_id) AS unique_products
FROM m_orders o JOIN m_order_items i ON i.order_id = o.order_id GROUP BY 1""",
    "daily_metrics": f"""
SELECT day AS order_date, COUNT(*) AS num_orders, COUNT(DISTINCT customer_id) AS num_customers,
       SUM(paid * per_item) AS total_revenue, SUM(paid * per_item) / SUM(n_values * per_item) AS avg_order_value,
       CAST(COALESCE(SUM(per_payment * per_item) FILTER (order_status = 'delivered'), 0) AS BIGINT) AS delivered_orders,
       CAST(COALESCE(SUM(per_payment * per_item) FILTER (order_status = 'canceled'), 0) AS BIGINT) AS canceled_orders,
       CAST(COALESCE(SUM(per_payment * per_item) FILTER (order_status = 'shipped'), 0) AS BIGINT) AS shipped_orders,
       CAST(COALESCE(SUM(n_credit_card * per_item), 0) AS BIGINT) AS credit_card_orders,
       CAST(COALESCE(SUM(n_boleto * per_item), 0) AS BIGINT) AS boleto_orders,
       CAST(COALESCE(SUM(n_voucher * per_item), 0) AS BIGINT) AS voucher_orders,
       COUNT(DISTINCT customer_state) AS unique_states, COALESCE(ANY_VALUE(unique_products), 0) AS unique_products,
       SUM(price * per_payment) AS items_revenue, SUM(freight * per_payment) AS freight_revenue
FROM order_facts LEFT JOIN day_products USING (day)
WHERE day <= {_TODAY} GROUP BY day""",
    # An item counts once for every review of its order.
    "delivered_items": """
SELECT i.*, f.customer_id, f.order_purchase_timestamp, f.per_review,
       datesub('day', f.order_purchase_timestamp, f.order_delivered_customer_date) AS delivery_days
FROM m_order_items i JOIN order_facts f ON f.order_id = i.order_id WHERE f.order_status = 'delivered'""",
    "product_sales": """
SELECT product_id, COUNT(DISTINCT order_id) AS n_orders, COUNT(DISTINCT customer_id) AS n_buyers,
       COUNT(DISTINCT seller_id) AS unique_sellers, CAST(SUM(per_review) AS BIGINT) AS n_lines,
       SUM(price * per_review) AS total_revenue,
       SUM(price * per_review) / SUM(per_review) FILTER (price IS NOT NULL) AS avg_price,
       SUM(freight_value * per_review) AS total_freight,
       SUM(delivery_days * per_review) / CAST(SUM(per_review) FILTER (delivery_days IS NOT NULL) AS DOUBLE) AS avg_delivery_days,
       MIN(order_purchase_timestamp) AS first_sale_date, MAX(order_purchase_timestamp) AS last_sale_date
FROM delivered_items GROUP BY product_id""",
    "product_price_spread": """
SELECT d.product_id,
       CASE WHEN SUM(d.per_review) > 1
            THEN SQRT(SUM(d.per_review * (d.price - s.avg_price) * (d.price - s.avg_price)) / (SUM(d.per_review) - 1)) END
           AS price_stddev
FROM delivered_items d JOIN product_sales s ON s.product_id = d.product_id
WHERE d.price IS NOT NULL GROUP BY d.product_id""",
    "product_ratings": """
SELECT d.product_id, AVG(r.review_score) AS avg_score, STDDEV_SAMP(r.review_score) AS score_stddev,
       COUNT(r.review_id) AS n_reviews, COUNT(DISTINCT r.review_id) AS n_distinct_reviews
FROM delivered_items d JOIN m_order_reviews r ON r.order_id = d.order_id GROUP BY d.product_id""",
    "product_facts": """
SELECT s.*, r.* EXCLUDE (product_id), x.price_stddev, p.product_category_name,
       t.product_category_name_english AS english_name, CAST(p.product_weight_g AS DOUBLE) AS avg_weight_g,
       CAST(p.product_length_cm * p.product_height_cm * p.product_width_cm AS DOUBLE) AS avg_volume_cm3
FROM product_sales s
LEFT JOIN product_ratings r ON r.product_id = s.product_id
LEFT JOIN product_price_spread x ON x.product_id = s.product_id
LEFT JOIN m_products p ON p.product_id = s.product_id
LEFT JOIN m_category_translation t ON t.product_category_name = p.product_category_name""",
    "product_analytics": """
SELECT product_id, product_category_name, english_name AS product_category, total_revenue, avg_price, avg_weight_g,
       avg_volume_cm3, unique_sellers, n_orders AS total_orders, n_lines AS total_items_sold, total_freight,
       avg_score AS avg_review_score, COALESCE(n_distinct_reviews, 0) AS total_reviews, first_sale_date, last_sale_date
FROM product_facts""",
    "product_features": """
SELECT product_id, product_category_name, english_name AS category, total_revenue, avg_price, avg_weight_g, avg_volume_cm3,
       unique_sellers, n_orders AS total_sales, n_buyers AS unique_buyers, price_stddev, avg_score AS avg_rating,
       score_stddev AS rating_stddev, COALESCE(n_reviews, 0) AS review_count, avg_delivery_days,
       CAST(NTILE(10) OVER (ORDER BY n_orders, product_id) AS INTEGER) AS popularity_decile,
       CASE WHEN avg_score >= 4.5 AND n_reviews >= 10 THEN 'excellent'
            WHEN avg_score >= 4 AND n_reviews >= 5 THEN 'good'
            WHEN avg_score >= 3 THEN 'average' ELSE 'poor' END AS quality_tier,
       CAST(NTILE(5) OVER (PARTITION BY english_name ORDER BY avg_price NULLS FIRST, product_id) AS INTEGER)
           AS price_tier_in_category
FROM product_facts""",
    # What a delivered order adds to its customer; a payment counts once for every item and review.
    "customer_orders": """
SELECT *, per_item * per_review AS payment_copies, per_payment * per_item AS review_copies
FROM order_facts WHERE order_status = 'delivered'""",
    "single_orders": """
SELECT *, 1 AS payment_copies, 1 AS review_copies FROM order_facts WHERE order_status = 'delivered'""",
    "customer_goods": """
SELECT o.customer_unique_id, o.customer_state, o.customer_city, i.product_id,
       t.product_category_name_english AS category
FROM customer_orders o JOIN m_order_items i ON i.order_id = o.order_id
LEFT JOIN m_products p ON p.product_id = i.product_id
LEFT JOIN m_category_translation t ON t.product_category_name = p.product_category_name""",
    "place_goods": """
SELECT customer_unique_id, customer_state, customer_city, COUNT(DISTINCT product_id) AS unique_products_bought,
       COUNT(DISTINCT category) AS unique_categories
FROM customer_goods GROUP BY ALL""",
    "place_metrics": """
SELECT customer_unique_id, customer_state, customer_city, COUNT(*) AS total_orders,
       SUM(paid * payment_copies) AS total_spent,
       SUM(paid * payment_copies) / SUM(n_values * payment_copies) AS avg_order_value,
       SUM(score * review_copies) / CAST(SUM(n_scores * review_copies) AS DOUBLE) AS avg_review_score,
       CAST(COALESCE(SUM(n_review_ids * review_copies), 0) AS BIGINT) AS total_reviews,
       MIN(order_purchase_timestamp) AS first_order_date, MAX(order_purchase_timestamp) AS last_order_date
FROM customer_orders GROUP BY customer_unique_id, customer_state, customer_city""",
    "customer_segments": f"""
SELECT m.customer_unique_id, m.customer_state, m.customer_city, total_orders, total_spent, avg_order_value,
       COALESCE(g.unique_products_bought, 0) AS unique_products_bought,
       COALESCE(g.unique_categories, 0) AS unique_categories, avg_review_score, total_reviews,
       first_order_date, last_order_date,
       CAST(CAST(last_order_date AS DATE) - CAST(first_order_date AS DATE) AS INTEGER) AS customer_lifetime_days,
       CASE WHEN {_TODAY} - CAST(last_order_date AS DATE) <= 90 AND total_orders >= 3 AND total_spent >= 500 THEN 'VIP'
            WHEN {_TODAY} - CAST(last_order_date AS DATE) <= 180 AND total_orders >= 2 THEN 'Active'
            WHEN {_TODAY} - CAST(last_order_date AS DATE) <= 365 THEN 'At Risk'
            ELSE 'Churned' END AS customer_segment,
       CASE WHEN total_spent >= 1000 THEN 'High Value' WHEN total_spent >= 500 THEN 'Medium Value' ELSE 'Low Value' END
           AS value_tier
FROM place_metrics m LEFT JOIN place_goods g
  ON g.customer_unique_id IS NOT DISTINCT FROM m.customer_unique_id
 AND g.customer_state IS NOT DISTINCT FROM m.customer_state
 AND g.customer_city IS NOT DISTINCT FROM m.customer_city""",
    "person_goods": """
SELECT customer_unique_id, COUNT(DISTINCT product_id) AS unique_products_bought,
       COUNT(DISTINCT category) AS unique_categories
FROM customer_goods GROUP BY customer_unique_id""",
    "person_sums": f"""
SELECT customer_unique_id, COUNT(*) AS total_orders, SUM(paid * payment_copies) AS total_spent,
       SUM(paid * payment_copies) / SUM(n_values * payment_copies) AS avg_order_value,
       SUM(installments * payment_copies) / CAST(SUM(n_installments * payment_copies) AS DOUBLE) AS avg_installments,
       SUM(score * review_copies) / CAST(SUM(n_scores * review_copies) AS DOUBLE) AS avg_review_score,
       CAST(COALESCE(SUM(n_review_ids * review_copies), 0) AS BIGINT) AS total_reviews_given,
       MIN(day) AS first_order_date, MAX(day) AS last_order_date,
       MIN({{'s': customer_state, 'c': customer_city}}) AS place,
       CAST({_TODAY} - MAX(day) AS INTEGER) AS days_since_last_order,
       CAST(MAX(day) - MIN(day) AS INTEGER) AS customer_lifetime_days
FROM customer_orders GROUP BY customer_unique_id""",
    "person_payments": """
SELECT o.customer_unique_id, MIN(p.payment_value) AS min_order_value, MAX(p.payment_value) AS max_order_value,
       CASE WHEN SUM(o.payment_copies) > 1
            THEN SQRT(SUM(o.payment_copies * (p.payment_value - s.avg_order_value) * (p.payment_value - s.avg_order_value))
                      / (SUM(o.payment_copies) - 1)) END AS stddev_order_value
FROM customer_orders o JOIN m_order_payments p ON p.order_id = o.order_id
JOIN person_sums s ON s.customer_unique_id IS NOT DISTINCT FROM o.customer_unique_id
WHERE p.payment_value IS NOT NULL GROUP BY o.customer_unique_id""",
    "person_scores": """
SELECT s.*, COALESCE(g.unique_products_bought, 0) AS unique_products_bought,
       COALESCE(g.unique_categories, 0) AS unique_categories, p.min_order_value, p.max_order_value, p.stddev_order_value,
       CAST(NTILE(5) OVER (ORDER BY days_since_last_order DESC NULLS LAST, s.customer_unique_id) AS INTEGER) AS recency_score,
       CAST(NTILE(5) OVER (ORDER BY total_orders, s.customer_unique_id) AS INTEGER) AS frequency_score,
       CAST(NTILE(5) OVER (ORDER BY total_spent NULLS FIRST, s.customer_unique_id) AS INTEGER) AS monetary_score,
       NTILE(5) OVER (ORDER BY COALESCE(g.unique_products_bought, 0), s.customer_unique_id) AS products_score,
       NTILE(5) OVER (ORDER BY COALESCE(g.unique_categories, 0), s.customer_unique_id) AS categories_score
FROM person_sums s
LEFT JOIN person_goods g ON g.customer_unique_id IS NOT DISTINCT FROM s.customer_unique_id
LEFT JOIN person_payments p ON p.customer_unique_id IS NOT DISTINCT FROM s.customer_unique_id""",
    "customer_features": """
SELECT customer_unique_id, place.s AS customer_state, place.c AS customer_city, total_orders, total_spent, avg_order_value,
       stddev_order_value, min_order_value, max_order_value, avg_installments, unique_products_bought, unique_categories,
       avg_review_score, total_reviews_given, first_order_date, last_order_date, days_since_last_order,
       customer_lifetime_days, recency_score, frequency_score, monetary_score,
       CASE WHEN customer_lifetime_days = 0 THEN 0 ELSE total_orders * 30.0::DOUBLE / customer_lifetime_days END
           AS orders_per_month,
       CASE WHEN total_orders > 1 THEN customer_lifetime_days / (total_orders - 1.0::DOUBLE) END AS avg_days_between_orders,
       (frequency_score + products_score + categories_score) / 3.0::DOUBLE AS engagement_score,
       CASE WHEN total_spent >= 2000 THEN 'platinum' WHEN total_spent >= 1000 THEN 'gold'
            WHEN total_spent >= 500 THEN 'silver' ELSE 'bronze' END AS value_tier,
       CASE WHEN days_since_last_order > 365 THEN 'very_high' WHEN days_since_last_order > 180 THEN 'high'
            WHEN days_since_last_order > 90 THEN 'medium' WHEN days_since_last_order > 30 THEN 'low'
            ELSE 'very_low' END AS churn_risk,
       CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'champions'
            WHEN recency_score >= 4 AND frequency_score >= 3 THEN 'loyal_customers'
            WHEN monetary_score >= 4 THEN 'big_spenders'
            WHEN recency_score >= 3 THEN 'potential_loyalist'
            WHEN frequency_score >= 3 THEN 'at_risk'
            ELSE 'lost' END AS customer_segment
FROM person_scores""",
    "order_lookup": """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp AS order_date,
       CAST(year(o.order_purchase_timestamp) AS INTEGER) AS year,
       CAST(month(o.order_purchase_timestamp) AS INTEGER) AS month,
       COALESCE(p.payment_type, 'no_payment') AS payment_type,
       COALESCE(p.payment_value, 0.0) AS first_value, COALESCE(s.paid, 0.0) AS payment_value
FROM m_orders o
LEFT JOIN m_order_payments p ON p.order_id = o.order_id AND p.payment_sequential = 1
LEFT JOIN order_paid s ON s.order_id = o.order_id
WHERE o.order_status = 'delivered'""",
    "revenue_comparison": f"""
SELECT yesterday, avg_7d_before,
       CAST(ROUND(CAST((yesterday - avg_7d_before) / avg_7d_before * 100 AS DECIMAL(24, 8)), 2) AS DOUBLE) AS pct_change
FROM (SELECT COALESCE(SUM(total_revenue) FILTER (order_date = {_TODAY} - 1), 0) AS yesterday,
             AVG(total_revenue) FILTER (order_date BETWEEN {_TODAY} - 8 AND {_TODAY} - 2) AS avg_7d_before
      FROM daily_metrics)""",
    "cancellations": f"""
SELECT CAST(ROUND(CAST(COUNT(*) FILTER (order_status = 'canceled') * 100.0::DOUBLE / COUNT(*) AS DECIMAL(24, 8)), 2) AS DOUBLE)
           AS cancel_rate
FROM order_facts WHERE day = {_TODAY} - 1""",
    "inactive": "SELECT COUNT(*) AS at_risk_count FROM customer_features WHERE days_since_last_order BETWEEN 60 AND 90",
    "alerts": """
SELECT 'CRITICAL' AS type, 'Revenue Drop Alert' AS title,
       printf('Revenue dropped %.1f%% vs 7-day average', abs(pct_change)) AS message
FROM revenue_comparison WHERE pct_change < -20
UNION ALL
SELECT 'WARNING', 'High Cancellation Rate',
       'Cancellation rate at ' || CAST(cancel_rate AS VARCHAR) || '% (threshold: 5%)'
FROM cancellations WHERE cancel_rate > 5
UNION ALL
SELECT 'INFO', 'Churn Risk Alert',
       CAST(at_risk_count AS VARCHAR) || ' customers at risk of churning (60-90 days inactive)'
FROM inactive WHERE at_risk_count > 100""",
    "kpis": f"""
SELECT {_TODAY} AS report_date, orders_yesterday, revenue_yesterday, avg_revenue_7d, champions_count,
       at_risk_customers, top_rated_products
FROM (SELECT CAST(COALESCE(SUM(num_orders) FILTER (order_date = {_TODAY} - 1), 0) AS BIGINT) AS orders_yesterday,
             SUM(total_revenue) FILTER (order_date = {_TODAY} - 1) AS revenue_yesterday,
             AVG(total_revenue) FILTER (order_date >= {_TODAY} - 7) AS avg_revenue_7d FROM daily_metrics)
CROSS JOIN (SELECT COUNT(*) FILTER (customer_segment = 'champions') AS champions_count,
                   COUNT(*) FILTER (churn_risk IN ('high', 'very_high')) AS at_risk_customers
            FROM customer_features)
CROSS JOIN (SELECT COUNT(*) FILTER (avg_review_score >= 4.5) AS top_rated_products FROM product_analytics)""",
    # Events as the damaged messages of `files._messages` carry them; n tells the damage.
    "messages": """
SELECT *, CAST(event_id AS BIGINT) % 50 AS n,
       CASE WHEN CAST(event_id AS BIGINT) % 50 <> 4 THEN payment_value END AS paid
FROM m_events""",
    "good_events": """
SELECT event_id, event_type, order_id, customer_id, product_id, order_status, paid AS payment_value,
       strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
       CASE WHEN COALESCE(paid, 0) >= 200 THEN 'high' WHEN COALESCE(paid, 0) >= 100 THEN 'medium' ELSE 'low' END
           AS value_category,
       CASE WHEN hour(event_ts) BETWEEN 6 AND 11 THEN 'morning' WHEN hour(event_ts) BETWEEN 12 AND 17 THEN 'afternoon'
            WHEN hour(event_ts) >= 18 THEN 'evening' ELSE 'night' END AS time_of_day,
       CASE WHEN n = 5 THEN '' ELSE 'web' END AS metadata_source,
       CASE WHEN n = 5 THEN '' ELSE '1.0' END AS metadata_version, event_ts
FROM messages WHERE n > 3""",
    "minute_metrics": """
SELECT event_type, time_bucket(INTERVAL '1' MINUTE, event_ts) AS window_start,
       time_bucket(INTERVAL '1' MINUTE, event_ts) + INTERVAL '1' MINUTE AS window_end,
       COUNT(*) AS event_count, SUM(COALESCE(payment_value, 0)) AS revenue,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT order_id) AS unique_orders
FROM good_events GROUP BY 1, 2, 3""",
    "five_minute_metrics": """
SELECT time_bucket(INTERVAL '1' MINUTE, event_ts) - INTERVAL '1' MINUTE * k AS window_start,
       time_bucket(INTERVAL '1' MINUTE, event_ts) + INTERVAL '1' MINUTE * (5 - k) AS window_end,
       COUNT(*) AS event_count, SUM(COALESCE(payment_value, 0)) AS revenue,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT order_id) AS unique_orders
FROM good_events, range(5) AS r(k) GROUP BY 1, 2""",
}

_SUMMARY = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def _profile(*parts: str) -> str:
    """A profile as the union of `SELECT section, item, value, text` parts."""
    return "SELECT section, item, ROUND(value, 6) AS value, text FROM (\n" + "\nUNION ALL\n".join(parts) + ")"


def _value(section: str, item: str, value: str, rest: str) -> str:
    return (
        f"SELECT '{section}' AS section, {item} AS item, CAST({value} AS DOUBLE) AS value, "
        f"CAST(NULL AS VARCHAR) AS text FROM {rest}"
    )


def _shape(table: str, columns: int, *more: tuple[str, str]) -> list[str]:
    facts = [("rows", "COUNT(*)"), ("columns", f"MAX({columns})"), *more]
    return [_value("shape", f"'{name}'", expr, table) for name, expr in facts]


def _freq(table: str, column: str, n: int | None = None) -> str:
    keep = f" ORDER BY n DESC, {column} LIMIT {n}" if n else ""
    inner = f"(SELECT {column}, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1{keep})"
    return _value(column, f"CAST({column} AS VARCHAR)", "n", inner)


def _nulls(table: str, columns: list[str]) -> list[str]:
    return [_value("nulls", f"'{c}'", f"COUNT(*) - COUNT({c})", table) for c in columns]


def _describe(table: str, column: str, section: str = "describe") -> list[str]:
    sql = {
        "count": "COUNT({c})", "mean": "AVG({c})", "std": "STDDEV_SAMP({c})", "min": "MIN({c})", "max": "MAX({c})",
        "25%": "QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25)", "50%": "QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5)",
        "75%": "QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75)",
    }
    return [_value(section, f"'{column}.{s}'", sql[s].format(c=column), table) for s in _SUMMARY]


def _comments(score: int) -> str:
    return (
        f"SELECT 'comments_{score}', review_id, CAST(NULL AS DOUBLE), substr(review_comment_message, 1, 200) || '...' "
        f"FROM (SELECT * FROM m_order_reviews WHERE review_score = {score} AND review_comment_message IS NOT NULL "
        "ORDER BY review_id LIMIT 3)"
    )


RAW_VIEWS = {
    name: ("m_category_translation" if name == "product_category_translation" else f"m_{name}") for name in RAW
}
_DELIVERY = (
    "(SELECT floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS d "
    "FROM m_orders)"
)
_ROUND2 = "CAST(ROUND(CAST({} AS DECIMAL(24, 8)), 2) AS DOUBLE)"
_METRICS = (
    f"event_count, {_ROUND2.format('revenue')} AS total_revenue, "
    f"{_ROUND2.format('ROUND(revenue, 6) / event_count')} AS avg_order_value, unique_customers, unique_orders"
)
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ') AS {0}"
_EVENT_ROWS = "SELECT * EXCLUDE (event_ts) REPLACE (ROUND(payment_value, 6) AS payment_value) FROM good_events"

_ENRICHED = f"""
SELECT order_id, customer_id, customer_unique_id, customer_city, customer_state, order_status, order_purchase_timestamp,
       order_delivered_customer_date, order_estimated_delivery_date,
       datesub('day', order_purchase_timestamp, order_delivered_customer_date) AS delivery_time_days,
       datesub('day', order_estimated_delivery_date, order_delivered_customer_date) AS delivery_delay_days,
       COALESCE(n_payments, 0) * {{times}} AS n_payment_entries,
       COALESCE(n_credit_card, 0) * {{times}} AS n_credit_card, COALESCE(n_boleto, 0) * {{times}} AS n_boleto,
       COALESCE(n_voucher, 0) * {{times}} AS n_voucher, COALESCE(n_debit_card, 0) * {{times}} AS n_debit_card,
       ROUND(credit_card_amount * {{times}}, 6) AS credit_card_amount, ROUND(boleto_amount * {{times}}, 6) AS boleto_amount,
       ROUND(voucher_amount * {{times}}, 6) AS voucher_amount, ROUND(debit_card_amount * {{times}}, 6) AS debit_card_amount,
       ROUND(paid * {{times}}, 6) AS total_payment, max_installments, max_score AS review_score,
       max_message AS review_comment, '{AS_OF}' AS processing_date
FROM order_facts WHERE day <= {_TODAY}"""
_MONTHLY = """
SELECT strftime(order_date, '%Y-%m') AS year_month, COUNT(*) AS total_orders,
       ROUND(SUM({0}), 6) AS total_revenue, ROUND(AVG({0}), 6) AS avg_order_value
FROM order_lookup GROUP BY 1"""

DERIVED["single_metrics"] = DERIVED["place_metrics"].replace("FROM customer_orders", "FROM single_orders")
DERIVED["single_segments"] = DERIVED["customer_segments"].replace("FROM place_metrics", "FROM single_metrics")

QUERIES = {
    "orders_enriched": _ENRICHED.format(times="per_review"),
    "orders_enriched_grain_safe": _ENRICHED.format(times="1"),
    "order_payment_lines": f"""
SELECT order_id, payment_sequential, payment_type, ROUND(payment_value, 6) AS payment_value, payment_installments,
       CAST(GREATEST((SELECT COUNT(*) FROM m_order_reviews r WHERE r.order_id = p.order_id), 1) AS BIGINT) AS copies
FROM m_order_payments p JOIN m_orders USING (order_id) WHERE {_PAST}""",
    "product_analytics": _rounded(
        "product_analytics", "total_revenue", "avg_price", "total_freight", "avg_weight_g", "avg_volume_cm3",
        "avg_review_score",
    ),
    "daily_metrics": _rounded(
        "daily_metrics", "total_revenue", "avg_order_value", "items_revenue", "freight_revenue"
    ),
    "customer_segments": _rounded("customer_segments", "total_spent", "avg_order_value", "avg_review_score"),
    "customer_segments_grain_safe": _rounded("single_segments", "total_spent", "avg_order_value", "avg_review_score"),
    "customer_features": _rounded(
        "customer_features", "total_spent", "avg_order_value", "stddev_order_value", "min_order_value",
        "max_order_value", "avg_installments", "avg_review_score", "orders_per_month", "avg_days_between_orders",
        "engagement_score",
    ),
    "product_features": _rounded(
        "product_features", "total_revenue", "avg_price", "price_stddev", "avg_rating", "rating_stddev",
        "avg_weight_g", "avg_volume_cm3", "avg_delivery_days",
    ),
}


QUERIES.update({
    "daily_metrics_grain_safe": """
SELECT CAST(o.order_purchase_timestamp AS DATE) AS order_date, COUNT(*) AS num_orders,
       COUNT(DISTINCT o.customer_id) AS num_customers, ROUND(SUM(p.paid), 6) AS total_revenue,
       ROUND(SUM(p.paid) / SUM(p.n), 6) AS avg_order_value,
       COUNT(*) FILTER (o.order_status = 'delivered') AS delivered_orders,
       COUNT(*) FILTER (o.order_status = 'canceled') AS canceled_orders,
       COUNT(*) FILTER (o.order_status = 'shipped') AS shipped_orders,
       CAST(SUM(cc) AS BIGINT) AS credit_card_orders, CAST(SUM(bo) AS BIGINT) AS boleto_orders,
       CAST(SUM(vo) AS BIGINT) AS voucher_orders, COUNT(DISTINCT c.customer_state) AS unique_states,
       COALESCE(ANY_VALUE(u.n), 0) AS unique_products, ROUND(SUM(i.price), 6) AS items_revenue,
       ROUND(SUM(i.freight), 6) AS freight_revenue
FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id
LEFT JOIN (SELECT order_id, SUM(payment_value) AS paid, COUNT(payment_value) AS n,
                  COUNT(*) FILTER (payment_type = 'credit_card') AS cc, COUNT(*) FILTER (payment_type = 'boleto') AS bo,
                  COUNT(*) FILTER (payment_type = 'voucher') AS vo FROM m_order_payments GROUP BY 1) p
  ON o.order_id = p.order_id
LEFT JOIN (SELECT order_id, SUM(price) AS price, SUM(freight_value) AS freight FROM m_order_items GROUP BY 1) i
  ON o.order_id = i.order_id
LEFT JOIN (SELECT CAST(o.order_purchase_timestamp AS DATE) AS d, COUNT(DISTINCT x.product_id) AS n
           FROM m_orders o JOIN m_order_items x ON o.order_id = x.order_id GROUP BY 1) u
  ON u.d = CAST(o.order_purchase_timestamp AS DATE)
WHERE CAST(o.order_purchase_timestamp AS DATE) <= DATE '2001-08-01' GROUP BY 1""",
    "monthly_metrics": _MONTHLY.format("payment_value"),
    "monthly_metrics_first_payment": _MONTHLY.format("first_value"),
    "monthly_labels": """
SELECT strftime(order_date, '%Y-%m') AS year_month, 'type' AS kind, payment_type AS label, COUNT(*) AS n,
       ROUND(SUM(payment_value), 6) AS revenue
FROM order_lookup GROUP BY 1, 3
UNION ALL
SELECT strftime(order_date, '%Y-%m'), 'status', order_status, COUNT(*), ROUND(SUM(payment_value), 6)
FROM order_lookup GROUP BY 1, 3""",
    "monthly_metrics_json": """
SELECT year_month, SUM(n) OVER (PARTITION BY year_month, histogram)::BIGINT AS total_orders, histogram, label, n
FROM (SELECT strftime(order_date, '%Y-%m') AS year_month, 'payment_types' AS histogram, payment_type AS label,
             COUNT(*) AS n FROM order_lookup GROUP BY ALL
      UNION ALL
      SELECT strftime(order_date, '%Y-%m'), 'order_statuses', order_status, COUNT(*) FROM order_lookup GROUP BY ALL)""",
    "order_payment_lookup": """
SELECT * EXCLUDE (first_value) REPLACE (ROUND(payment_value, 6) AS payment_value) FROM order_lookup""",
    "order_payment_lookup_first": """
SELECT * EXCLUDE (first_value) REPLACE (ROUND(first_value, 6) AS payment_value) FROM order_lookup""",
    "daily_kpis": """
SELECT * REPLACE (ROUND(revenue_yesterday, 6) AS revenue_yesterday, ROUND(avg_revenue_7d, 6) AS avg_revenue_7d)
FROM kpis""",
    "top_products_daily": f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY total DESC, product_id) AS INTEGER) AS rank, product_id, category, orders,
       ROUND(total, 6) AS revenue,
       ROUND(CAST(ROUND(CAST(rating AS DECIMAL(24, 8)), 2) AS DOUBLE), 6) AS avg_rating,
       {_TODAY} - 1 AS report_date
FROM (SELECT i.product_id, ANY_VALUE(t.product_category_name_english) AS category, COUNT(DISTINCT f.order_id) AS orders,
             SUM(i.price * f.per_review) AS total, SUM(f.score) / CAST(SUM(f.n_scores) AS DOUBLE) AS rating
      FROM order_facts f JOIN m_order_items i ON i.order_id = f.order_id
      LEFT JOIN m_products p ON p.product_id = i.product_id
      LEFT JOIN m_category_translation t ON t.product_category_name = p.product_category_name
      WHERE f.{_DELIVERED} AND f.day = {_TODAY} - 1 GROUP BY i.product_id)
ORDER BY rank LIMIT 10""",
    "revenue_drop_alert": """
SELECT ROUND(yesterday, 6) AS yesterday, ROUND(avg_7d_before, 6) AS avg_7d_before,
       ROUND(pct_change, 6) AS pct_change, COALESCE(pct_change < -20, false) AS alert
FROM revenue_comparison""",
    "cancellation_alert": """
SELECT ROUND(cancel_rate, 6) AS cancel_rate, COALESCE(cancel_rate > 5, false) AS alert FROM cancellations""",
    "churn_alert": "SELECT at_risk_count, at_risk_count > 100 AS alert FROM inactive",
    "business_alerts": "SELECT * FROM alerts",
    "daily_report": """
SELECT * REPLACE (ROUND(revenue_yesterday, 6) AS revenue_yesterday, ROUND(avg_revenue_7d, 6) AS avg_revenue_7d),
       (SELECT COALESCE(STRING_AGG(message, '; ' ORDER BY type, title, message), '') FROM alerts) AS alerts
FROM kpis""",
    "top_cities": """
SELECT customer_city, customer_state, COUNT(*) AS num_customers FROM m_customers GROUP BY 1, 2
ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "revenue_by_month": f"""
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, COUNT(DISTINCT order_id) AS num_orders,
       ROUND(SUM(payment_value), 6) AS total_revenue, ROUND(SUM(payment_value) * 0.20::DOUBLE, 6) AS revenue_usd
FROM m_orders JOIN m_order_payments USING (order_id) WHERE {_DELIVERED}
GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
    "top_categories": f"""
SELECT product_category_name, product_category_name_english,
       COALESCE(NULLIF(product_category_name_english, ''), product_category_name) AS category,
       COUNT(DISTINCT order_id) AS num_orders
FROM m_order_items JOIN m_products USING (product_id) LEFT JOIN m_category_translation USING (product_category_name)
WHERE product_category_name IS NOT NULL
GROUP BY ALL ORDER BY num_orders DESC, product_category_name LIMIT 10""",
    "volume_class": """
SELECT COUNT(*) AS order_count,
       CASE WHEN COUNT(*) > 1000 THEN 'full_processing' ELSE 'quick_processing' END AS strategy
FROM m_orders WHERE CAST(order_purchase_timestamp AS DATE) = DATE '2001-07-31'""",
    "segment_distribution": "SELECT customer_segment, COUNT(*) AS n FROM customer_features GROUP BY 1",
    "latest_daily_metrics": QUERIES["daily_metrics"] + " ORDER BY order_date DESC LIMIT 5",
    "orders_by_month": """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, COUNT(*) AS n FROM m_orders GROUP BY 1""",
    "top_states": """
SELECT customer_state, COUNT(*) AS n FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "run_health": f"""
SELECT e.dag_id, runs, success, failed, ROUND(avg_duration_min, 6) AS avg_duration_min, status,
       CASE WHEN status = 'NO_RUNS' THEN 'No runs in last 24 hours' END AS message,
       status IN ('UNHEALTHY', 'NO_RUNS') AS needs_attention
FROM (SELECT e.dag_id, runs, success, failed,
             CAST(ROUND(CAST(minutes AS DECIMAL(24, 8)), 2) AS DOUBLE) AS avg_duration_min,
             CASE WHEN runs IS NULL THEN 'NO_RUNS' WHEN failed > 2 THEN 'UNHEALTHY'
                  WHEN success / runs < 0.8 THEN 'DEGRADED' ELSE 'HEALTHY' END AS status
      FROM (VALUES {", ".join(f"('{p}')" for p in PIPELINES)}) e(dag_id)
      LEFT JOIN (SELECT dag_id, COUNT(*) AS runs, COUNT(*) FILTER (state = 'success') AS success,
                        COUNT(*) FILTER (state = 'failed') AS failed,
                        COALESCE(AVG((epoch_us(end_date) - epoch_us(start_date)) / 60000000.0::DOUBLE), 0) AS minutes
                 FROM (SELECT * FROM m_run_log WHERE execution_date >= TIMESTAMP '2024-01-30'
                       QUALIFY ROW_NUMBER() OVER (PARTITION BY dag_id ORDER BY execution_date DESC, run_id) <= 10)
                 GROUP BY 1) s ON e.dag_id = s.dag_id) e""",
    "slow_tasks": """
SELECT dag_id, task_id, ROUND(AVG((epoch_us(end_date) - epoch_us(start_date)) / 1000000.0::DOUBLE), 6) AS avg_duration_sec
FROM m_task_log
WHERE start_date >= TIMESTAMP '2024-01-30' AND end_date IS NOT NULL AND state = 'success'
GROUP BY 1, 2 HAVING AVG((epoch_us(end_date) - epoch_us(start_date)) / 1000000.0::DOUBLE) > 1800""",
    "output_row_counts": "SELECT table_name, n_rows, n_rows > 0 AS not_empty FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM {source}" for name, source in {
            "orders_enriched": f"m_orders WHERE {_PAST}",
            "order_payment_lines": f"m_orders JOIN m_order_payments USING (order_id) WHERE {_PAST}",
            "product_analytics": "product_analytics",
            "daily_metrics": "daily_metrics",
            "customer_segments": "customer_segments",
            "monthly_metrics": "(SELECT DISTINCT strftime(order_date, '%Y-%m') FROM order_lookup)",
            "ml_customer_features": "customer_features",
            "ml_product_features": "product_features",
            "report_daily_kpis": "kpis",
            "report_top_products_daily": f"""(
                SELECT DISTINCT product_id FROM m_order_items JOIN m_orders USING (order_id)
                WHERE {_DELIVERED} AND CAST(order_purchase_timestamp AS DATE) = {_TODAY} - 1 LIMIT 10)""",
            "business_alerts": "alerts",
            "daily_report": "kpis",
        }.items()
    ) + ")",
    "table_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows, COUNT(*) > 0 AS not_empty FROM {v}"
        for name, v in RAW_VIEWS.items()
    ),
    "orders_quality_gate": """
SELECT COUNT(*) AS total_orders, COUNT(*) - COUNT(DISTINCT order_id) AS duplicate_order_ids,
       CAST(SUM((order_id IS NULL)::INT + (customer_id IS NULL)::INT + (order_status IS NULL)::INT
           + (order_purchase_timestamp IS NULL)::INT) AS BIGINT) AS null_values,
       '' AS missing_columns, COUNT(*) > 0 AND COUNT(*) = COUNT(DISTINCT order_id) AS passed
FROM m_orders""",
    "daily_load_check": """
SELECT COUNT(*) > 0 AS arrived FROM m_orders WHERE CAST(order_purchase_timestamp AS DATE) = DATE '2001-08-01'""",
    "schema_check": "\nUNION ALL\n".join(
        f"SELECT 'orders' AS table_name, '{c}' AS column_name, true AS present, COUNT({c}) AS n_values FROM m_orders"
        for c in REQUIRED_OF_ORDERS.split()
    ),
    "data_freshness": "SELECT MAX(order_purchase_timestamp) AS last_order FROM m_orders",
    "valid_order_ids": """
SELECT order_id, length(order_id) = 32 AND regexp_full_match(order_id, '[0-9a-zA-Z]+') AS valid
FROM (SELECT CASE CAST(order_id AS BIGINT) % 4 WHEN 0 THEN order_id WHEN 1 THEN md5(order_id)
                  WHEN 2 THEN substr(md5(order_id), 1, 31) || '-' ELSE md5(order_id) || 'a' END AS order_id
      FROM m_orders)""",
    "valid_payments": """
SELECT order_id, payment_sequential, ROUND((payment_value - 100) * 60, 6) AS value,
       (payment_value - 100) * 60 > 0 AND (payment_value - 100) * 60 < 10000 AS valid
FROM m_order_payments""",
    "orphan_orders": """
SELECT COUNT(*) AS orphan_count FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id
WHERE c.customer_id IS NULL""",
    "integrity_report": "\nUNION ALL\n".join(
        f"SELECT '{child}' AS child, '{key}' AS key, '{parent}' AS parent, COUNT(*) AS orphan_keys "
        f"FROM (SELECT DISTINCT {key} FROM m_{child} EXCEPT SELECT {key} FROM m_{parent})"
        for child, key, parent in REFERENCES
    ),
    "null_report": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, n AS null_cells, ROUND(n / cells * 100.0::DOUBLE, 6) AS null_pct FROM ("
        f"SELECT CAST({' + '.join(f'COUNT(*) - COUNT({f})' for f in RAW[name].split())} AS BIGINT) AS n, "
        f"COUNT(*) * {len(RAW[name].split())}.0::DOUBLE AS cells FROM {v})"
        for name, v in RAW_VIEWS.items()
    ),
    "duplicate_report": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, a - b AS duplicate_rows, ROUND((a - b) / a::DOUBLE * 100, 6) AS duplicate_pct "
        f"FROM (SELECT (SELECT COUNT(*) FROM {v}) AS a, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {v})) AS b)"
        for name, v in RAW_VIEWS.items()
    ),
    "profile_customers": _profile(
        *_shape("m_customers", 5, ("unique_people", "COUNT(DISTINCT customer_unique_id)"),
                ("customer_ids", "COUNT(DISTINCT customer_id)"),
                ("difference", "COUNT(DISTINCT customer_id) - COUNT(DISTINCT customer_unique_id)")),
        _freq("m_customers", "customer_state", 10), _freq("m_customers", "customer_city", 10),
        *_nulls("m_customers", RAW["customers"].split()),
    ),
    "profile_orders": _profile(
        *_shape("m_orders", 8), _freq("m_orders", "order_status"),
        "SELECT 'range', 'first', NULL, strftime(MIN(order_purchase_timestamp), '%Y-%m-%dT%H:%M:%SZ') FROM m_orders",
        "SELECT 'range', 'last', NULL, strftime(MAX(order_purchase_timestamp), '%Y-%m-%dT%H:%M:%SZ') FROM m_orders",
        _value("year_month", "ym", "n", "(SELECT strftime(order_purchase_timestamp, '%Y-%m') AS ym, COUNT(*) AS n "
               "FROM m_orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12)"),
        _value("delivery_days", "'mean'", "AVG(d)", _DELIVERY), _value("delivery_days", "'min'", "MIN(d)", _DELIVERY),
        _value("delivery_days", "'max'", "MAX(d)", _DELIVERY),
        _value("delivery_days", "'delivery_days.median'", "MEDIAN(d)", _DELIVERY),
        *_nulls("m_orders", RAW["orders"].split()),
    ),
    "profile_items": _profile(
        *_shape("m_order_items", 7), *_describe("m_order_items", "price"),
        *_describe("m_order_items", "freight_value"),
        _value("per_order", "'mean'", "AVG(n)", "(SELECT COUNT(*) AS n FROM m_order_items GROUP BY order_id)"),
        _value("per_order", "'max'", "MAX(n)", "(SELECT COUNT(*) AS n FROM m_order_items GROUP BY order_id)"),
        _value("items_per_order", "CAST(k AS VARCHAR)", "n", "(SELECT k, COUNT(*) AS n FROM (SELECT COUNT(*) AS k "
               "FROM m_order_items GROUP BY order_id) GROUP BY 1 ORDER BY n DESC, k LIMIT 10)"),
        _freq("m_order_items", "product_id", 10), _freq("m_order_items", "seller_id", 10),
    ),
    "profile_payments": _profile(
        *_shape("m_order_payments", 5), _freq("m_order_payments", "payment_type"),
        _freq("m_order_payments", "payment_installments", 15), *_describe("m_order_payments", "payment_value"),
        *[
            _value(f"{name}_by_type", "payment_type", f"{f}(payment_value)",
                   "m_order_payments WHERE payment_type IS NOT NULL GROUP BY payment_type")
            for name, f in (("mean", "AVG"), ("count", "COUNT"), ("median", "MEDIAN"))
        ],
        _value("revenue", "'total'", "SUM(payment_value)", "m_order_payments"),
        _value("revenue", "'total_usd'", "SUM(payment_value) * 0.20::DOUBLE", "m_order_payments"),
    ),
    "profile_reviews": _profile(
        *_shape("m_order_reviews", 7), _freq("m_order_reviews", "review_score"),
        *[
            _value("content", f"'{name}'", expr, "m_order_reviews") for name, expr in (
                ("mean_score", "AVG(review_score)"),
                ("with_title", "COUNT(review_comment_title)"),
                ("with_title_pct", "COUNT(review_comment_title) / COUNT(*) * 100.0::DOUBLE"),
                ("with_message", "COUNT(review_comment_message)"),
                ("with_message_pct", "COUNT(review_comment_message) / COUNT(*) * 100.0::DOUBLE"),
            )
        ],
        _comments(1), _comments(5),
    ),
    "profile_products": _profile(
        *_shape("m_products", 9, ("without_category", "COUNT(*) - COUNT(product_category_name)")),
        _freq("m_products", "product_category_name", 20),
        *[p for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
          for p in _describe("m_products", c)],
        _freq("m_products", "product_photos_qty", 10),
    ),
    "profile_sellers": _profile(
        *_shape("m_sellers", 4), _freq("m_sellers", "seller_state"), _freq("m_sellers", "seller_city", 15),
    ),
    "load_csv": "SELECT * FROM m_orders",
    "load_csv_infer": """
SELECT CAST(order_id AS INTEGER) AS order_id, CAST(payment_sequential AS INTEGER) AS payment_sequential, payment_type,
       CAST(payment_installments AS INTEGER) AS payment_installments, ROUND(payment_value, 6) AS payment_value
FROM m_order_payments""",
    "load_reviews": """
SELECT * REPLACE ('"' || review_comment_message || '", she said' || chr(10) || 'and left' AS review_comment_message)
FROM m_order_reviews""",
    "load_reviews_rejects": """
SELECT CASE WHEN n % 101 <> 0 THEN review_id END AS review_id, order_id,
       CASE WHEN n % 97 = 0 THEN 'five' ELSE CAST(review_score AS VARCHAR) END AS review_score,
       CASE WHEN n % 89 = 0 THEN 'wrong number of fields' WHEN n % 101 = 0 THEN 'missing review_id'
            ELSE 'bad review_score' END AS reason
FROM (SELECT *, CAST(order_id AS BIGINT) AS n FROM m_order_reviews)
WHERE n % 89 = 0 OR n % 101 = 0 OR n % 97 = 0""",
    "load_all": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, true AS loaded, COUNT(*) AS n_rows FROM {v}" for name, v in RAW_VIEWS.items()
    ),
    "load_daily_orders": "SELECT *, DATE '2001-08-01' AS load_date FROM m_orders",
    "load_summary": """
SELECT COUNT(*) FILTER (CAST(order_purchase_timestamp AS DATE) = DATE '2001-08-01') AS rows_loaded,
       COUNT(*) AS total_rows FROM m_orders""",
    "landing_missing": "SELECT '2001-08-01/order_items_dataset.csv' AS path",
    "orders_partitioned": "SELECT *, CAST(order_purchase_timestamp AS DATE) AS order_date FROM m_orders",
    "partition_stats": """
SELECT CAST(order_purchase_timestamp AS DATE) AS partition_id, COUNT(*) AS total_rows, true AS has_size
FROM m_orders GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    "realtime_orders": _EVENT_ROWS,
    "realtime_rejects": """
SELECT event_id, CASE n WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'bad payment_value'
                        WHEN 2 THEN 'bad event_timestamp' ELSE 'no event_type' END AS reason
FROM messages WHERE n <= 3""",
    "realtime_metrics": f"SELECT event_type, window_start, window_end, {_METRICS} FROM minute_metrics",
    "rolling_metrics": f"SELECT window_start, window_end, {_METRICS} FROM five_minute_metrics",
    "latest_events": _EVENT_ROWS + " ORDER BY event_ts DESC, event_id LIMIT 10",
    "stream_realtime_metrics": f"SELECT event_type, {_ISO.format('window_start')}, {_ISO.format('window_end')}, "
    f"{_METRICS} FROM minute_metrics",
    "stream_rolling_metrics": f"SELECT {_ISO.format('window_start')}, {_ISO.format('window_end')}, "
    f"{_METRICS} FROM five_minute_metrics",
    # The first run brings all but every twentieth event; its newest event less the delay is the watermark of the second.
    "stream_late_events": """
SELECT COUNT(*) AS n_late, true AS dropped_by_engine FROM good_events
WHERE CAST(event_id AS BIGINT) % 20 = 7 AND time_bucket(INTERVAL '1' MINUTE, event_ts) + INTERVAL '1' MINUTE
    <= (SELECT date_trunc('millisecond', MAX(event_ts)) FROM good_events WHERE CAST(event_id AS BIGINT) % 20 <> 7)
       - INTERVAL '10' MINUTE""",
    "binary_messages": _EVENT_ROWS,
    "table_sizes": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows, true AS has_size FROM {v}" for name, v in RAW_VIEWS.items()
    ),
})
QUERIES["load_rejects"] = QUERIES["load_reviews_rejects"]
QUERIES["load_counts"] = f"""
SELECT 'none' AS allowed, 'order_reviews' AS table_name, true AS loaded, total - bad AS n_loaded, bad AS n_rejected,
       CAST(NULL AS VARCHAR) AS error
FROM (SELECT COUNT(*) AS total FROM m_order_reviews), (SELECT COUNT(*) AS bad FROM ({QUERIES["load_rejects"]}))
UNION ALL
SELECT '0', 'order_reviews', false, NULL, NULL, 'order_reviews: ' || bad || ' bad rows, 0 allowed'
FROM (SELECT COUNT(*) AS bad FROM ({QUERIES["load_rejects"]}))"""
QUERIES["catalog_revenue_by_month"] = QUERIES["revenue_by_month"]
QUERIES["stream_realtime_orders"] = QUERIES["realtime_orders"]
QUERIES["latest_daily_metrics_stored"] = QUERIES["latest_daily_metrics"]
QUERIES["daily_metrics_incremental"] = QUERIES["daily_metrics"]
QUERIES["stream_redelivered"] = QUERIES["stream_realtime_metrics"]
QUERIES["stream_realtime_rejects"] = QUERIES["realtime_rejects"]


def _off_ties(sql: str) -> str:
    """Every `ROUND(x, 6)` with `OFF_TIE` added to x, as `queries.comparable` does."""
    return sql.replace(", 6)", f" + {OFF_TIE:.10f}, 6)")


def _with_parts(sql: str) -> str:
    """`sql` with every view and derived result it names in front of it."""
    parts: dict[str, str] = {}

    def add(text: str) -> None:
        for name in re.findall(r"\b\w+\b", text):
            if name in parts:
                continue
            if name in VIEWS:
                body = VIEWS[name]
                parts[name] = body.format(**{t: t for t in _names(body)})
            elif name in DERIVED and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                add(DERIVED[name])
                parts[name] = DERIVED[name]

    add(sql)
    if not parts:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in parts.items()) + sql


def oracle_sql() -> dict[str, str]:
    return {name: _with_parts(_off_ties(sql)) for name, sql in QUERIES.items()}
