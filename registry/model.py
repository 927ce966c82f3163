"""Views that give the test tables the shape of the raw tables (see FIXTURES.md).

One text serves both engines: `{name}` is a test table, a DataFrame in Spark and a
plain table name in the SQL of the check.
"""

from __future__ import annotations

import datetime as dt
import string

from pyspark.sql import DataFrame, SparkSession

from tradewinds import schemas
from tradewinds.session import prepare
from tradewinds.tables import RawTables

AS_OF = dt.date(2001, 8, 1)
RUN_TIME = dt.datetime(2024, 1, 31)

# The money of the views lies on a grid of 6 decimals, so averages often fall right
# between two 6-place numbers, where the last bit of a sum decides. Both sides add
# this before rounding.
OFF_TIE = 0.0000000037

VIEWS = {
    "m_customers": """
SELECT CAST(c_custkey AS STRING) AS customer_id,
       CAST(c_custkey - c_custkey % 2 AS STRING) AS customer_unique_id,
       CAST(c_nationkey AS STRING) AS customer_zip_code_prefix,
       c_mktsegment AS customer_city, n_name AS customer_state
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "m_orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
       CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
       CAST(o_orderdate + INTERVAL '1' DAY AS TIMESTAMP) AS order_approved_at,
       CAST(lo AS TIMESTAMP) AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(hi + INTERVAL '13' HOUR AS TIMESTAMP) END
           AS order_delivered_customer_date,
       CAST(o_orderdate + INTERVAL '25' DAY AS TIMESTAMP) AS order_estimated_delivery_date
FROM {orders} LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS lo, MAX(l_shipdate) AS hi
                         FROM {lineitem} GROUP BY l_orderkey) s ON o_orderkey = l_orderkey""",
    "m_order_items": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
       CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
       CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
       l_extendedprice / 1000 AS price, l_extendedprice * l_tax / 100 AS freight_value
FROM {lineitem}""",
    "m_order_payments": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
       CASE o_orderpriority WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher'
            WHEN '4-NOT SPECIFIED' THEN 'debit_card' ELSE 'credit_card' END AS payment_type,
       1 + o_orderkey % 10 AS payment_installments,
       CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice / 2000 ELSE o_totalprice / 1000 END AS payment_value
FROM {orders}
UNION ALL
SELECT CAST(o_orderkey AS STRING), CAST(2 AS BIGINT), 'voucher', CAST(1 AS BIGINT), o_totalprice / 2000
FROM {orders} WHERE o_orderkey % 5 = 0""",
    "m_order_reviews": """
SELECT CAST(o_orderkey AS STRING) AS review_id, CAST(o_orderkey AS STRING) AS order_id,
       1 + o_orderkey % 5 AS review_score,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS review_comment_title,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS review_comment_message,
       CAST(o_orderdate AS TIMESTAMP) AS review_creation_date,
       CAST(o_orderdate + INTERVAL '2' DAY AS TIMESTAMP) AS review_answer_timestamp
FROM {orders} WHERE o_orderkey % 10 <> 0
UNION ALL
SELECT CAST(-o_orderkey AS STRING), CAST(o_orderkey AS STRING), CAST(3 AS BIGINT), NULL, NULL,
       CAST(o_orderdate AS TIMESTAMP), CAST(o_orderdate + INTERVAL '3' DAY AS TIMESTAMP)
FROM {orders} WHERE o_orderkey % 50 = 1""",
    "m_products": """
SELECT CAST(p_partkey AS STRING) AS product_id,
       CASE WHEN p_partkey % 20 <> 0 THEN p_type END AS product_category_name,
       CAST(length(p_name) AS BIGINT) AS product_name_length,
       CAST(length(p_brand) AS BIGINT) AS product_description_length,
       p_partkey % 6 AS product_photos_qty,
       CAST(p_size * 100 AS BIGINT) AS product_weight_g, CAST(p_size AS BIGINT) AS product_length_cm,
       CAST(p_size + 1 AS BIGINT) AS product_height_cm, CAST(p_size + 2 AS BIGINT) AS product_width_cm
FROM {part}""",
    "m_category_translation": """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM {part} WHERE p_type <> 'PROMO'""",
    "m_sellers": """
SELECT CAST(s_suppkey AS STRING) AS seller_id, CAST(s_nationkey AS STRING) AS seller_zip_code_prefix,
       r_name AS seller_city, n_name AS seller_state
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "m_geolocation": """
SELECT CAST(n_nationkey AS STRING) AS geolocation_zip_code_prefix,
       CAST(n_nationkey AS DOUBLE) AS geolocation_lat, CAST(-n_nationkey AS DOUBLE) AS geolocation_lng,
       r_name AS geolocation_city, n_name AS geolocation_state
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "m_events": """
SELECT CAST(event_id AS STRING) AS event_id, event_type, CAST(event_id % 5000 AS STRING) AS order_id,
       CAST(user_id AS STRING) AS customer_id, CAST(NULL AS STRING) AS product_id,
       CAST(NULL AS STRING) AS order_status, value AS payment_value, CAST(ts AS TIMESTAMP) AS event_ts
FROM {events}""",
    # Run logs of the shape the scheduler keeps: an event stands for a run or a task.
    "m_run_log": """
SELECT event_type AS dag_id, CAST(event_id AS STRING) AS run_id, CAST(ts AS TIMESTAMP) AS execution_date,
       CAST(ts AS TIMESTAMP) AS start_date,
       CASE WHEN event_id % 13 <> 0
            THEN CAST(ts + INTERVAL '1' MINUTE * (1 + user_id % 45) AS TIMESTAMP) END AS end_date,
       CASE WHEN event_id % 13 = 0 THEN 'running'
            WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'failed'
            WHEN event_id % 7 = 0 THEN 'failed' ELSE 'success' END AS state
FROM {events}""",
    "m_task_log": """
SELECT event_type AS dag_id, CAST(event_id % 20 AS STRING) AS task_id, CAST(ts AS TIMESTAMP) AS start_date,
       CASE WHEN event_id % 13 <> 0
            THEN CAST(ts + INTERVAL '1' MINUTE * (1 + event_id % 20 * 3) AS TIMESTAMP) END AS end_date,
       CASE WHEN event_id % 7 = 0 THEN 'failed' ELSE 'success' END AS state
FROM {events}""",
}

# Columns of the test tables the views read; declared, so that no job has to look them up.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Pipelines the health report expects; the last one has no runs in the log.
PIPELINES = ["click", "error", "purchase", "signup", "view", "refund"]


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(n for _, n, _, _ in string.Formatter().parse(text) if n))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    tables = {t: spark.read.schema(TABLES[t]).parquet(f"{sf_dir}/{t}.parquet") for t in _names(text)}
    return spark.sql(text, **tables)


class ViewTables:
    """The raw tables of a test directory; a view is made when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._source = (prepare(spark), sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in schemas.RAW:
            raise AttributeError(name)
        text = "m_category_translation" if name == "product_category_translation" else f"m_{name}"
        df = view(*self._source, text)
        setattr(self, name, df)
        return df

    items = RawTables.items


def raw_tables(spark: SparkSession, sf_dir: str) -> ViewTables:
    return ViewTables(spark, sf_dir)
