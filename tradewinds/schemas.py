"""Declared schemas of the raw tables and of the event message."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _schema(*columns: str) -> T.StructType:
    """`"name type"` entries; a trailing `*` marks a required column."""
    fields = []
    for column in columns:
        name, kind = column.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("*")], not kind.endswith("*")))
    return T.StructType(fields)


# The raw table contract (names, types, required columns).
RAW = {
    "customers": _schema(
        "customer_id string*",
        "customer_unique_id string",
        "customer_zip_code_prefix string",
        "customer_city string",
        "customer_state string",
    ),
    "orders": _schema(
        "order_id string*",
        "customer_id string*",
        "order_status string",
        "order_purchase_timestamp timestamp*",
        "order_approved_at timestamp",
        "order_delivered_carrier_date timestamp",
        "order_delivered_customer_date timestamp",
        "order_estimated_delivery_date timestamp",
    ),
    "order_items": _schema(
        "order_id string*",
        "order_item_id long*",
        "product_id string*",
        "seller_id string*",
        "shipping_limit_date timestamp",
        "price double*",
        "freight_value double",
    ),
    "order_payments": _schema(
        "order_id string*",
        "payment_sequential long*",
        "payment_type string",
        "payment_installments long",
        "payment_value double*",
    ),
    "order_reviews": _schema(
        "review_id string*",
        "order_id string*",
        "review_score long",
        "review_comment_title string",
        "review_comment_message string",
        "review_creation_date timestamp",
        "review_answer_timestamp timestamp",
    ),
    "products": _schema(
        "product_id string*",
        "product_category_name string",
        "product_name_length long",
        "product_description_length long",
        "product_photos_qty long",
        "product_weight_g long",
        "product_length_cm long",
        "product_height_cm long",
        "product_width_cm long",
    ),
    "sellers": _schema(
        "seller_id string*",
        "seller_zip_code_prefix string",
        "seller_city string",
        "seller_state string",
    ),
    "geolocation": _schema(
        "geolocation_zip_code_prefix string*",
        "geolocation_lat double",
        "geolocation_lng double",
        "geolocation_city string",
        "geolocation_state string",
    ),
    "product_category_translation": _schema(
        "product_category_name string*",
        "product_category_name_english string",
    ),
}

# Tables a daily run needs, and the columns its gate insists on.
DAILY_TABLES = ["orders", "order_items", "order_payments"]
GATE_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]


def table_of(stem: str) -> str:
    """The raw table of a landing file: `<prefix>_<table>_dataset` or `<table>_dataset`.

    The category names come as `product_category_name_translation`. A stem that names
    no raw table stands for a table of its own.
    """
    if stem == "product_category_name_translation":
        return "product_category_translation"
    named = [t for t in RAW if f"_{stem}".endswith(f"_{t}_dataset")]
    return max(named, key=len, default=stem)


EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("payment_value", T.DoubleType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)


def required_columns(table: str) -> list[str]:
    return [f.name for f in RAW[table].fields if not f.nullable]
