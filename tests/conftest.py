from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewinds import RawTables, build_session, schemas  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def table(spark):
    """Rows (dicts, missing columns null) as one of the raw tables."""

    def make(name, rows):
        names = schemas.RAW[name].fieldNames()
        loose = schemas.RAW[name].simpleString()[len("struct<"):-1]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], loose)

    return make


@pytest.fixture(scope="session")
def small(table) -> RawTables:
    """A few orders with every kind of fan-out, gap and tie."""
    day = [f"2024-01-{d:02d} {h:02d}:00:00" for d, h in ((1, 0), (1, 23), (2, 5), (3, 9), (5, 12), (9, 18), (9, 19))]
    orders = [
        # two payments x two items x two reviews
        dict(order_id="o1", customer_id="c1", order_status="delivered", delivered="2024-01-04 12:00:00"),
        # the same person again, no review, delivered before it was bought
        dict(order_id="o2", customer_id="c2", order_status="delivered", delivered="2024-01-01 10:00:00"),
        # no items, no payments
        dict(order_id="o3", customer_id="c3", order_status="delivered", delivered="2024-01-08 05:00:00"),
        dict(order_id="o4", customer_id="c3", order_status="canceled", delivered=None),
        # no such customer
        dict(order_id="o5", customer_id="c9", order_status="delivered", delivered="2024-01-12 12:00:00"),
        dict(order_id="o6", customer_id="c4", order_status="shipped", delivered=None),
        dict(order_id="o7", customer_id="c4", order_status="delivered", delivered="2024-01-20 19:00:00"),
    ]
    return RawTables(
        customers=table("customers", [
            dict(customer_id=c, customer_unique_id=u, customer_city=city, customer_state=state)
            for c, u, city, state in (
                ("c1", "u1", "rio", "RJ"), ("c2", "u1", "santos", "SP"), ("c3", "u2", None, "SP"), ("c4", "u3", "rio", None),
            )
        ]),
        orders=table("orders", [
            dict(
                order_id=o["order_id"], customer_id=o["customer_id"], order_status=o["order_status"],
                order_purchase_timestamp=ts(when),
                order_delivered_customer_date=ts(o["delivered"]) if o["delivered"] else None,
                order_estimated_delivery_date=ts("2024-01-10 00:00:00"),
            )
            for o, when in zip(orders, day)
        ]),
        order_items=table("order_items", [
            dict(order_id=o, order_item_id=i, product_id=p, seller_id=s, price=price, freight_value=freight)
            for o, i, p, s, price, freight in (
                ("o1", 1, "p1", "s1", 10.0, 1.0), ("o1", 2, "p1", "s2", 20.0, None), ("o2", 1, "p2", "s1", 5.5, 0.5),
                ("o2", 2, "p1", "s1", 10.0, 1.0), ("o4", 1, "p3", "s3", 7.0, 0.0), ("o5", 1, "p9", "s1", 3.0, 0.1),
                ("o6", 1, "p1", "s1", 11.0, 1.0), ("o7", 1, "p3", "s3", 7.0, 0.25), ("o7", 2, "p2", "s3", 5.5, 0.25),
                ("o7", 3, "p4", "s3", 1.0, 0.25),
            )
        ]),
        order_payments=table("order_payments", [
            dict(order_id=o, payment_sequential=n, payment_type=kind, payment_installments=inst, payment_value=value)
            for o, n, kind, inst, value in (
                ("o1", 2, "voucher", 1, 12.5), ("o1", 1, "credit_card", 3, 19.5), ("o2", 1, "boleto", 1, 17.0),
                ("o4", 1, "credit_card", 2, 7.0), ("o5", 1, None, None, 3.1), ("o7", 1, "voucher", 1, 7.25),
                ("o7", 2, "voucher", 1, 7.25), ("o7", 3, "voucher", None, 7.25),
            )
        ]),
        order_reviews=table("order_reviews", [
            dict(review_id=r, order_id=o, review_score=score, review_comment_message=text)
            for r, o, score, text in (
                ("r1", "o1", 5, "good"), ("r2", "o1", 2, None), ("r3", "o7", 4, "late"), ("r3", "o5", 4, "late"),
                ("r4", "o7", None, None), ("r1", "o2", 5, "good"), ("r5", "o4", 1, "bad"),
            )
        ]),
        products=table("products", [
            dict(product_id=p, product_category_name=c, product_weight_g=w, product_length_cm=2,
                 product_height_cm=h, product_width_cm=4)
            for p, c, w, h in (("p1", "toys", 100, 3), ("p2", "books", None, 3), ("p3", None, 50, None), ("p4", "misc", 1, 1))
        ]),
        sellers=table("sellers", [dict(seller_id="s1", seller_city="rio", seller_state="RJ")]),
        geolocation=table("geolocation", []),
        product_category_translation=table("product_category_translation", [
            dict(product_category_name="toys", product_category_name_english="Toys"),
            dict(product_category_name="books", product_category_name_english="Books"),
        ]),
    )


def rows(df, *columns):
    """Rows as sorted tuples, doubles to 9 places."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in picked.collect()), key=repr
    )
