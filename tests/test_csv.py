"""Files into the raw layer."""

from __future__ import annotations

import datetime as dt
import re
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradewinds import RawTables, schemas
from tradewinds.operators import frames
from tradewinds.plans import marts, reports
from tradewinds.sources import csv, landing, writers
from tradewinds.sources.staging import new_path, shared_folder, stage

ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
REVIEWS = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_strict_file(spark, tmp_path):
    text = ITEMS + (
        "o1,1,p1,s1,2024-01-02 03:04:05,9.5,1\n"
        "o2,x,p1,s1,2024-01-02 03:04:05,9.5,1\n"   # bad integer
        ",1,p1,s1,2024-01-02 03:04:05,9.5,1\n"     # no order id
        "o4,1,p1,s1\n"                             # short
        "o5,1,p1,s1,2024-01-02 03:04:05,9.5,1,z\n" # long
        "o6,1,p1,s1,soon,9.5,1\n"                  # bad time
        "o7,1,p1,s1,,9.5,\n"                       # optional fields missing
    )
    path = write(tmp_path / "items.csv", text)
    good, rejects = csv.read_csv(spark, path, "order_items")
    assert good.columns == schemas.RAW["order_items"].fieldNames()
    assert rows(good) == [
        ("o1", 1, "p1", "s1", dt.datetime(2024, 1, 2, 3, 4, 5), 9.5, 1.0),
        ("o7", 1, "p1", "s1", None, 9.5, None),
    ]
    assert rows(rejects, "reason") == [
        ("bad order_item_id",), ("bad shipping_limit_date",), ("missing order_id",),
        ("wrong number of fields",), ("wrong number of fields",),
    ]
    with pytest.raises(csv.BadRecordLimit, match="5 bad rows, 0 allowed"):
        csv.load_csv(spark, path, "order_items", str(tmp_path / "items"), max_bad_records=0)
    assert not (tmp_path / "items").exists() and not list(tmp_path.glob("items__loading*"))


def test_reviews_are_lenient(spark, tmp_path):
    text = REVIEWS + (
        'r1,o1,5,"a ""b"", c","two\nlines",2024-01-01,2024-01-02\n'
        "r2,o2,4\n"                                  # short rows are fine here
        "r3,o3,5,t,m,2024-01-01,2024-01-02,extra\n"  # long ones are not
        "r4,o4,many,t,m,2024-01-01,2024-01-02\n"
    )
    path = write(tmp_path / "reviews.csv", text)
    done = csv.load_csv(spark, path, "order_reviews", str(tmp_path / "reviews"))
    assert done == csv.Loaded(n_loaded=2, n_rejected=2)
    rejects = spark.read.parquet(csv.rejects_path(str(tmp_path / "reviews")))
    assert rows(rejects, "review_id", "reason") == [("r3", "wrong number of fields"), ("r4", "bad review_score")]
    df = spark.read.parquet(str(tmp_path / "reviews"))
    assert "ingestion_timestamp" in df.columns
    assert rows(df, "review_id", "review_score", "review_comment_title", "review_comment_message") == [
        ("r1", 5, 'a "b", c', "two\nlines"), ("r2", 4, None, None)
    ]


def test_bad_record_limit_is_the_callers(spark, tmp_path):
    bad = "".join(f"r{i},o{i},many\n" for i in range(501))
    path, target = write(tmp_path / "many.csv", REVIEWS + bad + "r,o,1\n"), str(tmp_path / "reviews")
    assert csv.load_csv(spark, path, "order_reviews", target) == csv.Loaded(1, 501)
    assert spark.read.parquet(csv.rejects_path(target)).count() == 501
    with pytest.raises(csv.BadRecordLimit, match="501 bad rows, 500 allowed"):
        csv.load_csv(spark, path, "order_reviews", target, max_bad_records=500)
    # what was there stays
    assert spark.read.parquet(target).count() == 1


def test_file_names():
    assert schemas.table_of("shop_order_items_dataset") == "order_items"
    assert schemas.table_of("orders_dataset") == "orders"
    assert schemas.table_of("product_category_name_translation") == "product_category_translation"
    assert schemas.table_of("weather") == "weather"


def test_load_all_reports_failures(spark, tmp_path, small):
    files = {
        "shop_sellers_dataset": write(
            tmp_path / "s.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01234,rio,RJ\n"
        ),
        "shop_order_items_dataset": write(tmp_path / "i.csv", ITEMS + "o1,x,p1,s1,,1,1\n"),
        "weather": write(tmp_path / "w.csv", "day,rain\n2024-01-01,3\n"),
        "shop_products_dataset": str(tmp_path / "absent.csv"),
    }
    target = str(tmp_path / "raw")
    results = landing.load_all(spark, files, target, {"order_items": 0})
    assert rows(results, "table_name", "loaded", "n_loaded", "n_rejected") == [
        ("order_items", False, None, None), ("products", False, None, None), ("sellers", True, 1, 0), ("weather", True, 1, 0)
    ]
    # a leading zero survives
    assert rows(spark.read.parquet(f"{target}/sellers"), "seller_zip_code_prefix") == [("01234",)]
    assert dict(spark.read.parquet(f"{target}/weather").dtypes)["rain"] == "int"


def test_daily_load_replaces_its_own_day(spark, tmp_path):
    day, other = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    orders = "order_id,customer_id,order_status,order_purchase_timestamp,a,b,c,d\n"
    for d, ids in ((day, "12"), (other, "3")):
        base = tmp_path / "landing" / d.isoformat()
        write(base / "shop_orders_dataset.csv", orders + "".join(f"o{i},c,new,2024-01-02 00:00:00,,,,\n" for i in ids))
        write(base / "shop_order_items_dataset.csv", ITEMS)
        if d == day:
            write(base / "shop_order_payments_dataset.csv", "order_id,n,t,i,v\no1,1,boleto,1,5\n")
    root, target = str(tmp_path / "landing"), str(tmp_path / "raw")
    assert landing.missing_files(spark, root, day, "shop_").count() == 0
    missing = rows(landing.missing_files(spark, root, other, "shop_"))
    assert missing == [(f"{root}/2024-01-03/shop_order_payments_dataset.csv",)]
    assert landing.missing_files(spark, root, dt.date(2030, 1, 1), "shop_").count() == 3
    with pytest.raises(FileNotFoundError, match="order_payments"):
        landing.load_day(spark, root, other, target, "shop_")
    for _ in range(2):
        loaded = landing.load_day(spark, root, day, target, "shop_")
    assert loaded["orders"].count() == 2
    write(tmp_path / "landing" / "2024-01-03" / "shop_order_payments_dataset.csv", "order_id,n,t,i,v\n")
    orders = landing.load_day(spark, root, other, target, "shop_")["orders"]
    assert rows(orders.groupBy("load_date").count()) == [(day, 2), (other, 1)]


def test_partitioned_orders(spark, small, tmp_path):
    path = str(tmp_path / "by_day")
    df = writers.orders_partitioned(small.orders, path)
    assert rows(df.drop("order_date")) == rows(small.orders)
    day = df.where(F.col("order_date") == F.lit(dt.date(2024, 1, 9)))
    assert "PartitionFilters: [isnotnull(order_date" in day._jdf.queryExecution().executedPlan().toString()
    # The plans prune folders as well when they are given the copy.
    raw = RawTables(**{**dict(small.items()), "orders": df})
    for plan in (
        reports.cancellation_rate(raw, dt.date(2024, 1, 10)), marts.daily_metrics(raw, dt.date(2024, 1, 9)),
        reports.top_products_daily(raw, dt.date(2024, 1, 10)),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(order_date" in text, text
    assert rows(marts.daily_metrics(raw, dt.date(2024, 1, 10))) == rows(marts.daily_metrics(small, dt.date(2024, 1, 10)))
    stats = rows(writers.partition_stats(spark, path, "order_date", 2), "partition_id", "total_rows")
    assert stats == [(dt.date(2024, 1, 5), 1), (dt.date(2024, 1, 9), 2)]
    assert rows(writers.table_sizes(spark, {"orders": path}).where("size_gb > 0"), "table_name", "n_rows") == [("orders", 7)]


def test_tables_and_sinks(spark, small, tmp_path):
    root = str(tmp_path / "layer")
    for name, df in small.items():
        writers.overwrite(df, f"{root}/{name}")
    writers.overwrite(small.orders.limit(1), f"{root}/orders")
    writers.append(small.orders.limit(1), f"{root}/orders")
    raw = RawTables.from_parquet(spark, root)
    assert raw.orders.count() == 2 and raw.order_items.count() == 10
    writers.replace_table(small.sellers, "kept_sellers")
    writers.replace_table(small.sellers, "kept_sellers")
    assert spark.table("kept_sellers").count() == 1
    spark.sql("DROP TABLE kept_sellers")


class Session:
    """A session with these settings only."""

    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_shared_folder_without_setting():
    local = Session(spark__master="local[2]", spark__app__id="app-1")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark__master="yarn", spark__app__id="app-2"))


def test_stage_writes_to_the_shared_folder(spark):
    df = stage(spark.range(3), "numbers")
    assert df.count() == 3
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert df.inputFiles()[0].removeprefix("file://").startswith(shared_folder(spark))
    assert new_path(spark, "x") != new_path(spark, "x")


def test_a_value_is_converted_once(spark, tmp_path):
    """Not once for the row and again for the reason of a reject."""
    path = str(tmp_path / "items.csv")
    with open(path, "w") as file:
        file.write("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n")
        file.write("o1,1,p1,s1,2024-01-01 00:00:00,1.5,x\n")
    records = csv._records(spark, path, "order_items")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(price#\d+ as double\)", plan)) == 1
    assert [r.reason for r in records.collect()] == ["bad freight_value"]


def test_loads_run_side_by_side(spark):
    meet = threading.Barrier(2, timeout=60)
    assert frames.side_by_side(spark, [lambda: meet.wait() >= 0 and "a", lambda: meet.wait() >= 0 and "b"]) == ["a", "b"]
    with pytest.raises(ZeroDivisionError):
        frames.side_by_side(spark, [lambda: 1, lambda: 1 // 0])
