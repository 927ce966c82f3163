"""Registered queries that go through files or a stream, fed from the test tables."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.model import AS_OF, raw_tables, view
from tradewinds import schemas
from tradewinds.operators.frames import side_by_side, stack
from tradewinds.plans import daystore, monthly, quality, reports
from tradewinds.session import prepare
from tradewinds.sources import bus, csv, landing, writers
from tradewinds.sources.staging import new_path
from tradewinds.streaming import jobs
from tradewinds.streaming.events import event_rows, read_events, rejected, usable
from tradewinds.streaming.jobs import Sinks
from tradewinds.streaming.metrics import realtime_metrics, rolling_metrics
from tradewinds.tables import RawTables


def _stem(table: str) -> str:
    return "product_category_name_translation" if table == "product_category_translation" else f"{table}_dataset"


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders out to CSV and back through the declared schema and a table."""
    path = _write_csv(raw_tables(spark, sf_dir).orders, new_path(spark, "orders-csv"))
    target = new_path(spark, "orders")
    csv.load_csv(spark, path, "orders", target)
    return spark.read.parquet(target)


def load_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_csv(raw_tables(spark, sf_dir).order_payments, new_path(spark, "payments-csv"))
    return csv.infer_csv(spark, path)


def _comment() -> Column:
    """A comment with quotes, a comma and a line break in it."""
    return F.concat(F.lit('"'), "review_comment_message", F.lit('", she said\nand left'))


def load_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = raw_tables(spark, sf_dir).order_reviews.withColumn("review_comment_message", _comment())
    target = new_path(spark, "reviews")
    csv.load_csv(spark, _write_csv(reviews, new_path(spark, "reviews-csv")), "order_reviews", target)
    return spark.read.parquet(target)


def _damaged_reviews(spark: SparkSession, sf_dir: str) -> str:
    """A file of reviews damaged in three ways."""
    n = F.col("order_id").cast("bigint")
    reviews = raw_tables(spark, sf_dir).order_reviews.select(
        F.when(n % 101 != 0, F.col("review_id")).alias("review_id"),
        "order_id",
        F.when(n % 97 == 0, F.lit("five")).otherwise(F.col("review_score").cast("string")).alias("review_score"),
        "review_comment_title",
        _comment().alias("review_comment_message"),
        "review_creation_date",
        "review_answer_timestamp",
        F.when(n % 89 == 0, F.lit("surplus")).alias("surplus"),
    )
    return _write_csv(reviews, new_path(spark, "reviews-csv"))


def load_reviews_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the damaged reviews the reader rejects."""
    _, rejects = csv.read_csv(spark, _damaged_reviews(spark, sf_dir), "order_reviews")
    return rejects.select("review_id", "order_id", "review_score", "reason")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of rejects that a load leaves."""
    target = new_path(spark, "reviews")
    csv.load_csv(spark, _damaged_reviews(spark, sf_dir), "order_reviews", target)
    return spark.read.parquet(csv.rejects_path(target)).select("review_id", "order_id", "review_score", "reason")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded and rejected, by a load without a limit and by one with a limit of 0."""
    path, target = _damaged_reviews(spark, sf_dir), new_path(spark, "raw")
    files = {_stem("order_reviews"): path}
    return stack([
        landing.load_all(spark, files, f"{target}-{limit}", limit and {"order_reviews": int(limit)})
        .select(F.lit(limit or "none").alias("allowed"), "table_name", "loaded", "n_loaded", "n_rejected", "error")
        for limit in (None, "0")
    ])


def _land(spark: SparkSession, sf_dir: str, tables: list[str]) -> tuple[str, dict[str, str]]:
    """The tables as CSV files of the landing folder of the run date."""
    raw, root = raw_tables(spark, sf_dir), new_path(spark, "landing")
    paths = side_by_side(spark, [
        partial(_write_csv, getattr(raw, t), landing.landing_path(root, AS_OF, _stem(t))) for t in tables
    ])
    return root, dict(zip(map(_stem, tables), paths))


def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, files = _land(spark, sf_dir, list(schemas.RAW))
    target = new_path(spark, "raw")
    results = landing.load_all(spark, files, target)
    tables = {t: spark.read.parquet(f"{target}/{t}") for t in schemas.RAW}
    return results.join(quality.row_counts(tables), "table_name").select("table_name", "loaded", "n_rows")


def load_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily load, run twice; the second run replaces what the first wrote."""
    root, _ = _land(spark, sf_dir, schemas.DAILY_TABLES)
    target = new_path(spark, "daily")
    landing.load_day(spark, root, AS_OF, target)
    return landing.load_day(spark, root, AS_OF, target)["orders"]


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier orders are in the table when the run date's file is loaded."""
    orders, target = raw_tables(spark, sf_dir).orders, new_path(spark, "orders")
    day = F.to_date("order_purchase_timestamp")
    earlier = orders.where(day < F.lit(AS_OF)).withColumn("load_date", F.trunc(day, "year"))
    writers.replace_days(earlier, target, "load_date")
    today = orders.where(day == F.lit(AS_OF)).withColumn("load_date", day)
    writers.replace_days(today, target, "load_date")
    return quality.load_summary(spark.read.parquet(target), AS_OF)


def landing_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the three required files have landed."""
    root, _ = _land(spark, sf_dir, ["orders", "order_payments"])
    missing = landing.missing_files(spark, root, AS_OF)
    return missing.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path"))


def orders_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.orders_partitioned(raw_tables(spark, sf_dir).orders, new_path(spark, "orders-by-day"))


def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders-by-day")
    writers.orders_partitioned(raw_tables(spark, sf_dir).orders, path)
    stats = writers.partition_stats(spark, path, "order_date")
    return stats.select("partition_id", "total_rows", (F.col("size_gb") > 0).alias("has_size"))


def monthly_metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested form through JSON lines; one row per month and entry of its maps."""
    path = new_path(spark, "monthly-json")
    writers.write_json(monthly.monthly_histograms(raw_tables(spark, sf_dir)), path)
    schema = (
        "year_month string, total_orders bigint, total_revenue double, avg_order_value double, "
        "payment_types map<string,bigint>, order_statuses map<string,bigint>"
    )
    months = spark.read.schema(schema).json(path)
    return stack([
        months.select("year_month", "total_orders", F.lit(kind).alias("histogram"), F.explode(kind).alias("label", "n"))
        for kind in ("payment_types", "order_statuses")
    ])


def latest_daily_metrics_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest five days of the table kept by day."""
    path = new_path(spark, "daily-metrics")
    daystore.build_daily_metrics(raw_tables(spark, sf_dir), path, AS_OF)
    return daystore.latest_daily_metrics(spark, path, 5)


def daily_metrics_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built without the newest orders, some payments and some items, then brought up to date with these."""
    raw, path = raw_tables(spark, sf_dir), new_path(spark, "daily-metrics")
    number = F.col("order_id").cast("bigint")
    later = {
        "orders": F.col("order_purchase_timestamp") >= F.date_sub(F.lit(AS_OF), 3),
        "order_payments": number % 997 == 0,
        "order_items": number % 1009 == 0,
    }
    every = dict(raw.items())
    before = RawTables(**{**every, **{t: every[t].where(~late) for t, late in later.items()}})
    daystore.build_daily_metrics(before, path, AS_OF)
    daystore.update_daily_metrics(raw, path, {t: every[t].where(late) for t, late in later.items()}, AS_OF)
    return spark.read.parquet(path).drop(daystore.MONTH)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the JSON the bus carries; some are damaged."""
    prepare(spark)
    n = F.col("event_id").cast("bigint") % 50
    stamp = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    about = F.struct(F.lit("web").alias("source"), F.lit("1.0").alias("version"))
    whole = F.to_json(F.struct(
        "event_id", "event_type", "order_id", "customer_id", "payment_value",
        stamp.alias("event_timestamp"), F.when(n != 5, about).alias("metadata"),
    ))
    value = (
        F.when(n == 0, F.substring(whole, 1, 60))
        .when(n == 1, F.regexp_replace(whole, '"payment_value":[^,]*', '"payment_value":null'))
        .when(n == 2, F.replace(whole, F.lit('"event_timestamp":"'), F.lit('"event_timestamp":"on ')))
        .when(n == 3, F.replace(whole, F.lit('"event_type"'), F.lit('"kind"')))
        .when(n == 4, F.regexp_replace(whole, '"payment_value":[^,]*,', ""))
        .otherwise(whole)
    )
    return view(spark, sf_dir, "m_events").select(value.alias("value"))


def realtime_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(usable(read_events(_messages(spark, sf_dir))))


def _reject_rows(rejects: DataFrame) -> DataFrame:
    return rejects.select(F.regexp_extract("value", r'"event_id":"(\d+)"', 1).alias("event_id"), "reason")


def realtime_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reject_rows(rejected(read_events(_messages(spark, sf_dir))))


def realtime_metrics_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realtime_metrics(usable(read_events(_messages(spark, sf_dir)))).drop("processing_ts")


def rolling_metrics_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_metrics(usable(read_events(_messages(spark, sf_dir)))).drop("processing_ts")


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = usable(read_events(_messages(spark, sf_dir)))
    return event_rows(events.orderBy(F.desc("event_ts"), "event_id").limit(10))


def _streamed(spark: SparkSession, sf_dir: str, only: list[str]) -> Sinks:
    """The streaming job, fed with files and run until they are used up."""
    return _fed(spark, [_messages(spark, sf_dir)], only, None)


def _fed(spark: SparkSession, feeds: list[DataFrame], only: list[str], redelivery: str | None) -> Sinks:
    """The streaming job, run once after the files of each feed have arrived."""
    incoming = new_path(spark, "incoming")
    sinks = Sinks(new_path(spark, "stream"), new_path(spark, "progress"))
    for feed in feeds:
        feed.write.mode("append").text(incoming)
        jobs.run_available(bus.read_bus(spark, "text", path=incoming), sinks, "10 minutes", only, redelivery)
    return sinks


def _every(n: int, rest: int) -> Column:
    """Messages whose event id leaves `rest` when divided by `n`; the id is there in damaged ones too."""
    return F.regexp_extract("value", r'"event_id":"(\d+)"', 1).cast("bigint") % n == rest


def stream_realtime_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.realtime_orders(spark, _streamed(spark, sf_dir, [jobs.EVENTS]))


def stream_realtime_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reject_rows(jobs.realtime_rejects(spark, _streamed(spark, sf_dir, [jobs.EVENTS])))


def _stream_metrics(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.complete_metrics(spark, _streamed(spark, sf_dir, [jobs.EVENTS, name]), name)


def stream_realtime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_metrics("realtime_metrics", spark, sf_dir)


def stream_rolling_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_metrics("rolling_metrics", spark, sf_dir)


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth message comes in a second run; most of these are older than the windows still open."""
    messages, later = _messages(spark, sf_dir), _every(20, 7)
    sinks = _fed(spark, [messages.where(~later), messages.where(later)], [jobs.EVENTS, "realtime_metrics"], None)
    late = jobs.late_events(spark, sinks)
    return late.select("n_late", (F.col("dropped_rows") >= F.col("n_late")).alias("dropped_by_engine"))


def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics where the bus repeats every tenth message in the same run and every fifteenth in the next."""
    messages = _messages(spark, sf_dir)
    feeds = [messages.unionAll(messages.where(_every(10, 6))), messages.where(_every(15, 6))]
    name = "realtime_metrics"
    return jobs.complete_metrics(spark, _fed(spark, feeds, [jobs.EVENTS, name], "1 hour"), name)


def binary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the bytes a bus delivers."""
    messages = _messages(spark, sf_dir).select(F.col("value").cast("binary").alias("value"))
    return event_rows(usable(read_events(messages)))


def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the raw tables as written, and whether they have a size."""
    root, paths = new_path(spark, "sizes"), {}
    for name, df in raw_tables(spark, sf_dir).items():
        paths[name] = f"{root}/{name}"
        writers.overwrite(df, paths[name])
    return writers.table_sizes(spark, paths).select("table_name", "n_rows", (F.col("size_gb") > 0).alias("has_size"))


def catalog_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by month with the raw layer as catalog tables."""
    database = f"raw_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_path(spark, 'catalog')}'")
    for name, df in raw_tables(spark, sf_dir).items():
        writers.replace_table(df, f"{database}.{name}")
    return reports.revenue_by_month(RawTables.from_catalog(spark, database))
