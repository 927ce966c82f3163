"""The streaming job: messages are read and parsed once, into a table that the metrics follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewinds.streaming.events import event_rows, once, read_events, rejected, usable
from tradewinds.streaming.metrics import FIVE_MINUTES, MINUTE, metric_rows, realtime_metrics, rolling_metrics


@dataclass(frozen=True)
class Sinks:
    """Where the job writes (Parquet tables) and keeps its progress."""

    tables: str
    checkpoints: str

    def table(self, name: str) -> str:
        return f"{self.tables}/{name}"


EVENTS = "events"
METRICS = {"realtime_metrics": realtime_metrics, "rolling_metrics": rolling_metrics}
#: How long a window of each is.
LENGTHS = {"realtime_metrics": MINUTE, "rolling_metrics": FIVE_MINUTES}
SINKS = [EVENTS, *METRICS]
#: Table of what the engine says of its batches.
PROGRESS = "progress"


def start(
    messages: DataFrame,
    sinks: Sinks,
    delay: str = "0 seconds",
    trigger: dict | None = None,
    only: list[str] | None = None,
    redelivery: str | None = "10 minutes",
) -> list[StreamingQuery]:
    """Start a query for each sink; each has a checkpoint and can be restarted alone.

    `events` takes every message, parsed, with the reason where it cannot be used. The metrics
    read that table, so the source is read and parsed once for all. `trigger` holds the arguments
    of `DataStreamWriter.trigger`, such as `{"processingTime": "10 seconds"}` or
    `{"availableNow": True}`. `redelivery` is how long after a message's arrival the bus may
    repeat it; none for a source that delivers once, such as files.
    """
    events, spark = read_events(messages), messages.sparkSession
    if redelivery:
        events = once(events, redelivery)
    _make_folder(spark, sinks.table(EVENTS))

    def output(name: str) -> DataFrame:
        if name == EVENTS:
            return events
        written = spark.readStream.schema(events.schema).parquet(sinks.table(EVENTS))
        return metric_rows(METRICS[name](usable(written), delay))

    return [
        output(name)
        .writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", sinks.table(name))
        .option("checkpointLocation", f"{sinks.checkpoints}/{name}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
        for name in (only or SINKS)
    ]


def run_available(messages: DataFrame, sinks: Sinks, delay: str = "0 seconds", only: list[str] | None = None,
                  redelivery: str | None = "10 minutes") -> None:
    """Process what has arrived, then stop: the events first, then what follows them."""
    wanted = only or SINKS
    for step in ([n for n in wanted if n == EVENTS], [n for n in wanted if n != EVENTS]):
        for query in start(messages, sinks, delay, {"availableNow": True}, step, redelivery) if step else []:
            query.awaitTermination()
            record(messages.sparkSession, sinks, query)


def record(spark: SparkSession, sinks: Sinks, query: StreamingQuery) -> None:
    """Keep the engine's watermark and its count of state rows dropped as late, of a query's recent batches.

    For a query that runs on, call it from time to time; a batch kept twice counts once.
    """
    rows = [
        (query.name, str(p.runId), p.batchId, p.eventTime.get("watermark"), sum(o.numRowsDroppedByWatermark for o in p.stateOperators))
        for p in query.recentProgress
    ]
    if rows:
        kept = spark.createDataFrame(rows, "name string, run_id string, batch_id bigint, watermark string, dropped_rows bigint")
        kept.withColumn("watermark", F.to_timestamp("watermark")).coalesce(1).write.mode("append").parquet(sinks.table(PROGRESS))


def _progress(spark: SparkSession, sinks: Sinks, name: str) -> DataFrame:
    return spark.read.parquet(sinks.table(PROGRESS)).where(F.col("name") == name).distinct()


def _make_folder(spark: SparkSession, path: str) -> None:
    """A stream can follow a table only once its folder is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def realtime_orders(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """The usable events that the job has written."""
    return event_rows(usable(spark.read.parquet(sinks.table(EVENTS))))


def realtime_rejects(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """The messages that could not be used, with the reason."""
    return rejected(spark.read.parquet(sinks.table(EVENTS)))


def complete_metrics(spark: SparkSession, sinks: Sinks, name: str) -> DataFrame:
    """All windows of the metrics `name`: the closed ones of the sink, and those still open.

    A stream gives a window away once no more events are expected. The windows after the last
    that the sink has are computed from the events by the same function as a bounded table's.
    """
    closed = spark.read.parquet(sinks.table(name))
    until = _closed_until(spark, sinks, name)
    recent = usable(spark.read.parquet(sinks.table(EVENTS)))
    if until is not None:
        recent = recent.where(F.col("event_ts") >= F.lit(until) - F.expr(f"INTERVAL {LENGTHS[name]}"))
    rows = METRICS[name](recent)
    return closed.unionByName(metric_rows(rows if until is None else rows.where(F.col("window_end") > F.lit(until))))


def late_events(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """`n_late`, events that came after their minute was closed and are in no row of the metrics' sink.

    `dropped_rows` is the engine's own count: state rows it refused, one for each member of a partial group.
    """
    name = "realtime_metrics"
    counted = spark.read.parquet(sinks.table(name)).agg(F.coalesce(F.sum("event_count"), F.lit(0)))
    minute_end = F.date_trunc("minute", "event_ts") + F.expr("INTERVAL 1 MINUTE")
    events = usable(spark.read.parquet(sinks.table(EVENTS))).where(minute_end <= F.lit(_closed_until(spark, sinks, name)))
    dropped = _progress(spark, sinks, name).agg(F.sum("dropped_rows"))
    return events.agg((F.count("*") - counted.scalar()).alias("n_late"), F.any_value(dropped.scalar()).alias("dropped_rows"))


def _closed_until(spark: SparkSession, sinks: Sinks, name: str):
    """All windows of the metrics that end by then are closed: the engine's last watermark."""
    return _progress(spark, sinks, name).agg(F.max("watermark").alias("until")).first()["until"]
