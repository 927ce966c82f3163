"""Event messages and windowed metrics, as a batch and as a stream."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from conftest import rows, ts

from tradewinds.sources import bus
from tradewinds.streaming import jobs
from tradewinds.streaming.events import event_rows, once, read_events, rejected, usable
from tradewinds.streaming.jobs import Sinks, run_available
from tradewinds.streaming.metrics import realtime_metrics, rolling_metrics

BASE = dict(event_id="e", event_type="order_created", order_id="o1", customer_id="c1", product_id="p1",
            order_status="created", payment_value=150.0, event_timestamp="2024-01-01T10:00:30Z",
            metadata={"source": "web", "version": "1.0"})


def message(**changes):
    event = {**BASE, **changes}
    return json.dumps({k: v for k, v in event.items() if v != "absent"})


def read(spark, *messages):
    return read_events(spark.createDataFrame([(m,) for m in messages], "value string"))


@pytest.mark.parametrize("value,category", [
    (99.99, "low"), (100, "medium"), (199.99, "medium"), (200, "high"), ("absent", "low"), (-5, "low"),
])
def test_value_category(spark, value, category):
    assert rows(usable(read(spark, message(payment_value=value))), "value_category") == [(category,)]


@pytest.mark.parametrize("stamp,part", [
    ("2024-01-01T00:00:00Z", "night"), ("2024-01-01T05:59:59Z", "night"), ("2024-01-01T06:00:00Z", "morning"),
    ("2024-01-01T11:59:59.999999Z", "morning"), ("2024-01-01T12:00:00Z", "afternoon"),
    ("2024-01-01T17:00:00", "afternoon"), ("2024-01-01T18:00:00Z", "evening"),
    # the hour as written, though it is 2 in UTC
    ("2024-01-01T23:00:00-03:00", "evening"), ("2024-01-01", "night"),
])
def test_part_of_day(spark, stamp, part):
    assert rows(usable(read(spark, message(event_timestamp=stamp))), "time_of_day") == [(part,)]


@pytest.mark.parametrize("text,reason", [
    (message()[:40], "not a JSON object"), ("[1]", "not a JSON object"), ("", "not a JSON object"),
    (message(payment_value=None), "bad payment_value"), (message(payment_value={"a": 1}), "bad payment_value"),
    (message(event_timestamp="yesterday"), "bad event_timestamp"), (message(event_timestamp="absent"), "bad event_timestamp"),
    (message(event_timestamp="2024"), "bad event_timestamp"), (message(event_type="absent"), "no event_type"),
])
def test_rejects(spark, text, reason):
    events = read(spark, text, message())
    assert rows(rejected(events)) == [(text, reason)]
    assert usable(events).count() == 1


@pytest.mark.parametrize("metadata,want", [
    ({"source": "app", "version": "2"}, ("app", "2")), ({"source": "app"}, ("app", "")), ("absent", ("", "")),
    ("text", (None, None)), (None, (None, None)), ({"source": None, "version": "1"}, (None, "1")),
])
def test_metadata(spark, metadata, want):
    assert rows(usable(read(spark, message(metadata=metadata))), "metadata_source", "metadata_version") == [want]


def test_event_rows(spark):
    df = event_rows(usable(read(spark, message())))
    assert len(df.columns) == 13
    assert rows(df, "event_timestamp", "payment_value") == [("2024-01-01T10:00:30Z", 150.0)]
    assert rows(df, "processing_timestamp")[0][0].endswith("Z")


def minute_events(spark):
    return [
        message(event_timestamp="2024-01-01T10:00:00Z", payment_value=10.0),
        message(event_timestamp="2024-01-01T10:00:59.999Z", payment_value=10.05, customer_id=None),
        message(event_timestamp="2024-01-01T10:00:59Z", payment_value="absent", customer_id=None, order_id="o2"),
        message(event_timestamp="2024-01-01T10:01:00Z", payment_value=1.0),  # right on the edge
        message(event_timestamp="2024-01-01T10:00:10Z", event_type="order_shipped", payment_value=5.0),
    ]


def test_metrics_per_minute(spark):
    df = realtime_metrics(usable(read(spark, *minute_events(spark)))).drop("processing_ts")
    ten, one = ts("2024-01-01 10:00:00"), ts("2024-01-01 10:01:00")
    assert rows(df) == [
        # a missing customer counts as one
        ("order_created", ten, one, 3, 20.05, 6.68, 2, 2),
        ("order_created", one, ts("2024-01-01 10:02:00"), 1, 1.0, 1.0, 1, 1),
        ("order_shipped", ten, one, 1, 5.0, 5.0, 1, 1),
    ]


def test_rolling_metrics(spark):
    df = rolling_metrics(usable(read(spark, *minute_events(spark))))
    got = {r["window_start"]: (r["event_count"], r["total_revenue"]) for r in df.collect()}
    assert len(got) == 6
    assert got[ts("2024-01-01 09:56:00")] == (4, 25.05)
    assert got[ts("2024-01-01 10:00:00")] == (5, 26.05)
    assert got[ts("2024-01-01 10:01:00")] == (1, 1.0)
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(minutes=5) for r in df.collect())


def run(spark, tmp_path, batches, delay="0 seconds", redelivery=None):
    """The job over files that arrive one batch after another."""
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    sinks = Sinks(str(tmp_path / "tables"), str(tmp_path / "progress"))
    for i, batch in enumerate(batches):
        (incoming / f"{i}.json").write_text("\n".join(batch) + "\n")
        run_available(bus.read_bus(spark, "text", path=str(incoming)), sinks, delay, redelivery=redelivery)
    return sinks, {
        "realtime_orders": jobs.realtime_orders(spark, sinks),
        "realtime_rejects": jobs.realtime_rejects(spark, sinks),
        **{name: spark.read.parquet(sinks.table(name)) for name in jobs.METRICS},
    }


def test_stream_equals_batch(spark, tmp_path):
    events = [
        message(event_id=str(i), event_timestamp=f"2024-01-01T10:{i % 40:02d}:{i % 60:02d}Z", payment_value=i / 4,
                customer_id=f"c{i % 7}", order_id=f"o{i % 11}", event_type="view" if i % 3 else "click")
        for i in range(300)
    ]
    # far enough ahead to close every window before it
    last = message(event_timestamp="2024-01-01T12:00:00Z", event_type="close")
    sinks, tables = run(spark, tmp_path, [[*events, "broken", last]])
    batch = usable(read(spark, *events))
    assert rows(tables["realtime_orders"].where("event_type <> 'close'"), "event_id", "value_category") == rows(
        batch, "event_id", "value_category"
    )
    assert rows(tables["realtime_rejects"]) == [("broken", "not a JSON object")]
    numbers = ["event_count", "total_revenue", "avg_order_value", "unique_customers", "unique_orders"]
    assert rows(tables["realtime_metrics"], "event_type", *numbers) == rows(
        realtime_metrics(batch), "event_type", *numbers
    )
    assert rows(tables["rolling_metrics"], *numbers) == rows(rolling_metrics(batch), *numbers)
    # with the windows still open, everything
    every = usable(read(spark, *events, last))
    for name, metrics in jobs.METRICS.items():
        assert rows(jobs.complete_metrics(spark, sinks, name), *numbers) == rows(metrics(every), *numbers)


def test_late_events(spark, tmp_path):
    first = [message(event_timestamp="2024-01-01T10:00:10Z"), message(event_timestamp="2024-01-01T10:05:00Z")]
    second = [
        message(event_timestamp="2024-01-01T10:03:30Z"),  # within the delay of two minutes
        message(event_timestamp="2024-01-01T10:00:20Z"),  # its window is closed
        message(event_timestamp="2024-01-01T11:00:00Z", event_type="close"),
    ]
    sinks, tables = run(spark, tmp_path, [first, second], "2 minutes")
    got = rows(tables["realtime_metrics"], "window_start", "event_count")
    assert got == [("2024-01-01T10:00:00Z", 1), ("2024-01-01T10:03:00Z", 1), ("2024-01-01T10:05:00Z", 1)]
    # the event itself is kept
    assert tables["realtime_orders"].count() == 5
    assert rows(jobs.late_events(spark, sinks)) == [(1, 2)]  # refused once by customer and once by order
    complete = rows(jobs.complete_metrics(spark, sinks, "realtime_metrics"), "window_start", "event_count")
    assert complete == [*got, ("2024-01-01T11:00:00Z", 1)]


def test_windows_by_arrival(spark, tmp_path):
    """Windows may follow the time of processing instead of the time in the event."""
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (incoming / "0.json").write_text(message() + "\n" + message(event_timestamp="2020-01-01T00:00:00Z") + "\n")
    events = usable(read_events(bus.read_bus(spark, "text", path=str(incoming))))
    query = (
        realtime_metrics(events, time_col="processing_ts")
        .writeStream.format("memory").queryName("by_arrival").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.exception() is None
    batch = realtime_metrics(usable(read(spark, message(), message())), time_col="processing_ts")
    assert rows(batch, "event_count") == [(2,)]


def test_late_events_where_no_other_closes_their_minute(spark, tmp_path):
    """A window without any event in time is closed by the watermark alone."""
    first = [message(event_timestamp="2024-01-01T10:00:10Z"), message(event_timestamp="2024-01-01T10:30:00Z")]
    second = [message(event_timestamp=f"2024-01-01T10:{m}:30Z", customer_id=f"c{m}", order_id=f"o{m}") for m in (10, 12, 27, 28)]
    sinks, tables = run(spark, tmp_path, [first, second], "2 minutes")
    late = jobs.late_events(spark, sinks).first()
    assert late.n_late == 3 and late.dropped_rows == 6  # by customer and by order
    complete = rows(jobs.complete_metrics(spark, sinks, "realtime_metrics"), "window_start", "event_count")
    assert complete == [("2024-01-01T10:00:00Z", 1), *((f"2024-01-01T10:{m}:00Z", 1) for m in (28, 30))]


def test_redelivered_messages_count_once(spark, tmp_path):
    whole = [message(event_id=str(i), event_timestamp=f"2024-01-01T10:00:{i:02d}Z", customer_id=f"c{i}") for i in range(10)]
    nameless = message(event_id=None, event_timestamp="2024-01-01T10:00:40Z")
    feeds = [[*whole, whole[3], nameless, "broken", "broken"], [whole[3], whole[7], nameless, "broken", "other"]]
    # the same id in a damaged message first, whole afterwards
    feeds[0].append(message(event_id="90", event_timestamp="never"))
    feeds[1].append(message(event_id="90", event_timestamp="2024-01-01T10:00:50Z"))
    sinks, tables = run(spark, tmp_path, feeds, redelivery="1 hour")
    assert tables["realtime_orders"].count() == 12
    assert sorted(r.reason for r in tables["realtime_rejects"].collect()) == ["bad event_timestamp", "not a JSON object", "not a JSON object"]
    assert [r.event_count for r in jobs.complete_metrics(spark, sinks, "realtime_metrics").collect()] == [12]
    bounded = once(read(spark, *feeds[0], *feeds[1]), "1 hour")
    assert usable(bounded).count() == 12 and rejected(bounded).count() == 3


def test_rolling_metrics_against_every_window(spark):
    """Members that come back within and beyond the window, missing ones, gaps; one row per event before grouping."""
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1, 10)
    events = []
    for i in range(400):
        at = base + dt.timedelta(seconds=rng.choice([rng.randrange(900), rng.randrange(3_000, 3_300), 5_000]))
        events.append((at, rng.choice(["a", "b", "c", None]), f"o{rng.randrange(30)}", rng.randrange(100) / 4))
    given = [message(event_id=str(i), event_timestamp=t.strftime("%Y-%m-%dT%H:%M:%SZ"), customer_id=c, order_id=o, payment_value=v)
             for i, (t, c, o, v) in enumerate(events)]
    df = rolling_metrics(usable(read(spark, *given)))
    want = []
    for m in range(-5, 100):
        start = base + dt.timedelta(minutes=m)
        inside = [e for e in events if start <= e[0] < start + dt.timedelta(minutes=5)]
        if inside:
            total = sum(e[3] for e in inside)
            want.append((start, len(inside), total, len({e[1] for e in inside}), len({e[2] for e in inside})))
    got = rows(df, "window_start", "event_count", "total_revenue", "unique_customers", "unique_orders")
    assert got == sorted(want, key=repr)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # Nothing is copied below the grouping into panes.
    below = plan[plan.rindex("Aggregate [window"):] if "Aggregate [window" in plan else plan[plan.rindex("Aggregate"):]
    assert "Expand" not in below and below.count("Generate") == 1 and "inline" in below  # the parsing of a message
