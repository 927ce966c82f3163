"""Pipeline health from a run log."""

from __future__ import annotations

import datetime as dt

from conftest import rows, ts

from tradewinds.plans import health

NOW = dt.datetime(2024, 1, 2, 12)


def run(dag, minute, state, minutes=3, day="2024-01-02"):
    start = ts(f"{day} 10:{minute:02d}:00")
    end = start + dt.timedelta(minutes=minutes) if minutes is not None else None
    return (dag, f"{dag}-{minute}", start, start, end, state)


def test_run_health(spark):
    log = [run("good", i, "success") for i in range(5)]
    log += [run("broken", i, "failed" if i < 3 else "success") for i in range(10)]
    log += [run("shaky", i, "success" if i < 7 else "running", None if i == 9 else 4) for i in range(10)]
    # only the latest ten of twelve runs count; the two failures are the oldest
    log += [run("busy", i, "failed" if i < 2 else "success", i) for i in range(12)]
    log += [run("idle", 1, "success", day="2023-12-30"), run("unknown", 1, "failed")]
    df = spark.createDataFrame(
        log, "dag_id string, run_id string, execution_date timestamp, start_date timestamp, end_date timestamp, state string"
    )
    got = health.run_health(df, ["good", "broken", "shaky", "busy", "idle"], NOW)
    assert rows(got, "dag_id", "status", "runs", "success", "failed", "avg_duration_min", "needs_attention") == [
        ("broken", "UNHEALTHY", 10, 7, 3, 3.0, True),
        ("busy", "HEALTHY", 10, 10, 0, 6.5, False),
        ("good", "HEALTHY", 5, 5, 0, 3.0, False),
        ("idle", "NO_RUNS", None, None, None, None, True),
        ("shaky", "DEGRADED", 10, 7, 0, 4.0, False),
    ]
    assert rows(got.where("dag_id = 'idle'"), "message") == [("No runs in last 24 hours",)]


def test_slow_tasks(spark):
    day = ts("2024-01-02 01:00:00")

    def task(name, seconds, state="success", start=day):
        end = start + dt.timedelta(seconds=seconds) if seconds is not None else None
        return ("d", name, start, end, state)

    df = spark.createDataFrame(
        [task("edge", 1800), task("slow", 1800), task("slow", 1801), task("failed", 9999, "failed"),
         task("open", None), task("old", 9999, start=ts("2023-12-31 01:00:00"))],
        "dag_id string, task_id string, start_date timestamp, end_date timestamp, state string",
    )
    assert rows(health.slow_tasks(df, NOW)) == [("d", "slow", 1800.5)]
