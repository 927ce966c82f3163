"""Run health of scheduled pipelines, from their run and task logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.functions import labels
from tradewinds.functions.dates import run_time, seconds_between
from tradewinds.operators.joins import latest_rows

# Runs looked at per pipeline, and the mean duration that makes a task slow.
RUNS_PER_PIPELINE = 10
SLOW_TASK_SECONDS = 1800


def run_health(run_log: DataFrame, expected: list[str], now: dt.datetime | None = None) -> DataFrame:
    """Per expected pipeline: its latest runs of the last 24 hours and a status."""
    since = run_time(now) - F.expr("INTERVAL 1 DAY")
    recent = run_log.where(F.col("dag_id").isin(expected) & (F.col("execution_date") >= since))
    last_runs = latest_rows(recent, ["dag_id"], [F.desc("execution_date"), "run_id"], RUNS_PER_PIPELINE)
    minutes = seconds_between(F.col("end_date"), F.col("start_date")) / 60
    stats = last_runs.groupBy("dag_id").agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("state") == "success").alias("success"),
        F.count_if(F.col("state") == "failed").alias("failed"),
        F.round(F.coalesce(F.avg(minutes), F.lit(0.0)), 2).alias("avg_duration_min"),
    )
    pipelines = run_log.sparkSession.createDataFrame([(p,) for p in expected], "dag_id string")
    status = labels.run_health(F.col("runs"), F.col("success"), F.col("failed"))
    return (
        pipelines.join(stats, "dag_id", "left")
        .withColumn("status", status)
        .withColumn("message", F.when(F.col("status") == "NO_RUNS", "No runs in last 24 hours"))
        .withColumn("needs_attention", F.col("status").isin("UNHEALTHY", "NO_RUNS"))
    )


def slow_tasks(task_log: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Successful tasks of the last 24 hours that take more than half an hour on average."""
    since = run_time(now) - F.expr("INTERVAL 1 DAY")
    return (
        task_log.where(
            (F.col("start_date") >= since) & F.col("end_date").isNotNull() & (F.col("state") == "success")
        )
        .groupBy("dag_id", "task_id")
        .agg(F.avg(seconds_between(F.col("end_date"), F.col("start_date"))).alias("avg_duration_sec"))
        .where(F.col("avg_duration_sec") > SLOW_TASK_SECONDS)
    )
