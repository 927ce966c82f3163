"""A key that owns a large part of the rows must not end up in one task."""

from __future__ import annotations

import contextlib

from conftest import rows
from pyspark.sql import functions as F

from tradewinds.operators.joins import join_lines, latest_rows
from tradewinds.operators.rollups import rollup_with_members


@contextlib.contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SMALL_SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_lines(spark):
    """A third of the lines belong to order 7."""
    return spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000).cast("string").alias("order_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
        F.col("id").alias("n"),
    )


def test_hot_order_is_split_where_one_side_is_grouped(spark):
    lines = hot_lines(spark)
    # Grouped by the join key, so it would reach the join without a shuffle of its own.
    orders = lines.groupBy("order_id").agg(F.max("n").alias("top"))
    with settings(spark, **NO_BROADCAST, **SMALL_SKEW):
        joined = join_lines(lines, orders, "order_id").groupBy("product_id").agg(F.sum("top").alias("s"))
        total = joined.agg(F.sum("s"), F.count("*"))
        got = rows(total)
        assert "skew=true" in final_plan(total)
        plain = lines.join(orders, "order_id")
        assert got == rows(plain.agg(F.sum("top"), F.count("*")))


def test_hot_key_spreads_over_its_members(spark):
    lines = hot_lines(spark)
    with settings(spark, **NO_BROADCAST):
        df = rollup_with_members(
            lines, ["order_id"], {"products": F.col("product_id"), "tens": F.col("n") % 10}, {"n_sum": F.col("n")}
        )
        plan = final_plan(df)
        assert "collect_set" not in plan and "Expand" not in plan
        want = lines.groupBy("order_id").agg(
            F.sum("n"), F.count_distinct("product_id"), F.count_distinct(F.col("n") % 10)
        )
        assert rows(df) == rows(want)


def test_latest_rows_are_cut_before_the_shuffle(spark):
    lines = hot_lines(spark)
    df = latest_rows(lines, ["order_id"], [F.desc("n")], 3)
    assert df.where("order_id = '7'").count() == 3
    assert final_plan(df).count("WindowGroupLimit") == 2


def test_joins_by_order_shuffle_each_table_once(spark, small):
    """Grouping by order after the joins by order adds no exchange."""
    from tradewinds.plans import reports

    with settings(spark, **NO_BROADCAST):
        plan = final_plan(reports.revenue_by_month(small))
    # orders, payments, and the sums per month
    assert plan.count("Exchange hashpartitioning") == 3
