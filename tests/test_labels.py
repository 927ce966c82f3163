"""Both sides of every threshold."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import ts
from tradewinds.functions import dates, labels, numbers
from tradewinds.operators.days import orders_between


def value(spark, column):
    return spark.range(1).select(column).collect()[0][0]


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize("spent,tier,level", [
    (2000.0, "platinum", "High Value"), (1999.99, "gold", "High Value"), (1000.0, "gold", "High Value"),
    (999.99, "silver", "Medium Value"), (500.0, "silver", "Medium Value"), (499.99, "bronze", "Low Value"),
    (None, "bronze", "Low Value"),
])
def test_spend(spark, spent, tier, level):
    column = lit(spent).cast("double")
    assert (value(spark, labels.spend_tier(column)), value(spark, labels.spend_level(column))) == (tier, level)


@pytest.mark.parametrize("days,risk", [
    (30, "very_low"), (31, "low"), (90, "low"), (91, "medium"), (180, "medium"), (181, "high"), (365, "high"),
    (366, "very_high"),
])
def test_churn(spark, days, risk):
    assert value(spark, labels.churn_risk(lit(days))) == risk


@pytest.mark.parametrize("args,segment", [
    ((90, 3, 500.0), "VIP"), ((91, 3, 500.0), "Active"), ((90, 3, 499.99), "Active"), ((180, 2, 0.0), "Active"),
    ((181, 2, 0.0), "At Risk"), ((10, 1, 9999.0), "At Risk"), ((365, 9, 0.0), "At Risk"), ((366, 9, 9999.0), "Churned"),
])
def test_activity(spark, args, segment):
    assert value(spark, labels.activity_segment(*map(lit, args))) == segment


@pytest.mark.parametrize("scores,segment", [
    ((4, 4, 4), "champions"), ((4, 3, 5), "loyal_customers"), ((4, 4, 3), "loyal_customers"), ((5, 2, 4), "big_spenders"),
    ((1, 5, 4), "big_spenders"), ((2, 3, 3), "at_risk"), ((2, 2, 3), "lost"), ((3, 5, 3), "potential_loyalist"),
    ((4, 2, 3), "potential_loyalist"),
])
def test_rfm(spark, scores, segment):
    assert value(spark, labels.rfm_segment(*map(lit, scores))) == segment


@pytest.mark.parametrize("rating,n,tier", [
    (4.5, 10, "excellent"), (4.5, 9, "good"), (4.0, 5, "good"), (4.9, 4, "average"), (3.0, 1, "average"), (2.99, 99, "poor"),
    (None, 0, "poor"),
])
def test_quality(spark, rating, n, tier):
    assert value(spark, labels.quality_tier(lit(rating).cast("double"), lit(n))) == tier


@pytest.mark.parametrize("runs,ok,failed,status", [
    (None, None, None, "NO_RUNS"), (0, 0, 0, "NO_RUNS"), (10, 7, 3, "UNHEALTHY"), (10, 7, 2, "DEGRADED"),
    (10, 8, 2, "HEALTHY"), (5, 4, 0, "HEALTHY"),
])
def test_health(spark, runs, ok, failed, status):
    args = [lit(x).cast("bigint") for x in (runs, ok, failed)]
    assert value(spark, labels.run_health(*args)) == status


def test_volume(spark):
    assert value(spark, labels.volume_class(lit(1000))) == "quick_processing"
    assert value(spark, labels.volume_class(lit(1001))) == "full_processing"


def test_day_differences(spark):
    late, early = lit(ts("2024-01-02 12:00:00")), lit(ts("2024-01-01 23:00:00"))
    got = [value(spark, f(late, early)) for f in (dates.whole_days, dates.calendar_days, dates.floor_days)]
    assert got == [0, 1, 0]
    got = [value(spark, f(early, late)) for f in (dates.whole_days, dates.calendar_days, dates.floor_days)]
    assert got == [0, -1, -1]


def test_days_as_ranges(spark):
    day = dt.date(2024, 1, 1)
    texts = ["2023-12-31 23:59:59.999999", "2024-01-01 00:00:00", "2024-01-01 23:59:59.999999", "2024-01-02 00:00:00"]
    orders = spark.createDataFrame([(ts(t),) for t in texts], "order_purchase_timestamp timestamp")
    dated = orders.withColumn("order_date", F.to_date("order_purchase_timestamp"))
    for df in (orders, dated):
        assert orders_between(df, lit(day), lit(day)).count() == 2
        assert orders_between(df, None, lit(day)).count() == 3


def test_numbers(spark):
    assert value(spark, numbers.ratio(lit(1), lit(0))) is None
    assert value(spark, numbers.percent_change(lit(50.0), lit(100.0))) == -50.0
    assert value(spark, numbers.money_mean(lit(381.27), lit(6))) == 63.55
    assert value(spark, numbers.money_mean(lit(0.0), lit(0))) is None


@pytest.mark.parametrize("amounts,weights", [
    ([0.1] * 3, [1] * 3), ([5.0], [1]), ([5.0], [4]), ([1_000_000.0, 1_000_000.01] * 4, [1] * 8),
    ([99_999_999_999.99, 99_999_999_999.98, 0.01], [3, 1, 2]), ([-4.5, 4.5, 1 / 3], [1, 1, 7]), ([None, 2.0, 3.0], [1, 1, 1]),
    ([float("nan"), 1e15, 2.0, 4.0], [1, 1, 1, 1]),
])
def test_exact_stddev_of_weighted_amounts(spark, amounts, weights):
    """Against exact fractions; amounts out of range take no part."""
    df = spark.createDataFrame(list(zip(amounts, weights)), "x double, w bigint")
    x, w = F.col("x"), F.col("w")
    got = df.agg(
        F.sum(F.when(numbers.units(x).isNotNull(), w)).alias("n"), F.sum(numbers.units(x) * w).alias("s"),
        F.sum(F.try_multiply(numbers.unit_squares(x), w)).alias("q"),
    ).select(numbers.exact_stddev(F.col("n"), F.col("s"), F.col("q")).alias("d")).first().d
    inside = [(Fraction(str(round(a, 6))), k) for a, k in zip(amounts, weights) if a is not None and abs(a) < 1e12]
    n = sum(k for _, k in inside)
    if n < 2:
        assert got is None
    else:
        mean = sum(a * k for a, k in inside) / n
        want = float(sum((a - mean) ** 2 * k for a, k in inside) / (n - 1)) ** 0.5
        assert got == pytest.approx(want, rel=1e-9, abs=1e-9)
