"""Category labels. Thresholds and label texts are fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _steps(value: Column, steps: list[tuple[float, str]], default: str, strict: bool = False) -> Column:
    """First label whose lower bound `value` reaches (or exceeds, if `strict`)."""
    label = F
    for bound, name in steps:
        test = value > bound if strict else value >= bound
        label = label.when(test, F.lit(name))
    return label.otherwise(F.lit(default))


def spend_tier(total_spent: Column) -> Column:
    return _steps(total_spent, [(2000, "platinum"), (1000, "gold"), (500, "silver")], "bronze")


def spend_level(total_spent: Column) -> Column:
    return _steps(total_spent, [(1000, "High Value"), (500, "Medium Value")], "Low Value")


def churn_risk(days_inactive: Column) -> Column:
    bounds = [(365, "very_high"), (180, "high"), (90, "medium"), (30, "low")]
    return _steps(days_inactive, bounds, "very_low", strict=True)


def event_value(payment_value: Column) -> Column:
    return _steps(F.coalesce(payment_value, F.lit(0.0)), [(200, "high"), (100, "medium")], "low")


def part_of_day(hour: Column) -> Column:
    return _steps(hour, [(18, "evening"), (12, "afternoon"), (6, "morning")], "night")


def quality_tier(avg_rating: Column, review_count: Column) -> Column:
    return (
        F.when((avg_rating >= 4.5) & (review_count >= 10), "excellent")
        .when((avg_rating >= 4.0) & (review_count >= 5), "good")
        .when(avg_rating >= 3.0, "average")
        .otherwise("poor")
    )


def activity_segment(days_inactive: Column, orders: Column, spent: Column) -> Column:
    return (
        F.when((days_inactive <= 90) & (orders >= 3) & (spent >= 500), "VIP")
        .when((days_inactive <= 180) & (orders >= 2), "Active")
        .when(days_inactive <= 365, "At Risk")
        .otherwise("Churned")
    )


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    recent, gone = recency >= 4, recency <= 2
    return (
        F.when(recent & (frequency >= 4) & (monetary >= 4), "champions")
        .when(recent & (frequency >= 3), "loyal_customers")
        .when(monetary >= 4, "big_spenders")
        .when(gone & (frequency >= 3), "at_risk")
        .when(gone, "lost")
        .otherwise("potential_loyalist")
    )


def run_health(runs: Column, succeeded: Column, failed: Column) -> Column:
    return (
        F.when(F.coalesce(runs, F.lit(0)) == 0, "NO_RUNS")
        .when(failed > 2, "UNHEALTHY")
        .when(succeeded / runs < 0.8, "DEGRADED")
        .otherwise("HEALTHY")
    )


def volume_class(orders: Column) -> Column:
    return F.when(orders > 1000, "full_processing").otherwise("quick_processing")
