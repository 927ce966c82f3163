"""Guarded division and statistics over weighted sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null where the denominator is null or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def percent_change(now: Column, before: Column) -> Column:
    return F.round(ratio(now - before, before) * F.lit(100.0), 2)


def money_mean(total: Column, n: Column) -> Column:
    """Mean to 2 places, divided as decimals.

    The last bit of a sum of doubles depends on the order of adding; here a mean that
    lies between two cents comes out the same on every run.
    """
    exact = F.when(n > 0, F.round(total, 6).cast("decimal(28,6)") / n)
    return F.round(exact, 2).cast("double")


_UNITS = 1_000_000


def units(value: Column) -> Column:
    """An amount of money as a whole number of millionths; null for NaN and amounts of 10^12 and more."""
    exact = value.cast("double").try_cast("decimal(18,6)")
    return (exact * F.lit(_UNITS).cast("decimal(7,0)")).try_cast("decimal(18,0)")


def unit_squares(value: Column) -> Column:
    return F.try_multiply(units(value), units(value)).cast("decimal(38,0)")


def exact_stddev(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from the weighted count, sum of `units` and sum of `unit_squares`.

    The sums are whole numbers, so they merge through any roll-up without rounding, in any order. The squared
    deviations from the whole number next to the mean follow exactly too, however large and close the values
    are. Null where a sum has left the range of 38 digits.
    """
    whole = "decimal(38,0)"
    near = F.round(F.try_divide(total, n.cast("decimal(20,0)"))).try_cast("decimal(20,0)")
    around = F.try_add(
        F.try_subtract(squares, F.try_multiply(2 * near, total).try_cast(whole)),
        F.try_multiply(F.try_multiply(near, near).try_cast(whole), n.cast("decimal(20,0)")).try_cast(whole),
    ).cast("double")
    rest = F.try_subtract(total, F.try_multiply(near, n.cast("decimal(20,0)")).try_cast(whole)).cast("double")
    spread = F.greatest(around - rest * rest / n, F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n - 1)) / F.lit(float(_UNITS)))
