"""Dates, day differences and month keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_MICROS = 86_400_000_000


def run_date(as_of: dt.date | None = None) -> Column:
    """The reference date of a run; today unless given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def run_time(as_of: dt.datetime | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24 hour periods between two instants, cut toward zero."""
    return F.timestamp_diff("DAY", earlier, later)


def calendar_days(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def floor_days(later: Column, earlier: Column) -> Column:
    """24 hour periods rounded down, so that -13 hours is -1."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(float(_DAY_MICROS)))


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def up_to_day(ts: Column, day: Column) -> Column:
    """`ts` falls on `day` or before it."""
    return ts < F.date_add(day, 1).cast("timestamp")


def seconds_between(end: Column, start: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with a Z; needs the session time zone UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
