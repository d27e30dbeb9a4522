"""Date parts.  The wall clock is always a parameter, so that a rerun can repeat a result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(date: Column) -> Column:
    """first day of the month, as a date."""
    return F.trunc(date, "MM")


def truncate(unit: str, ts: Column) -> Column:
    """timestamp cut to ``unit``, without time zone (Spark's own result has one: use a UTC session)."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def day_of_week(date: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(date) - 1


def days_between(start: Column, end: Column) -> Column:
    """F16: ``end - start`` in days."""
    return F.datediff(end, start)


def today(as_of: dt.date | None = None) -> Column:
    """F17"""
    return F.lit(as_of) if as_of else F.current_date()


def now(at: dt.datetime | None = None) -> Column:
    """F18"""
    return F.lit(at) if at else F.current_timestamp()
