"""Wall-clock expressions. Nothing here reads the current time: dates are passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_SHIFT = "05:30"  # fixed value: hours and minutes from stored UTC to local time


def to_local(ts: Column, shift: str = LOCAL_SHIFT) -> Column:
    return ts + F.expr(f"INTERVAL '{shift}' HOUR TO MINUTE")


def epoch_to_local(seconds: Column, shift: str = LOCAL_SHIFT) -> Column:
    """Local wall-clock time from epoch seconds stored as text or number."""
    s = seconds.try_cast("bigint")
    since = F.make_dt_interval(days=F.floor(s / F.lit(86_400)).try_cast("int"), secs=F.pmod(s, F.lit(86_400)))
    return to_local(F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + since, shift)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock value, whatever the session's time zone."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes as double, counted on whole seconds of both ends."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def cutoff(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)
