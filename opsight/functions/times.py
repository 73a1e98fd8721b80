"""Time arithmetic on ``timestamp_ntz`` columns.

Differences and truncations go through dates and day-time intervals, which have no time zone, so
the results do not depend on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: datetime | Column) -> Column:
    """A point in time as a zone-less column; Columns (scalar subqueries too) pass through."""
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, cut toward zero."""
    return (as_col(end) - as_col(start)).cast("interval second").cast("bigint")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less time."""
    since = as_col(ts) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint")


def whole_units(start: Column | str, end: Column | str, unit: str) -> Column:
    """Whole units from start to end, cut toward zero."""
    return (seconds_between(start, end) / F.lit(UNIT_SECONDS[unit])).cast("bigint")


def units_rounded(start: Column | str, end: Column | str, unit: str, digits: int = 1) -> Column:
    """Fractional units from start to end, rounded half away from zero."""
    return F.round(seconds_between(start, end) / UNIT_SECONDS[unit], digits)


def day_of(ts: Column | str) -> Column:
    return as_col(ts).cast("date")


def start_of_day(ts: Column | str) -> Column:
    return as_col(ts).cast("date").cast("timestamp_ntz")


def minute_of(ts: Column | str) -> Column:
    ts = as_col(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), ts))


def plus_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def month_text(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyy/MM")
