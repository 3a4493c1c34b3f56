"""Date and time helpers (the session time zone is UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    """DATE_TRUNC('month', ts) as a DATE bucket."""
    return F.trunc(F.to_date(ts), "month")


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    """EXTRACT(EPOCH FROM end - start) as DOUBLE seconds."""
    return micros_between(start, end).cast("double") / F.lit(1e6)


def days_between(start: Column, end: Column) -> Column:
    """EXTRACT(EPOCH FROM end - start) / 86400.0 as DOUBLE days."""
    return micros_between(start, end).cast("double") / F.lit(86400e6)


def ts_literal(value: str | dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal (the test tables store naive timestamps)."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def date_literal(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def year_range(ts: Column, first_year: int, last_year: int) -> Column:
    """first_year <= year(ts) <= last_year, written as a range on ts.

    A range on the raw column reaches the Parquet reader as pushed filters;
    ``year(ts) IN (...)`` alone would not.
    """
    lo = ts_literal(f"{first_year:04d}-01-01 00:00:00")
    hi = ts_literal(f"{last_year + 1:04d}-01-01 00:00:00")
    return (ts >= lo) & (ts < hi)


def interval_days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def interval_hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def format_ts(ts: Column) -> Column:
    """``to_char(ts, 'YYYY-MM-DD HH24:MI:SS')``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def interval_from_micros(us: Column) -> Column:
    """A day-time INTERVAL from a (possibly fractional) number of microseconds,
    rounded to whole microseconds."""
    secs = (F.round(us) / F.lit(1e6)).cast("decimal(18,6)")
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def relative_time(as_of: str, days: int = 0, hours: int = 0) -> Column:
    """``NOW() - INTERVAL ...`` with an explicit, reproducible "now"; negative
    offsets give ``NOW() + INTERVAL ...``."""
    return ts_literal(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))
