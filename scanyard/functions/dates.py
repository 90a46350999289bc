"""Dates and times.

Every function that depends on "now" takes ``as_of``; nothing reads the clock. Bounds are
literals worked out from ``as_of`` before the query starts, so they reach the scan as plain
comparisons on the stored column. Times are zone-free.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000


def moment(value: datetime | date | str) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(value, datetime):
        return value
    return datetime(value.year, value.month, value.day)


def ts(value: datetime | date | str) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def day_start(value: datetime | date | str, shift: int = 0) -> datetime:
    """Midnight of the day, ``shift`` days later."""
    at = moment(value)
    return datetime(at.year, at.month, at.day) + timedelta(days=shift)


def month_start(value: datetime | date | str, shift: int = 0) -> datetime:
    """First midnight of the month, ``shift`` months later."""
    at = moment(value)
    months = at.year * 12 + at.month - 1 + shift
    return datetime(months // 12, months % 12 + 1, 1)


def between(c: Column, low: datetime, high: datetime) -> Column:
    """Half-open range: low <= c < high."""
    return (c >= ts(low)) & (c < ts(high))


def since(c: Column, start: datetime | date | str, inclusive: bool = True) -> Column:
    return c >= ts(start) if inclusive else c > ts(start)


def month_to_date(c: Column, as_of: datetime | date | str) -> Column:
    """From the first of the month up to, not including, today."""
    return between(c, month_start(as_of), day_start(as_of))


def previous_month(c: Column, as_of: datetime | date | str) -> Column:
    return between(c, month_start(as_of, -1), month_start(as_of))


def yesterday(c: Column, as_of: datetime | date | str) -> Column:
    return between(c, day_start(as_of, -1), day_start(as_of))


def us_date(c: Column) -> Column:
    """Text as month/day/year."""
    return F.date_format(c, "MM/dd/yyyy")


def iso_date(c: Column) -> Column:
    """Text as year-month-day."""
    return F.date_format(c, "yyyy-MM-dd")


def day_of(c: Column) -> Column:
    return F.to_date(c)


def first_of_month(c: Column) -> Column:
    return F.trunc(c, "MM")


def shift_months(c: Column, months: int) -> Column:
    """First day of the month that lies ``months`` away."""
    return F.add_months(F.trunc(c, "MM"), months)


def shift_days(c: Column, days: int) -> Column:
    return F.date_add(F.to_date(c), days)


def parse_us_ts(c: Column) -> Column:
    """Read text such as ``5/1/2021 0:0:0``."""
    return F.to_timestamp_ntz(c, F.lit("M/d/yyyy H:m:s"))


def _micros_of_day(c: Column) -> Column:
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    part = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return seconds.cast("bigint") * 1_000_000 + part


def elapsed_days(start: Column, end: Column) -> Column:
    """Days from start to end with the fraction, free of time-zone shifts."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    micros = days * _MICROS_PER_DAY + _micros_of_day(end) - _micros_of_day(start)
    return micros.cast("double") / F.lit(float(_MICROS_PER_DAY))


def whole_days(days: Column) -> Column:
    """Drop the fraction, towards zero."""
    return days.cast("int")


def last_day_before(c: Column) -> Column:
    """The latest date whose midnight lies strictly before ``c``."""
    day = F.to_date(c)
    return F.when(day.cast("timestamp_ntz") == c, F.date_sub(day, 1)).otherwise(day)
