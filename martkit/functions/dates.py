"""Dates and times. Wall-clock offsets and "today" are always arguments."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def as_date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(str(day)[:10])


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def local_date(ts: Column, offset_hours: int = 8) -> Column:
    """Calendar day after taking the stored offset off again."""
    return shift_hours(ts, -offset_hours).cast("date")


def iso_millis(ts: Column, offset_hours: int = 16) -> Column:
    """ISO text with a literal ``.000Z`` as the legacy feed writes it."""
    return F.date_format(shift_hours(ts, -offset_hours), "yyyy-MM-dd'T'HH:mm:ss'.000Z'")


def month_key(ts: Column, pattern: str = "yyyyMM") -> Column:
    return F.date_format(ts, pattern)


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def to_minute(ts: Column) -> Column:
    """Cut seconds off; the result has no zone."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, truncated toward zero."""
    return F.timestamp_diff("MINUTE", start, end)


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def weekday_kind(day: Column, weekday: str = "Weekday", weekend: str = "Weekend") -> Column:
    return F.when(F.weekday(day) < 5, F.lit(weekday)).when(F.weekday(day).isNotNull(), F.lit(weekend))


def clamp_year(ts: Column, min_year: int, replacement=None) -> Column:
    """Replace implausibly early dates; null stays null."""
    new = replacement if isinstance(replacement, Column) else F.lit(replacement)
    return F.when(F.year(ts) < F.lit(min_year), new).otherwise(ts)


def day_number(start: Column, current: Column) -> Column:
    """1 on the first day of a programme."""
    return F.datediff(current, start) + F.lit(1)


def active_months(first: Column, last: Column, floor: int = 6) -> Column:
    """Rounded months between two dates, never below ``floor``."""
    return F.greatest(F.round(F.months_between(last, first)), F.lit(float(floor)))


# Driver-side day arithmetic: bounds become literals, so filters on the raw
# column reach the Parquet scan and prune partitions.

def add_months(day: date | str, n: int) -> date:
    day = as_date(day)
    index = day.year * 12 + day.month - 1 + n
    year, month = divmod(index, 12)
    return date(year, month + 1, min(day.day, month_days(year, month + 1)))


def month_days(year: int, month: int) -> int:
    following = date(year + month // 12, month % 12 + 1, 1)
    return (following - date(year, month, 1)).days


def first_of_month(day: date | str) -> date:
    return as_date(day).replace(day=1)


def days_before(day: date | str, n: int) -> date:
    return as_date(day) - timedelta(days=n)
