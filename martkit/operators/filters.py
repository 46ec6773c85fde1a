"""Filters. Date bounds are computed on the driver, so they reach the scan as literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import dates


def standard_exclusions(df: DataFrame, *, keep: Mapping[str, Sequence] | None = None, drop: Mapping[str, Sequence] | None = None,
                        at_least: Mapping[str, object] | None = None) -> DataFrame:
    """IN, NOT IN and lower-bound rules. As in SQL, NOT IN drops null values."""
    tests: list[Column] = [F.col(c).isin(list(v)) for c, v in (keep or {}).items()]
    tests += [~F.col(c).isin(list(v)) for c, v in (drop or {}).items()]
    tests += [F.col(c) >= F.lit(v) for c, v in (at_least or {}).items()]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def last_days(df: DataFrame, col: str, n: int, as_of: date | str) -> DataFrame:
    """Rows of the last ``n`` days before ``as_of`` and later."""
    return df.filter(F.col(col) >= F.lit(dates.days_before(as_of, n)))


def since_month_start(df: DataFrame, col: str, months: int, as_of: date | str) -> DataFrame:
    """Rows since the first day of the month ``months`` months back."""
    return df.filter(F.col(col) >= F.lit(dates.first_of_month(dates.add_months(as_of, -months))))


def complete_months(df: DataFrame, col: str, n: int, as_of: date | str) -> DataFrame:
    """The last ``n`` complete calendar months."""
    end = dates.first_of_month(as_of)
    return between_dates(df, col, dates.add_months(end, -n), end - timedelta(days=1))


def month_to_date(df: DataFrame, col: str, as_of: date | str) -> DataFrame:
    """From the start of yesterday's month up to and including yesterday."""
    yesterday = dates.days_before(as_of, 1)
    return between_dates(df, col, dates.first_of_month(yesterday), yesterday)


def changed_on(df: DataFrame, day: date | str, cols: Sequence[str]) -> DataFrame:
    """Rows created or updated on one day."""
    low, high = dates.as_date(day), dates.days_before(day, -1)
    tests = [(F.col(c) >= F.lit(low)) & (F.col(c) < F.lit(high)) for c in cols]
    return df.filter(reduce(lambda a, b: a | b, tests))


def between_dates(df: DataFrame, col: str, first: date | str, last: date | str) -> DataFrame:
    """Whole days ``first`` .. ``last``, also on a timestamp column."""
    return df.filter((F.col(col) >= F.lit(dates.as_date(first))) & (F.col(col) < F.lit(dates.days_before(last, -1))))


def load_window(df: DataFrame, col: str, mode: str, n: int, as_of: date | str) -> DataFrame:
    """One job for both loads: ``full`` reads everything, ``delta`` the last ``n`` days."""
    if mode not in ("full", "delta"):
        raise ValueError(f"unknown mode {mode!r}")
    return df if mode == "full" else last_days(df, col, n, as_of)


def exclude_tuples(df: DataFrame, cols: Sequence[str], tuples: Sequence[tuple]) -> DataFrame:
    """Drop listed combinations. A row with a null part matches none of them and is kept."""
    def same(values: tuple) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(cols, values, strict=True)])

    return df.filter(~reduce(lambda a, b: a | b, [same(t) for t in tuples])) if tuples else df


def exclude_unless(df: DataFrame, listed: DataFrame, on: Sequence[str], exempt: Column) -> DataFrame:
    """Drop rows whose key is listed unless they are exempt; one anti join."""
    keys = listed.select([F.col(c).alias(f"_x_{c}") for c in on])
    hit = [F.col(c) == F.col(f"_x_{c}") for c in on]
    return df.join(keys, reduce(lambda a, b: a & b, hit) & ~F.coalesce(exempt, F.lit(False)), "left_anti")
