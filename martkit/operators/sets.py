"""Unions, overlays and splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from martkit.functions import dates
from martkit.operators.projection import pad_to


def union_all(*dfs: DataFrame, fill: bool = False) -> DataFrame:
    """By name, deliberately: a positional union silently mixes columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def union_evidence(parts: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """Unlike sources padded to one schema and unioned."""
    return union_all(*[pad_to(p, schema) for p in parts])


def overlay(history: DataFrame, delta: DataFrame, date_col: str, cut: date | str, trusted_history: bool = False) -> DataFrame:
    """Frozen history before ``cut`` plus the recomputed delta from ``cut`` on, without duplicates.

    Both sides use one date column, so no row is lost or doubled between them; the
    history bound is a literal and prunes partitions. A history that is this overlay's
    own earlier output has no duplicates: with ``trusted_history`` only the delta
    is shuffled for removing them, and the frozen days pass straight through.
    """
    cut = dates.as_date(cut)
    old = history.filter(F.col(date_col) < F.lit(cut))
    new = delta.filter(F.col(date_col) >= F.lit(cut))
    return old.unionByName(new.distinct()) if trusted_history else old.unionByName(new).distinct()


def override_rows(base: DataFrame, fixes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Manual corrections replace the base rows of their keys."""
    return base.join(fixes.select(*key).distinct(), list(key), "left_anti").unionByName(fixes)


def split_by(df: DataFrame, cond: Column, null_to_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows where the condition holds, the rest). A null condition goes to one side, stated here."""
    test = F.coalesce(cond, F.lit(null_to_first))
    return df.filter(test), df.filter(~test)


def latest_periods(df: DataFrame, col: str, n: int) -> DataFrame:
    """The newest ``n`` distinct periods (a top-n report)."""
    return df.select(col).distinct().orderBy(F.col(col).desc()).limit(n)
