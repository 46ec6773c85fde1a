"""Checks run before and after a load; each returns rows to look at."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from martkit.operators.joins import anti


def period_totals(df: DataFrame, period: str, amount: str) -> DataFrame:
    """Row count and total per period."""
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).alias("total"))


def name_mismatches(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Keys both sources know under different names."""
    other = b.select(F.col(key), F.col(name).alias("other_name"))
    return a.select(key, name).join(other, key).filter(~F.col(name).eqNullSafe(F.col("other_name")))


def unmapped_active(active: DataFrame, mapping: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Active keys the mapping does not know."""
    return anti(active, mapping, on)


def amount_alerts(df: DataFrame, amount: str, ceilings: Mapping[str, float], place: str, default: float) -> DataFrame:
    """Rows above the ceiling of their place."""
    from martkit.functions.codes import decode

    ceiling = decode(F.col(place), dict(ceilings), default)
    return df.filter(F.col(amount) > ceiling).withColumn("ceiling", ceiling.cast("double"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
