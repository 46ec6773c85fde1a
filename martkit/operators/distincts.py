"""Exact distinct counts from states that can be added up.

A count of distinct values over a period can't be added from the counts of its days. Here each day's facts leave
one small state per group: bitmaps of the dense numbers of their values, stored with the facts. States of any days or
groups are OR-ed, and the bits counted, so a cumulative counter needs yesterday's state and
one day of facts instead of the whole history. Values get their numbers from a dictionary that only grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from martkit.operators.rowids import add_row_id
from martkit.sources.staging import Stage


def dictionary(df: DataFrame, value: str, stage: Stage, known: DataFrame | None = None) -> DataFrame:
    """(value, number from 1) of every value of ``df`` and of the ``known`` dictionary, whose numbers stay.

    New values are numbered in their order after the largest known number; null has none. ``stage`` must write.
    """
    fresh = df.select(value).filter(F.col(value).isNotNull()).distinct()
    if known is None:
        return stage(add_row_id(fresh, [value], "number", stage), "dictionary")
    fresh = fresh.join(known.select(value), value, "left_anti")
    after = known.agg(F.coalesce(F.max("number") + 1, F.lit(1))).first()[0]
    return stage(known.select(value, "number").unionByName(add_row_id(fresh, [value], "number", stage, start=after)), "dictionary")


def states(df: DataFrame, groups: Sequence[str], value: str, numbers: DataFrame) -> DataFrame:
    """Rows (groups, bucket, bits): bitmaps of 32,768 numbers each, as many as the group's values touch.

    ``numbers`` is a dictionary that holds every value of ``df``; null values count nowhere. Copies of a value
    within a group are removed on the map side first, so a hot group is not gathered.
    """
    held = df.select(*groups, value).filter(F.col(value).isNotNull()).distinct().join(numbers, value)
    return held.groupBy(*groups, F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merge_states(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """States of coarser groups, or of several days, as one: OR of the bitmaps."""
    return parts.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_states(parts: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Distinct values of each group of any set of states. Without groups one row, 0 for no states."""
    merged = merge_states(parts, groups)
    return merged.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def advance(total: DataFrame, day: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The cumulative state after one more day of states; repeating a day changes nothing."""
    columns = [*groups, "bucket", "bits"]
    return merge_states(total.select(*columns).unionByName(day.select(*columns)), groups)
