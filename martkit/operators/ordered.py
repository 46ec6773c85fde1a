"""Ordered computations per key that survive a hot key.

A plain window sends all rows of a key to one task. Here a monotone ``segment`` of the
order column (a day, a block of ids) cuts every key into pieces. A partial aggregation
gives one small row per (key, segment); a window over those rows turns them into what the
other pieces contribute, and that contribution joins its piece as one more row. So the
large input is shuffled once, by (key, segment), and needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from martkit.functions.numbers import waterfall

_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


def id_blocks(col: str, size: int) -> Column:
    """Segment for an integer order column: blocks of ``size`` consecutive values."""
    return F.floor(F.col(col) / F.lit(size))


def day_blocks(col: str, unit: str = "day") -> Column:
    """Segment for a timestamp order column."""
    return F.date_trunc(unit, F.col(col)).cast("timestamp_ntz")


def _with_carry(base: DataFrame, carry: DataFrame) -> DataFrame:
    """Data rows plus one carry row per piece; ``_row`` tells them apart."""
    return base.withColumn("_row", F.lit(1)).unionByName(carry.withColumn("_row", F.lit(0)), allowMissingColumns=True)


def _without_carry(df: DataFrame, *helpers: str) -> DataFrame:
    return df.filter("_row = 1").drop("_row", "_seg", *helpers)


def running_sum(df: DataFrame, keys: Sequence[str], order: str, amount: str, name: str, segment: Column,
                strictly_before: bool = False) -> DataFrame:
    """Sum of ``amount`` over rows of the key up to (or strictly before) this order value.

    Rows with equal order values are peers and get the same sum.
    """
    base = df.withColumns({"_seg": segment, "_amount": F.col(amount)})
    totals = base.groupBy(*keys, "_seg").agg(F.sum("_amount").alias("_tot"))
    earlier = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(_FIRST, -1)
    carry = totals.select(*keys, "_seg", F.sum("_tot").over(earlier).alias("_amount"))
    rows = _with_carry(base, carry)
    piece = Window.partitionBy(*keys, "_seg")
    total = F.coalesce(F.sum("_amount").over(piece.orderBy("_row", order).rangeBetween(_FIRST, Window.currentRow)), F.lit(0))
    if strictly_before:
        total = total - F.coalesce(F.sum("_amount").over(Window.partitionBy(*keys, "_seg", "_row", order)), F.lit(0))
    return _without_carry(rows.withColumn(name, total), "_amount")


def ordinal(df: DataFrame, keys: Sequence[str], order: str, name: str, segment: Column) -> DataFrame:
    """``rank()`` of each row within its key, ascending."""
    base = df.withColumn("_seg", segment)
    sizes = base.groupBy(*keys, "_seg").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(_FIRST, -1)
    carry = sizes.select(*keys, "_seg", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    piece = Window.partitionBy(*keys, "_seg").orderBy("_row", order)
    # The carry row is the first of its piece, so it takes rank 1 away from the data rows.
    rows = _with_carry(base, carry).withColumns({"_local": F.rank().over(piece), "_shift": F.first("_before").over(piece)})
    return _without_carry(rows.withColumn(name, (F.col("_local") - 1 + F.col("_shift")).cast("long")), "_before", "_local", "_shift")


def pair_next(df: DataFrame, keys: Sequence[str], ts: str, op: str, first: str, second: str, name: str,
              segment: Column) -> DataFrame:
    """Each ``first`` row with the time of the first strictly later ``second`` row of its key.

    Unmatched rows stay with null; rows with equal times all stay; a tie among the
    second rows does not repeat a row.
    """
    base = df.filter(F.col(op).isin(first, second)).withColumns({"_seg": segment, "_out": F.when(F.col(op) == F.lit(second), F.col(ts))})
    marks = base.groupBy(*keys, "_seg").agg(F.min("_out").alias("_min"))
    later = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(1, _LAST)
    carry = marks.select(*keys, "_seg", F.min("_min").over(later).alias("_out"))
    # Carry first, then newest first and, at equal times, second rows last: everything
    # above a first row is strictly later or another first row.
    down = Window.partitionBy(*keys, "_seg").orderBy("_row", F.col(ts).desc(), F.col("_out").isNotNull()).rowsBetween(_FIRST, Window.currentRow)
    rows = _with_carry(base, carry).withColumn(name, F.min("_out").over(down))
    return _without_carry(rows.filter(F.col(op) == F.lit(first)), "_out")


def allocate(df: DataFrame, keys: Sequence[str], order: str, amount: str, pool: str, name: str, segment: Column) -> DataFrame:
    """Spread the key's ``pool`` over its rows in order, each at most its ``amount``."""
    out = running_sum(df, keys, order, amount, "_prior", segment, strictly_before=True)
    return out.withColumn(name, waterfall(F.col(amount), F.col("_prior"), F.col(pool))).drop("_prior")
