"""Amount rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cap(col: Column, ceiling: Column, empty=0) -> Column:
    """The measure limited by another one; a missing measure counts as ``empty``."""
    return F.when(ceiling < col, ceiling).when(col.isNull(), F.lit(empty)).otherwise(col)


def floor_zero(col: Column) -> Column:
    """Negative values become zero; null stays null (``greatest`` would give 0)."""
    return F.when(col < 0, F.lit(0)).otherwise(col)


def money(col: Column, scale: int = 2) -> Column:
    """Exact decimal for sums that do not depend on the order of addition."""
    return col.cast(f"decimal(18,{scale})")


def share(part: Column, whole: Column) -> Column:
    """part / whole; an empty or zero whole gives null."""
    return part / F.nullif(whole, F.lit(0))


def waterfall(amount: Column, prior: Column, pool: Column) -> Column:
    """What is left of ``pool`` after ``prior``, at most ``amount``; no pool gives 0."""
    left = pool - F.coalesce(prior, F.lit(0))
    return F.when(left > amount, amount).when(left > 0, left).otherwise(F.lit(0))
