"""Code decoding, banding and ordered rule lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def decode(col: Column, mapping: Mapping, default=None, keep_unknown: bool = False) -> Column:
    """Code to label. Unknown codes become ``default``, or stay as they are."""
    out = None
    for code, label in mapping.items():
        out = F.when(col == F.lit(code), F.lit(label)) if out is None else out.when(col == F.lit(code), F.lit(label))
    fallback = col if keep_unknown else F.lit(default)
    return fallback if out is None else out.otherwise(fallback)


def band(col: Column, bands: Sequence[tuple], default=None) -> Column:
    """Closed ranges ``(low, high, label)``; ``high=None`` is open. Gaps give ``default``."""
    out = None
    for low, high, label in bands:
        test = col >= F.lit(low) if high is None else col.between(F.lit(low), F.lit(high))
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """The value of the first rule whose condition holds."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def override(mapped: Column, original: Column, null_marker: str | None = None) -> Column:
    """The mapped value where there is one. A mapped ``null_marker`` forces null."""
    if null_marker is None:
        return F.coalesce(mapped, original)
    return F.when(mapped == F.lit(null_marker), F.lit(None)).otherwise(F.coalesce(mapped, original))


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def flag_before(col: Column, day) -> Column:
    """1 for rows dated before a launch day, otherwise 0."""
    return flag(col < F.lit(day))


def null_if_value(col: Column, value) -> Column:
    """A sentinel number or text becomes null."""
    return F.nullif(col, F.lit(value))


def mask_when(cond: Column, col: Column, replacement=None) -> Column:
    """Blank out an attribute where the condition holds."""
    return F.when(cond, F.lit(replacement)).otherwise(col)
