"""One row, or the tied rows, per key.

``rank`` and ``row_number`` filters let Spark cut each map partition down to the
candidates before the shuffle (WindowGroupLimit), so a hot key sends few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window


def first_ranked(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], ties: bool = True) -> DataFrame:
    """Rows ranked first per key; ``ties=False`` keeps one (give a total order then)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn("_rank", rank.over(w)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """The newest row per key, exactly one."""
    return first_ranked(df, keys, [F.col(ts).desc(), *tie_breakers], ties=False)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int = 1, name: str | None = None) -> DataFrame:
    """The first ``k`` rows per key in the given order."""
    rank = name or "_rank"
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)
    return out if name else out.drop(rank)


def best_by(df: DataFrame, keys: Sequence[str | Column], priority: Column, recency: str) -> DataFrame:
    """Highest priority first, then the newest; ties kept."""
    return first_ranked(df, keys, [priority.desc(), F.col(recency).desc()])


def latest_by_max(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """All rows of each key's highest version.

    A version may hold very many rows of one key, so this is an aggregation joined
    back (AQE splits a skewed side) and not a window over the key.
    """
    top = df.groupBy(*keys).agg(F.max(version).alias("_top")).withColumnsRenamed({k: f"_t_{k}" for k in keys})
    cond = F.col(version) == F.col("_top")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_t_{k}"))
    return df.join(top, cond, "left_semi")


def dedupe_min(df: DataFrame, keys: Sequence[str | Column], row_id: str) -> DataFrame:
    """The row with the smallest id per duplicate key."""
    return first_ranked(df, keys, [row_id], ties=False)


def daily_representative(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], amount: str, name: str) -> DataFrame:
    """One row per key (for instance member and day) carrying the key's total."""
    totals = df.groupBy(*keys).agg(F.sum(amount).alias(name)).withColumnsRenamed({k: f"_t_{k}" for k in keys})
    rep = first_ranked(df, keys, order, ties=False)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    return rep.join(totals, cond, "left").drop(*[f"_t_{k}" for k in keys])


def first_on_day(events: DataFrame, starts: DataFrame, key: str, ts: str, start: str, offset_hours: int = 0) -> DataFrame:
    """The first event (ties kept) of each key on the day it started."""
    from martkit.functions.dates import local_date

    side = starts.select(F.col(key).alias("_sk"), local_date(F.col(start), offset_hours).alias("_sd"))
    same_day = events.join(side, (F.col(key) == F.col("_sk")) & (local_date(F.col(ts), offset_hours) == F.col("_sd")), "left_semi")
    return first_ranked(same_day, [key], [ts])
