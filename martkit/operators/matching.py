"""Joins that are not plain equality, planned as hash or merge joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from martkit.functions.dates import epoch_micros
from martkit.operators.joins import all_of


def interval_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_ts: str, right_ts: str,
                  before_s: int, after_s: int, how: str = "inner") -> DataFrame:
    """Pairs with equal keys and ``left_ts - before <= right_ts <= left_ts + after``.

    ``keys`` maps left to right columns; the frames must not share other names.
    Time is cut into buckets as wide as the interval. The right side lies in one
    bucket and the left side looks into the two it can touch, so a key with very
    many rows is spread over its buckets and only neighbours in time are compared.
    """
    width = (before_s + after_s + 1) * 1_000_000
    micros = epoch_micros(F.col(left_ts))
    low = F.floor((micros - before_s * 1_000_000) / width)
    high = F.floor((micros + after_s * 1_000_000) / width)
    lhs = left.withColumn("_bucket", F.explode(F.sequence(low, high)))
    rhs = right.withColumn("_rbucket", F.floor(epoch_micros(F.col(right_ts)) / width))
    conds = [F.col(a) == F.col(b) for a, b in keys.items()] + [F.col("_bucket") == F.col("_rbucket")]
    conds.append(F.col(right_ts).between(F.col(left_ts) - F.make_dt_interval(secs=F.lit(before_s)),
                                         F.col(left_ts) + F.make_dt_interval(secs=F.lit(after_s))))
    if how not in ("inner",):
        raise ValueError("outer forms would repeat unmatched rows once per bucket; anti-join the keys instead")
    return lhs.join(rhs, all_of(conds), how).drop("_bucket", "_rbucket")


def count_days_between(df: DataFrame, start: str, end: str, calendar: DataFrame, day: str, name: str, as_of) -> DataFrame:
    """Distinct calendar days inside ``[start, end]`` per row; an open end counts up to ``as_of``.

    A running count over the day axis turns the range join into two equality
    lookups: ``count up to end`` minus ``count up to the day before start``. The day
    axis is one row per day between the extremes, so it is bounded by the time span.
    """
    last = F.coalesce(F.col(end).cast("date"), F.lit(as_of).cast("date"))
    first = F.date_sub(F.col(start).cast("date"), 1)
    rows = df.withColumns({"_d0": first, "_d1": last})
    holidays = calendar.select(F.col(day).cast("date").alias("_day")).filter("_day is not null").distinct()
    extremes = rows.agg(F.min(F.least("_d0", "_d1")).alias("_lo"), F.max(F.greatest("_d0", "_d1")).alias("_hi")).unionByName(
        holidays.agg(F.min("_day").alias("_lo"), F.max("_day").alias("_hi")))
    axis = extremes.agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")).filter("_lo is not null").select(
        F.explode(F.sequence("_lo", "_hi")).alias("_axis"))
    order = Window.orderBy("_axis")
    counts = axis.join(holidays, F.col("_axis") == F.col("_day"), "left").select(
        "_axis", F.count("_day").over(order).alias("_n"))
    out = rows.join(counts.select(F.col("_axis").alias("_a0"), F.col("_n").alias("_n0")), F.col("_d0") == F.col("_a0"), "left")
    out = out.join(counts.select(F.col("_axis").alias("_a1"), F.col("_n").alias("_n1")), F.col("_d1") == F.col("_a1"), "left")
    hits = F.when(F.col("_d1") > F.col("_d0"), F.col("_n1") - F.col("_n0")).otherwise(F.lit(0))
    return out.withColumn(name, hits.cast("long")).drop("_d0", "_d1", "_a0", "_a1", "_n0", "_n1")


def match_rules(df: DataFrame, rules: DataFrame, on: Mapping[str, str], wildcard: Mapping[str, str],
                at_least: Mapping[str, str] | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Facts with every rule they satisfy, where a null on the rule side means "any".

    ``on`` holds plain equality keys, ``wildcard`` equality tests that a null rule
    value switches off, ``at_least`` fact >= rule tests with the same null rule; all map
    fact to rule columns. Each rule gets the bit pattern of its open tests and each
    fact row probes the patterns that occur among the rules of its ``on`` keys, which makes the
    whole match an equi-join that needs no broadcast nested loop.
    """
    tests = list(wildcard.items())
    mask = F.lit(0)
    for i, (_, r) in enumerate(tests):
        mask = mask + F.when(F.col(r).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    side = rules.select(
        mask.alias("_rmask"), *[F.col(r).alias(f"_on_{r}") for r in on.values()],
        *[F.col(r).alias(f"_w_{r}") for _, r in tests], *[F.col(r).alias(f"_m_{r}") for r in (at_least or {}).values()],
        *[F.col(c) for c in columns])
    if on:
        used = side.groupBy(*[F.col(f"_on_{r}").alias(f"_p_{r}") for r in on.values()]).agg(F.collect_set("_rmask").alias("_masks"))
        lhs = df.join(used, all_of([F.col(f) == F.col(f"_p_{r}") for f, r in on.items()])).drop(*[f"_p_{r}" for r in on.values()])
    else:
        lhs = df.withColumn("_masks", F.array(*[F.lit(i) for i in range(1 << len(tests))]))
    lhs = lhs.withColumn("_mask", F.explode("_masks")).drop("_masks")
    conds: list[Column] = [F.col("_mask") == F.col("_rmask")]
    conds += [F.col(f) == F.col(f"_on_{r}") for f, r in on.items()]
    for i, (f, r) in enumerate(tests):
        value = F.when(F.col("_mask").bitwiseAND(1 << i) == 0, F.col(f).cast("string"))
        any_ = F.when(F.col("_mask").bitwiseAND(1 << i) != 0, F.lit("any"))
        conds.append(F.struct(value, any_) == F.struct(
            F.col(f"_w_{r}").cast("string"), F.when(F.col(f"_w_{r}").isNull(), F.lit("any"))))
    for f, r in (at_least or {}).items():
        conds.append(F.col(f"_m_{r}").isNull() | (F.col(f) >= F.col(f"_m_{r}")))
    return lhs.join(side, all_of(conds), "inner").drop(
        "_mask", "_rmask", *[f"_on_{r}" for r in on.values()], *[f"_w_{r}" for _, r in tests],
        *[f"_m_{r}" for r in (at_least or {}).values()])
