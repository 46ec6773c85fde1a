"""Aggregations. All are partial-final hash or distinct aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import dates


def sum_when(col: Column, cond: Column, empty=0) -> Column:
    return F.sum(F.when(cond, col).otherwise(F.lit(empty)))


def count_distinct_when(col: Column, cond: Column) -> Column:
    return F.count_distinct(F.when(cond, col))


def ever(cond: Column) -> Column:
    """1 if the condition held at least once in the group."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def currently_active(df: DataFrame, keys: Sequence[str], signed: str) -> DataFrame:
    """Keys whose +1/-1 actions sum to more than zero."""
    return df.groupBy(*keys).agg(F.sum(signed).alias("balance")).filter("balance > 0")


def agg_concat(df: DataFrame, keys: Sequence[str], col: str, name: str, sep: str = ",") -> DataFrame:
    """Distinct values of a group in one sorted text.

    Duplicates are removed before the values meet, so a group costs its distinct values
    only; that text is the result itself.
    """
    return df.select(*keys, col).distinct().groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(F.col(col).cast("string"))), sep).alias(name))


def rollup_levels(df: DataFrame, levels: Sequence[Sequence[str]], sums: Mapping[str, str]) -> DataFrame:
    """Totals at several levels in one pass (GROUPING SETS); absent columns are null.

    The finest level is aggregated first, so the sets expand group rows, not facts.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    base = df.groupBy(*columns).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    out = base.groupingSets([[F.col(c) for c in level] for level in levels], *[F.col(c) for c in columns]).agg(
        *[F.sum(n).alias(n) for n in sums], F.grouping_id().alias("_gid"))
    label = None
    for level in levels:
        gid = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in level)
        value = F.lit("+".join(level) or "all")
        label = F.when(F.col("_gid") == gid, value) if label is None else label.when(F.col("_gid") == gid, value)
    return out.withColumn("level", label).drop("_gid")


def metric_row(metrics: Mapping[str, tuple[DataFrame, Column]], stamp: Mapping[str, object]) -> DataFrame:
    """Several global aggregates of different frames as one stamped row.

    Each frame contributes one tagged row; the rows are folded by one aggregation, with
    neither a driver-side collect nor a join.
    """
    parts = [f.agg(a.cast("long").alias("_v")).withColumn("_name", F.lit(n)) for n, (f, a) in metrics.items()]
    rows = reduce(DataFrame.unionByName, parts)
    out = rows.agg(*[F.max(F.when(F.col("_name") == n, F.col("_v"))).alias(n) for n in metrics])
    return out.withColumns({k: F.lit(v) for k, v in stamp.items()})


def feature_long(df: DataFrame, member: str, ts: str, specs: Mapping[str, Column], periods: Mapping[str, date | str],
                 as_of: date | str, place: str | None = None, total: str = "Total", type_: str = "decimal(38,1)") -> DataFrame:
    """Long member features: ``<spec>_<place or total>_<period>`` with a value.

    One scan and one aggregation hold every period as a conditional sum; a second,
    smaller aggregation gives the totals over all places. A feature is emitted
    only for groups with rows in the period.
    """
    end = dates.as_date(as_of)
    day = F.col(ts).cast("date")
    places = [place] if place else []
    aggs: list[Column] = []
    for period, start in periods.items():
        inside = day.between(F.lit(dates.as_date(start)), F.lit(end))
        aggs.append(F.sum(F.when(inside, F.lit(1)).otherwise(F.lit(0))).alias(f"_n_{period}"))
        aggs += [F.sum(F.when(inside, col)).alias(f"{spec}|{period}") for spec, col in specs.items()]
    first = min(dates.as_date(s) for s in periods.values())
    base = df.filter((F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(dates.days_before(end, -1))))
    by_place = base.groupBy(member, *places).agg(*aggs)
    value_names = [f"{spec}|{period}" for period in periods for spec in specs]
    totals = by_place.groupBy(member).agg(
        *[F.sum(f"_n_{p}").alias(f"_n_{p}") for p in periods], *[F.sum(F.col(f"`{v}`")).alias(v) for v in value_names])
    wide = totals.withColumn("_place", F.lit(total))
    if place:
        wide = by_place.withColumn("_place", F.col(place).cast("string")).drop(place).unionByName(wide)
    entries = F.array(*[
        F.struct(F.lit(spec).alias("spec"), F.lit(period).alias("period"), F.col(f"_n_{period}").alias("n"),
                 F.col(f"`{spec}|{period}`").cast(type_).alias("value"))
        for period in periods for spec in specs])
    rows = wide.select(member, "_place", F.explode(entries).alias("e")).filter("e.n > 0")
    return rows.select(member, F.concat_ws("_", "e.spec", "_place", "e.period").alias("feature"), F.col("e.value").alias("value"))


def concentrated_buyers(df: DataFrame, member: str, category: str, ts: str, amount: str, *, period_end: date | str,
                        amount_per_month: float, visits_per_month: Mapping[str, int] | int = 1, amount_share: float = 0.8,
                        visit_share: float = 0.7, floor_months: int = 6, excluded: Sequence[str] = ()) -> DataFrame:
    """Members who spend almost everything in one category, every month.

    The category totals are aggregated once and folded to member totals.
    """
    by_cat = df.groupBy(member, category).agg(
        F.sum(amount).alias("cat_amount"), F.count(F.lit(1)).alias("cat_visits"), F.min(F.col(ts).cast("date")).alias("first_day"))
    totals = by_cat.groupBy(F.col(member).alias("_m")).agg(
        F.sum("cat_amount").alias("total_amount"), F.sum("cat_visits").alias("total_visits"), F.min("first_day").alias("_first"))
    months = dates.active_months(F.col("_first"), F.lit(dates.as_date(period_end)), floor_months)
    if isinstance(visits_per_month, Mapping):
        from martkit.functions.codes import decode

        per_month = decode(F.col(category), {k: v for k, v in visits_per_month.items() if k != "*"},
                           visits_per_month.get("*", 1))
    else:
        per_month = F.lit(visits_per_month)
    tests = ((F.col("cat_amount") >= amount_share * F.col("total_amount"))
             & (F.col("cat_visits") >= F.col("required_months") * per_month)
             & (F.col("cat_visits") >= visit_share * F.col("total_visits"))
             & (F.col("total_amount") >= F.col("required_months") * F.lit(amount_per_month)))
    out = by_cat.filter(~F.col(category).isin(list(excluded))) if excluded else by_cat
    return (out.join(totals, F.col(member) == F.col("_m")).withColumn("required_months", months).filter(tests)
            .select(member, category, "cat_amount", "cat_visits", "total_amount", "total_visits", "required_months"))


def classify_mix(df: DataFrame, keys: Sequence[str], a: str, b: str, labels: Mapping[str, str]) -> DataFrame:
    """How a group uses two measures, from their minima and sums.

    ``both_zero`` when each is zero somewhere, else ``hybrid`` when both occur, else
    ``b_only`` or ``a_only``.
    """
    stats = df.groupBy(*keys).agg(
        F.min(a).alias("min_a"), F.sum(a).alias("sum_a"), F.min(b).alias("min_b"), F.sum(b).alias("sum_b"))
    kind = (F.when((F.col("min_a") == 0) & (F.col("min_b") == 0), F.lit(labels["both_zero"]))
            .when((F.col("sum_a") > 0) & (F.col("sum_b") > 0), F.lit(labels["hybrid"]))
            .when(F.col("sum_a") == 0, F.lit(labels["b_only"]))
            .when(F.col("sum_b") == 0, F.lit(labels["a_only"])))
    return stats.withColumn("mix", kind).drop("min_a", "sum_a", "min_b", "sum_b")


def stock_position(items: DataFrame, movements: DataFrame, key: str, item_id: str, status: str, when_col: str,
                   original: str, *, void: Sequence[str], used: Sequence[str], as_of: date | str) -> DataFrame:
    """Original minus redeemed stock, used units, and units redeemed after the last month end."""
    month_start = dates.first_of_month(as_of)
    moved = movements.filter(~F.col(status).isin(list(void))).groupBy(F.col(key).alias("_k")).agg(
        F.count_distinct(item_id).alias("redeemed_qty"),
        F.count_distinct(F.when(F.col(status).isin(list(used)), F.col(item_id))).alias("used_qty"),
        F.count(F.when(F.col(when_col) >= F.lit(month_start), F.col(item_id))).alias("mtd_redeemed_qty"))
    out = items.join(moved, F.col(key) == F.col("_k"), "left").drop("_k")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("redeemed_qty", "used_qty", "mtd_redeemed_qty")})
    return out.withColumn("available_qty", F.coalesce(F.col(original), F.lit(0)) - F.col("redeemed_qty"))
