"""Concentrated ("professional") buyers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates
from martkit.operators import aggregates, filters, latest, sets


@dataclass(frozen=True)
class Criterion:
    amount_per_month: float
    visits_per_month: Mapping[str, int] | int = 1


@dataclass(frozen=True)
class SegmentRules:
    criteria: Sequence[Criterion]
    merged: Mapping[str, str] = field(default_factory=dict)  # category -> category it counts as
    excluded: Sequence[str] = ()
    amount_share: float = 0.8
    visit_share: float = 0.7
    floor_months: int = 6
    months: int = 12


def _merged(df: DataFrame, category: str, rules: SegmentRules) -> DataFrame:
    return df.withColumn(category, codes.decode(F.col(category), rules.merged, keep_unknown=True)) if rules.merged else df


def monthly_buyers(spending: DataFrame, rules: SegmentRules, *, as_of: date | str, member: str = "member_id", category: str = "lms_standard_trade_category",
                   ts: str = "receipt_transaction_date", amount: str = "receipt_amount") -> DataFrame:
    """(member, period) of the members who meet any criterion in the last complete months."""
    end = dates.first_of_month(as_of) - timedelta(days=1)
    base = _merged(filters.complete_months(spending, ts, rules.months, as_of), category, rules)
    found = [aggregates.concentrated_buyers(
        base, member, category, ts, amount, period_end=end, amount_per_month=c.amount_per_month, visits_per_month=c.visits_per_month, amount_share=rules.amount_share,
        visit_share=rules.visit_share, floor_months=rules.floor_months, excluded=rules.excluded).select(member) for c in rules.criteria]
    return sets.union_distinct(*found).withColumn("period", F.lit(end))


def buyer_list(previous: DataFrame, current: DataFrame) -> DataFrame:
    """The cumulative list."""
    return sets.union_distinct(previous.withColumn("period", F.col("period").cast("date")), current)


def buyer_types(buyers: DataFrame, spending: DataFrame, rules: SegmentRules, *, days: int = 365, member: str = "member_id", category: str = "lms_standard_trade_category",
                ts: str = "receipt_transaction_date", amount: str = "receipt_amount") -> DataFrame:
    """First period and the category with the most spend in the year before it."""
    first = buyers.groupBy(member).agg(F.min("period").alias("period"))
    rows = spending.select(member, category, ts, amount).join(first, member).filter(F.col(ts).between(F.date_sub("period", days), F.col("period")))
    totals = _merged(rows, category, rules).groupBy(member, "period", category).agg(F.sum(amount).alias("_total"))
    top = latest.top_k(totals, [member], [F.col("_total").desc(), category])
    return top.select(member, "period", F.col(category).alias("buyer_type"))
