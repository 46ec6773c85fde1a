"""Tenant sales against member spending, and the upkeep of the sales and lease tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates, text
from martkit.operators import aggregates, filters, joins, quality, sets

UNKNOWN = "UNDEFINABLE"
KEYS = ["month", "property_id", "brand"]


def tenant_sales(sales: DataFrame, lease: DataFrame, mall: DataFrame, *, mall_codes: Mapping[str, str], excluded_leases: Sequence[str] = (), excluded_months: Sequence[int] = ()) -> DataFrame:
    """Monthly sales per team, place, category and brand; leases without a usable label are ``UNDEFINABLE``."""
    df = sales
    if excluded_leases:
        df = df.filter(~F.col("agreement_no").isin(list(excluded_leases)))
    if excluded_months:
        df = df.filter(~F.col("month").isin(list(excluded_months)))
    df = joins.enrich(df.withColumn("_code", codes.decode(F.col("mall"), mall_codes)), [
        (lease, {"agreement_no": "agreement_no"}, {"standard_trade_category": "_cat", "standard_brand_name": "_brand"}),
        (mall, {"property_id": "_code"}, {"team": "team", "property_id": "property_id"})])
    clean = lambda c: text.clean_sentinels(F.col(c), default=UNKNOWN)
    return df.groupBy("team", F.col("month").cast("string").alias("month"), "property_id", clean("_cat").alias("category"), clean("_brand").alias("brand")).agg(F.sum("lms_sales").alias("lms_sales"))


def countable_spending(spending: DataFrame, pre_shoot: DataFrame, abnormal_shops: DataFrame) -> DataFrame:
    """Spending without pre-shoot receipts and without abnormal shops, unless it came by API."""
    df = joins.anti(spending.filter("receipt_amount <> 0"), pre_shoot, {"receipt_id": "receipt_id"})
    return filters.exclude_unless(df, abnormal_shops, ["shop_id"], F.col("platform") == "api")


def brand_spending(spending: DataFrame) -> DataFrame:
    clean = lambda c: text.clean_sentinels(F.col(c), ("#N/A", "", "To Be Confirmed"), UNKNOWN, null_too=False)
    return spending.groupBy(
        F.col("team").alias("spending_team"), dates.month_key(F.col("receipt_transaction_date")).alias("month"), "property_id",
        clean("lms_standard_trade_category").alias("spending_category"), clean("lms_standard_brand_name").alias("brand")).agg(F.sum("receipt_amount").alias("member_spend"))


def reconciled(sales: DataFrame, spending: DataFrame) -> DataFrame:
    """Sales with their spending, and spending without sales in the months the sales know."""
    return joins.reconcile(sales, spending, KEYS, "month", ["team", "category", "lms_sales"], ["spending_team", "spending_category", "member_spend"])


def unmatched_brands(both: DataFrame) -> DataFrame:
    """The report of brands only one side knows."""
    df = both.filter("matched <> 'both'")
    return df.select(F.coalesce("team", "spending_team").alias("team"), "month", F.coalesce("category", "spending_category").alias("category"), "brand",
                     F.coalesce("member_spend", F.lit(0)).alias("member_spend"), F.coalesce("lms_sales", F.lit(0)).alias("lms_sales"), "property_id")


def contribution(both: DataFrame, joined: DataFrame) -> DataFrame:
    """Member spend and sales by brand, by category and by mall (column ``level``).

    A brand only one side knows counts as ``UNDEFINABLE``. Months up to a mall's joining
    month are left out.
    """
    rows = both.select(
        F.coalesce("team", "spending_team").alias("team"), F.col("month").cast("int").alias("month"), "property_id", F.coalesce("spending_category", "category").alias("category"),
        F.when(F.col("matched") == "both", F.col("brand")).otherwise(UNKNOWN).alias("brand"), F.coalesce("member_spend", F.lit(0)).alias("member_spend"), F.coalesce("lms_sales", F.lit(0)).alias("lms_sales"))
    rows = joins.gate_by_start(rows, joined, "property_id", "joined_month", "property_id", "month")
    base = ["team", "month", "property_id"]
    names = {"+".join(base + ["category", "brand"]): "brand", "+".join(base + ["category"]): "category", "+".join(base): "mall"}
    out = aggregates.rollup_levels(rows, [base + ["category", "brand"], base + ["category"], base], {"member_spend": "member_spend", "lms_sales": "lms_sales"})
    return out.withColumns({"level": codes.decode(F.col("level"), names), "sales_date": F.to_date(F.concat(F.col("month").cast("string"), F.lit("01")), "yyyyMMdd")})


def refreshed_sales(history: DataFrame, fresh: DataFrame, *, months: int = 2, relabel: Mapping[str, str] | None = None) -> DataFrame:
    """The sales table with its latest months replaced by a new delivery; leases may be moved to another mall."""
    due = sets.latest_periods(history, "month", months)
    out = joins.anti(history, due, {"month": "month"}).unionByName(joins.semi(fresh, due, {"month": "month"}))
    return out.withColumn("mall", codes.override(codes.decode(F.col("agreement_no"), relabel), F.col("mall"))) if relabel else out


def sales_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Totals per month before and after a refresh."""
    a = quality.period_totals(before, "month", "lms_sales").withColumnsRenamed({"n_rows": "rows_before", "total": "total_before"})
    b = quality.period_totals(after, "month", "lms_sales").withColumnsRenamed({"n_rows": "rows_after", "total": "total_after"})
    return a.join(b, "month", "full_outer")


LEASE_COLUMNS = {"trade_name": "lms_trade_name", "main_unit_no": "main_unit_no", "property_id": "lms_property_id", "standard_brand_name": "standard_brand_name",
                 "standard_group": "standard_group", "standard_trade_category": "standard_trade_category", "updated_month": "updated_month"}


def lease_mapping(shop: DataFrame, previous: DataFrame, lease: DataFrame, mall: DataFrame, *, month: str, escape: str = "^", quote: str = "'") -> DataFrame:
    """Shops with the lease of the previous mapping; escaped quotes restored and missing months stamped."""
    df = joins.enrich(shop, [(mall, {"mall_id": "mall_id"}, {"property_id": "property_id"}), (previous, {"shop_id": "shop_id"}, {"lms_agreement_no": "lms_agreement_no"})])
    df = joins.enrich(df, [(lease, {"agreement_no": "lms_agreement_no"}, LEASE_COLUMNS)])
    restored = {c: F.replace(c, F.lit(escape), F.lit(quote)) for c in ("lms_trade_name", "standard_brand_name", "standard_group", "standard_trade_category")}
    return df.select("shop_id", F.col("status").alias("shop_status"), codes.decode(F.col("status"), {"A": "Active", "I": "Inactive", "V": "Invalid"}).alias("shop_status_detail"), "property_id",
                     text.strip_trailing(F.col("shop_no")).alias("unit_no"), F.trim("name_lang1").alias("shop_name"), "lms_agreement_no", *LEASE_COLUMNS.values()).withColumns(
        {**restored, "updated_month": F.coalesce("updated_month", F.lit(month))})


def active_without_lease(mapping: DataFrame) -> DataFrame:
    return mapping.filter("lms_agreement_no is null and shop_status = 'A'")


def name_differences(mapping: DataFrame) -> DataFrame:
    return mapping.filter("shop_status = 'A' and shop_name <> standard_brand_name")
