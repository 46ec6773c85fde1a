"""Gift and coupon inventory."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates, text
from martkit.operators import joins, sets
from martkit.plans.redemption import gift_item_type

# Item codes and labels.
ITEM_STATUS = {"A": "Active", "I": "Inactive", "V": "Invalid"}
STOCK_KIND = {0: "Limited Inventory", 1: "Unlimited Inventory"}
VOID = ("C", "L")


def movements(redemption: DataFrame, item: str, transaction: str, used: Sequence[str], as_of: date | str) -> DataFrame:
    """Redeemed, used and month-to-date quantities per item and mall."""
    month = dates.first_of_month(as_of)
    return redemption.filter(~F.col("status").isin(list(VOID))).groupBy(F.col(item).alias("item_id"), "mall_id").agg(
        F.count_distinct(transaction).alias("redeemed_qty"),
        F.count_distinct(F.when(F.col("status").isin(list(used)), F.col(transaction))).alias("used_qty"),
        F.count(F.when(F.col("redeem_datetime") >= F.lit(month), F.col(transaction))).alias("mtd_redeemed_qty"))


def positions(content: DataFrame, categories: DataFrame, conditions: DataFrame, stock: DataFrame, mall: DataFrame, moved: DataFrame) -> DataFrame:
    """Content with category, redemption window, stock per mall and what was redeemed there.

    ``content`` columns: item_id, mall_id, category_id, item_type, status, created_date, name, unit_cost,
    redeem_type, required_points, required_spending, unlimited_inventory, expiry_date, expiry_day.
    """
    df = content.join(mall.select("mall_id", "team", "property_id"), "mall_id")
    df = joins.enrich(df, [
        (categories, {"category_id": "category_id"}, {"gift_type": "gift_type", "sub_gift_type": "sub_gift_type"}),
        (conditions, {"parent_id": "item_id"}, {"start_date": "_start", "end_date": "_end", "frequency_type": "redemption_limit_type", "value": "redemption_limit_qty",
                                                "min_matched_receipt_total_amount": "_min_spend"}),
        (stock, {"parent_id": "item_id"}, {"mall_id": "_stock_mall", "original_stock_level": "_orig", "stock_level": "_level"}),
        (mall, {"mall_id": "_stock_mall"}, {"property_id": "stock_at_property_id"}),
        (moved, {"item_id": "item_id", "mall_id": "_stock_mall"}, {"redeemed_qty": "_red", "used_qty": "_used", "mtd_redeemed_qty": "_mtd"})])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    day = lambda c: dates.clamp_year(F.col(c).try_cast("date"), 2019)
    return df.select(
        F.col("item_id").alias("gift_id"), "team", "property_id", "item_type", F.col("status").alias("gift_status"), codes.decode(F.col("status"), ITEM_STATUS).alias("gift_status_detail"),
        F.col("created_date").alias("created_datetime"), dates.month_key(F.col("created_date")).alias("created_datetime_yearmonth"), F.col("name").alias("name_en"),
        "gift_type", "sub_gift_type", F.col("unit_cost").alias("gift_unit_cost"), day("_start").alias("redemption_date_start"), day("_end").alias("redemption_date_end"),
        "redeem_type", F.col("required_points").alias("required_redeem_bonus_point"), F.coalesce("required_spending", "_min_spend").alias("required_redeem_spending"),
        "redemption_limit_type", "redemption_limit_qty", day("expiry_date").alias("reserve_expiry_date"), F.col("expiry_day").alias("reserve_expiry_day"),
        codes.decode(F.col("unlimited_inventory"), STOCK_KIND).alias("inventory_type"), "stock_at_property_id", zero("_orig").alias("original_stock_level"),
        zero("_level").alias("physical_stock_level"), zero("_red").alias("redeemed_stock_level"), zero("_used").alias("collected_or_used_stock_level"),
        (zero("_orig") - zero("_red")).alias("stock_level_available_for_redemption"), zero("_mtd").alias("mtd_redeemed_stock_level"))


def gift_content_items(content: DataFrame) -> DataFrame:
    """Gift content in the shape of ``positions``."""
    kind = codes.first_match([
        (F.col("type") == "S", "Redeem by receipt"), ((F.col("type") == "B") & (F.col("bonus_point_1") == 0), "Redeem by 0 point"),
        (F.col("type") == "B", "Redeem by bonus point"), (F.col("type") == "N", "point + cash type")])
    return content.select(
        F.col("gift_id").alias("item_id"), "mall_id", F.col("gift_category_id").alias("category_id"), gift_item_type(F.col("extra_function")).alias("item_type"), "status",
        "created_date", F.col("name_lang1").alias("name"), F.col("value_amount").alias("unit_cost"), kind.alias("redeem_type"),
        F.col("bonus_point_1").cast("double").alias("required_points"), F.when(F.col("extra_function") == "C", F.col("car_park_min_spending_amount")).alias("required_spending"),
        "unlimited_inventory", F.col("reserve_expiry_date").alias("expiry_date"), F.col("reserve_expiry_day").alias("expiry_day"))


def coupon_content_items(content: DataFrame, redeem: DataFrame, *, certificate: str) -> DataFrame:
    """Coupon content in the shape of ``positions``. Zero points means redeemed by 0 point here too."""
    df = joins.enrich(content, [(redeem, {"coupon_id": "coupon_id"}, {"bonus_point": "_bp"})])
    points = text.currency_number(F.col("_bp"))
    kind = codes.first_match([(F.col("type") == "S", "Redeem by receipt"), ((F.col("type") == "B") & (points == 0), "Redeem by 0 point"),
                              (F.col("type") == "B", "Redeem by bonus point"), (F.col("type") == "N", "point + cash type")])
    return df.select(
        F.col("coupon_id").alias("item_id"), "mall_id", F.col("coupon_category_id").alias("category_id"),
        F.when(F.col("name_lang1").contains(certificate), certificate).otherwise("Shop Gift").alias("item_type"), "status", "created_date", F.col("name_lang1").alias("name"),
        F.col("value_amount").alias("unit_cost"), kind.alias("redeem_type"), points.alias("required_points"), F.lit(None).cast("int").alias("required_spending"),
        "unlimited_inventory", F.col("usage_expiry_date").alias("expiry_date"), F.col("usage_expiry_day").alias("expiry_day"))


def gift_inventory(parts: Sequence[DataFrame], new_categories: DataFrame, api_flags: DataFrame, tiers: DataFrame, brands: DataFrame, conditions: DataFrame,
                   selected_kind: int = 132) -> DataFrame:
    """Gifts and coupons with re-mapped categories, API flag, brand and a selected-member flag."""
    brand = joins.enrich(tiers.select("gift_id", "reward_brand_id", "redeem_method_combination").distinct(),
                         [(brands, {"brand_id": "reward_brand_id"}, {"brand_name": "reward_brand_name"})])
    df = joins.enrich(sets.union_all(*parts), [
        (api_flags.select("gift_id", "show_in_api").distinct(), {"gift_id": "gift_id"}, {"show_in_api": "show_in_api"}),
        (brand, {"gift_id": "gift_id"}, {c: c for c in ("reward_brand_id", "reward_brand_name", "redeem_method_combination")}),
        (new_categories, {"gift_id": "gift_id"}, {"new_gift_type": "_t", "new_sub_gift_type": "_s"})])
    df = joins.flag_exists(df, conditions.filter(F.col("condition_type") == selected_kind), {"parent_id": "gift_id"}, "selected_member")
    clean = lambda new, old: F.trim(text.clean_sentinels(F.coalesce(F.col(new), F.col(old)), ("null", "")))
    return df.withColumns({"gift_type": clean("_t", "gift_type"), "sub_gift_type": clean("_s", "sub_gift_type")}).drop("_t", "_s").distinct()
