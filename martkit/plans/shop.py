"""Shop dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, text
from martkit.operators import joins, latest

# Shop codes and labels.
STATUS = {"A": "Active", "I": "Inactive", "V": "Invalid"}
VISIBLE = {"V": "Visible", "I": "Invisible"}
UNKNOWN = "UNDEFINABLE"
LEASE = {"agreement_no": "lms_agreement_no", "main_unit_no": "lms_unit_no", "trade_name": "lms_trade_name", "standard_brand_name": "lms_standard_brand_name",
         "standard_trade_category": "lms_standard_trade_category", "standard_group": "lms_standard_group", "charge_area": "lms_charge_area"}


def shop_dimension(shop: DataFrame, mall: DataFrame, mall_map: DataFrame, mapping: DataFrame, lease: DataFrame) -> DataFrame:
    """Shops of known malls with their latest lease."""
    newest = latest.latest_by_max(mapping, ["shop_id"], "updated_month")
    df = shop.join(mall.select("mall_id", F.col("status").alias("mall_status"), text.strip_line_breaks(F.col("name_lang1")).alias("mall_name")), "mall_id")
    df = df.join(mall_map.select("mall_id", "team", "property_id"), "mall_id")
    df = joins.enrich(df, [(newest, {"shop_id": "shop_id"}, {"lms_agreement_no": "_agreement"}), (lease, {"agreement_no": "_agreement"}, LEASE)])
    return df.select(
        "shop_id", F.col("status").alias("shop_status"), codes.decode(F.col("status"), STATUS).alias("shop_status_detail"), F.col("visible").alias("shop_visible"),
        codes.decode(F.col("visible"), VISIBLE).alias("shop_visible_detail"), text.strip_line_breaks(F.col("name_lang1")).alias("shop_name"), "floor",
        text.strip_trailing(F.col("shop_no")).alias("unit_no"), "team", "mall_id", "mall_status", codes.decode(F.col("mall_status"), STATUS).alias("mall_status_detail"), "property_id", "mall_name",
        *[c for c in LEASE.values() if c != "lms_standard_trade_category"],
        text.clean_sentinels(F.col("lms_standard_trade_category"), ("", "To Be Confirmed"), UNKNOWN).alias("lms_standard_trade_category"))


def slim(dimension: DataFrame) -> DataFrame:
    """The columns facts take from the shop dimension."""
    return dimension.select(F.col("shop_id").alias("mapping_shop_id"), "shop_name", "property_id", "mall_id", "team", *[c for c in LEASE.values() if c != "lms_unit_no"])


def display_categories(cms_shop: DataFrame, category: DataFrame, rfm: DataFrame) -> DataFrame:
    """Active shops with their display category and the category analyses use."""
    df = joins.enrich(cms_shop.filter("status = 1"), [(category, {"id": "display_main_cat"}, {"category_name": "app_display_cat_name"}),])
    df = joins.enrich(df, [(rfm, {"cms_trade_cat": "app_display_cat_name"}, {"rfm_trade_cat": "rfm_trade_cat"})])
    return df.select(F.col("id").alias("cms_shop_id"), F.col("shop_name").alias("cms_shop_name"), "mall_id", F.col("display_main_cat").alias("app_display_cat_id"), "app_display_cat_name", "rfm_trade_cat")
