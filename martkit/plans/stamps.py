"""Stamp programme: staging of its text formats and the facts on top."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates, text
from martkit.operators import aggregates, joins, lists

TAG, LIST, MEMBER = "|@|", ":", ("gender", "age", "age_group", "residence", "district")


def _day(col: str):
    """An int such as 20240131 as a date; anything else gives null."""
    return F.try_to_timestamp(F.col(col).cast("string"), F.lit("yyyyMMdd")).cast("date")


def programmes(card: DataFrame) -> DataFrame:
    """Programmes with their dates and the spend that earns one stamp."""
    return card.select(
        F.col("id").alias("stamp_program_id"), "title_en", "banner_desc_en", F.col("max_no_of_stamp").alias("max_stamp_per_day"), F.col("max_no_of_receipt").alias("max_receipt_per_day"),
        F.col("max_earn_stamp").alias("max_stamp_per_program"), "createtime", "status", "stamp_desc_en",
        *[_day(c).alias(c) for c in ("datefrom_collect", "dateto_collect", "datefrom_gift", "dateto_gift")],
        text.stamp_rule_value(F.col("earn_stamp_rule1_str"), "1").alias("min_spend_for_a_stamp"))


def gift_list(card: DataFrame) -> DataFrame:
    """One row per gift tier: a gift code or points, the stamps it takes and whether it needs approval."""
    rows = lists.zip_lists(card.select(F.col("id").alias("stamp_program_id"), "gift_tier_str", "gift_stamp_required_str", "gift_requires_approval_str"), ["stamp_program_id"],
                           ["gift_tier_str", "gift_stamp_required_str", "gift_requires_approval_str"], LIST)
    item = text.token(F.col("gift_tier_str"), TAG, 1)
    return rows.filter("gift_tier_str is not null").select(
        "stamp_program_id", F.coalesce(text.route_first_char(item, True), F.lit("")).alias("physical_gift"), F.coalesce(text.route_first_char(item, False), F.lit("")).alias("points"),
        F.col("gift_stamp_required_str").alias("stamp_required"), F.col("gift_requires_approval_str").alias("approval_required"))


def earned(record: DataFrame) -> DataFrame:
    return record.select(F.col("id").alias("stamp_transaction_id"), F.col("vid").alias("member_id"), F.col("cardid").alias("stamp_program_id"), "no_of_receipt", "earn_stamp", "lastupdate",
                         codes.flag(F.col("no_of_receipt") == 0).alias("is_point_conversion"))


def receipts(record: DataFrame) -> DataFrame:
    """One row per receipt of a stamp transaction; the filler 0 is left out."""
    rows = lists.explode_list(record, "receipt_id", "::", "receipt", drop_values=("0", ""))
    return rows.select(F.col("id").alias("stamp_transaction_id"), F.col("vid").alias("member_id"), F.col("cardid").alias("stamp_program_id"), "lastupdate", F.col("receipt").try_cast("bigint").alias("receipt_id"))


def redemptions(record: DataFrame) -> DataFrame:
    item = text.token(F.col("gift_tier_str"), TAG, 1)
    return record.select(
        F.col("vid").alias("member_id"), F.col("cardid").alias("stamp_program_id"), F.coalesce(text.route_first_char(item, True), F.lit("")).alias("physical_gift"),
        F.coalesce(text.route_first_char(item, False), F.lit("")).alias("points"), codes.flag(~F.rlike(item, F.lit("^[A-Za-z]"))).alias("point_or_gift"), "gift_stamp_required", "pickup_mall_id",
        "redeem_status", _day("redeem_date").alias("redeem_date"), "recordtime")


def shops(shoplist: DataFrame) -> DataFrame:
    pattern = "^([0-9]+)-([0-9]+)"
    return shoplist.select(F.col("cardid").alias("stamp_program_id"), text.split_code(F.col("shopid"), pattern, 1).alias("mall_id"), text.split_code(F.col("shopid"), pattern, 2, "bigint").alias("shop_id"), "shopname_en")


def stamp_gift_inventory(gifts: DataFrame, programme: DataFrame, inventory: DataFrame) -> DataFrame:
    """Gift tiers with inventory; the programme's own dates and texts fill what inventory lacks."""
    df = joins.enrich(gifts, [
        (programme, {"stamp_program_id": "stamp_program_id"}, {c: c for c in ("title_en", "stamp_desc_en", "createtime", "banner_desc_en", "datefrom_gift", "dateto_gift")}),
        (inventory, {"gift_id": "physical_gift"}, {c: c for c in ("team", "gift_status", "created_datetime", "name_en", "redemption_date_start", "redemption_date_end", "original_stock_level")})])
    return df.select(
        "stamp_program_id", "title_en", "stamp_desc_en", codes.flag(F.col("physical_gift") == "").alias("point_or_gift"), "points", "physical_gift", "stamp_required", "approval_required", "team", "gift_status",
        F.coalesce("created_datetime", "createtime").alias("create_datetime"), F.coalesce("name_en", "banner_desc_en").alias("name_en"),
        F.coalesce("redemption_date_start", "datefrom_gift").alias("redemption_date_start"), F.coalesce("redemption_date_end", "dateto_gift").alias("redemption_date_end"), "original_stock_level")


def stamp_shops(shoplist: DataFrame, shop: DataFrame) -> DataFrame:
    df = joins.enrich(shoplist.filter("stamp_program_id <> 0"), [(shop, {"mall_id": "mall_id", "mapping_shop_id": "shop_id"}, {
        c: c for c in ("shop_name", "property_id", "lms_trade_name", "lms_standard_brand_name", "lms_standard_trade_category")})])
    return df.drop("mall_id", "shopname_en").distinct()


def stamp_redemptions(rows: DataFrame, mall: DataFrame, programme: DataFrame, member: DataFrame) -> DataFrame:
    df = joins.enrich(rows, [(mall, {"mall_id": "pickup_mall_id"}, {"team": "team", "property_id": "property_id"}), (programme, {"stamp_program_id": "stamp_program_id"}, {"datefrom_gift": "_from"}),
                             (member, {"member_id": "member_id"}, {c: c for c in MEMBER})])
    return df.withColumn("day_since_collection_start", dates.day_number(F.col("_from"), F.col("redeem_date"))).drop("_from", "pickup_mall_id")


def member_spend(receipt: DataFrame, spending: DataFrame, programme: DataFrame, earn: DataFrame) -> DataFrame:
    return joins.enrich(receipt.drop("lastupdate"), [
        (spending, {"receipt_id": "receipt_id"}, {c: c for c in ("receipt_transaction_date", "team", "property_id", "shop_name", "receipt_amount", "lms_standard_brand_name", "lms_standard_trade_category")}),
        (programme, {"stamp_program_id": "stamp_program_id"}, {"title_en": "title_en"}), (earn, {"stamp_transaction_id": "stamp_transaction_id"}, {"earn_stamp": "earn_stamp"})])


def stamp_earn(earn: DataFrame, spend: DataFrame, programme: DataFrame, member: DataFrame) -> DataFrame:
    """Stamps earned with the receipts behind them; only spending since the programme began counts."""
    keys = ["member_id", "stamp_transaction_id", "stamp_program_id"]
    behind = spend.groupBy(*keys).agg(F.count_distinct("receipt_id").alias("no_receipt"), F.min("receipt_transaction_date").alias("receipt_date_min"),
                                      F.max("receipt_transaction_date").alias("receipt_date_max"), F.sum("receipt_amount").alias("total_receipt_amount"))
    places = aggregates.agg_concat(spend.filter("property_id is not null"), keys, "property_id", "property_group", "|")
    total = earn.groupBy(*keys, F.to_date("lastupdate").alias("stamp_last_updated_date")).agg(F.sum("earn_stamp").alias("stamps_earn")).filter("stamps_earn > 0")
    df = joins.enrich(total.join(behind, keys), [
        (places, {k: k for k in keys}, {"property_group": "property_group"}), (programme, {"stamp_program_id": "stamp_program_id"}, {"title_en": "title_en", "datefrom_collect": "_from"}),
        (member, {"member_id": "member_id"}, {c: c for c in MEMBER})])
    return df.filter(F.col("receipt_date_max") >= F.col("_from")).withColumn("day_since_program_start", dates.day_number(F.col("_from"), F.col("receipt_date_max"))).drop("_from")
