"""Gift and coupon content from its JSON columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from martkit.functions import codes, dates, jsontext, text
from martkit.operators import aggregates, joins, lists, sets

EPOCH_END_OF_DAY = datetime(1970, 1, 1, 23, 59, 59)
# Labels of point-or-cash combinations.
MIX = {"both_zero": "Points + Cash Only", "hybrid": "Hybrid", "a_only": "Cash Only", "b_only": "Points Only"}


def item_links(content: DataFrame, key: str, col: str, item: str) -> DataFrame:
    """(content, linked id) from a JSON object of lists."""
    return lists.explode_map_of_lists(content.filter(F.col(col).isNotNull()), key, col, "_group", item).drop("_group")


def coupon_points(coupon: DataFrame) -> DataFrame:
    """Numeric points and member level of a coupon: of each field the last tier that has it."""
    last = jsontext.last_of(F.col("redeem_bonus_points"), ["bonus_point", "member_level_id"])
    df = coupon.filter(F.col("redeem_bonus_points").isNotNull())
    return df.select("coupon_id", text.currency_number(last["bonus_point"], "int").alias("bonus_point"), last["member_level_id"].alias("member_level_id"))


# JSON columns of coupons that hold tiers.
COUPON_TIERS = ("redeem_bonus_points", "redeem_with_cash", "redeem_bonus_points_with_cash")


def coupon_content(coupon: DataFrame, *, tiers: Sequence[str] = COUPON_TIERS, fields: Sequence[str] | None = None, n: int | None = None) -> DataFrame:
    """Coupons with a numbered column for every field and tier; missing ones are empty text and the expiry is plausible.

    Without ``fields`` and ``n`` these are all that occur (one aggregation each). Where two JSON columns
    hold a field of one tier, the later column counts.
    """
    cols = [F.col(c) for c in tiers if c in coupon.columns]
    fields = lists.object_fields(coupon, *cols) if fields is None else fields
    n = lists.longest_array(coupon, *cols) if n is None else n
    df = coupon.withColumns({k: F.coalesce(v, F.lit("")) for k, v in jsontext.widest(cols, fields, n).items()})
    return df.withColumn("usage_expiry_date", dates.clamp_year(F.col("usage_expiry_date"), 1970, F.lit(EPOCH_END_OF_DAY).cast("timestamp_ntz"))).drop(*tiers)


def gift_content(gift: DataFrame, *, fields: Sequence[str] | None = None, n: int | None = None, extra: Sequence[str] = ("car_park_redeem_hours", "car_park_min_spending_amount")) -> DataFrame:
    """Gifts with a numbered column for every field and tier, and the parking values of their extra data.

    Extra data is one object: its other fields are numbered as a first tier. Without ``fields`` and ``n`` these are all that
    occur (one aggregation each).
    """
    ok = gift.filter(F.col("reserve_expiry_date").isNull() | (F.year("reserve_expiry_date") > 1900))
    cols = [F.col("redeem_bonus_points"), F.concat(F.lit("["), F.col("extra_data"), F.lit("]"))]
    fields = [f for f in (lists.object_fields(ok, *cols) if fields is None else fields) if f not in extra]
    n = lists.longest_array(ok, *cols) if n is None else n
    df = ok.withColumns({**jsontext.widest(cols, fields, n), **{e: F.get_json_object("extra_data", f"$.{e}") for e in extra}})
    points = {"bonus_point_1": text.currency_number(F.col("bonus_point_1"))} if "bonus_point_1" in df.columns else {}
    return df.withColumns(points).drop("redeem_bonus_points", "extra_data")


def redeem_conditions(condition: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per parent with the fields of all its typed conditions, in one aggregation."""
    basic = condition.select("parent_id", "type", "status").distinct()
    wide = joins.widen_conditions(condition.withColumn("_kind", F.col("condition_type").cast("string")), "parent_id", "_kind", "condition_json", fields)
    return basic.join(wide, "parent_id", "left")


def condition_weekdays(condition: DataFrame, kind: int) -> DataFrame:
    """(parent, weekday) of the weekday condition."""
    rows = condition.filter(F.col("condition_type") == kind).select("parent_id", F.explode(F.from_json("condition_json", "weekday array<string>")["weekday"]).alias("weekday"))
    return rows.distinct()


def brand_shops(brand: DataFrame, category: DataFrame) -> DataFrame:
    """Brands with category, one row per mall and shop; a brand without shops stays."""
    shops = lists.explode_nested(brand, "brand_id", "shop_id_list", "mall_id", "shop_id")
    df = joins.enrich(brand.drop("shop_id_list"), [(category, {"brand_category_id": "brand_category_id"}, {"name_lang1": "category_name"})])
    return df.join(shops.select("brand_id", F.col("mall_id").try_cast("int").alias("mall_id"), F.col("shop_id").try_cast("int").alias("shop_id")), "brand_id", "left")


def payment_tiers(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Point-or-cash tiers of gifts and coupons with how each tier is paid and how the item combines them.

    ``parts`` maps the key column to its content frame.
    """
    out = []
    for key, df in parts.items():
        df = df.filter(F.col("redeem_bonus_points_with_cash").isNotNull())
        tiers = lists.explode_tiers(df, key, "redeem_bonus_points_with_cash").withColumnRenamed("tier_type", "redeem_method")
        mix = aggregates.classify_mix(tiers, [key], "amount", "bonus_point", MIX)
        full = joins.enrich(tiers, [(mix, {key: key}, {"mix": "redeem_method_combination"}), (df, {key: key}, {"reward_brand_id": "reward_brand_id"})])
        out.append(full.withColumn("reward_brand_id", codes.null_if_value(F.col("reward_brand_id"), 9999999)).withColumnRenamed(key, "gift_id"))
    return sets.union_all(*out)
