"""Directory tables: malls, floors, phases, brands, shops, categories and their links."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import codes, text
from martkit.operators import joins, lists, ordered

# Codes and labels of the directory.
STATUS = {"A": "ACTIVE", "I": "INACTIVE", "V": "INVALID"}
DISTRICTS = {0: "HONG_KONG_ISLAND", 1: "KOWLOON"}


def web_address(url: Column) -> Column:
    """Addresses that begin with ``www`` get a scheme."""
    return F.when(F.left(url, F.lit(3)) == "www", F.concat(F.lit("http://"), url)).otherwise(url)


def malls(mall: DataFrame, site: DataFrame, *, site_ids: Mapping[int, int], kinds: Sequence[tuple], other: str = "OTHER", active: Sequence[int] = (), excluded: Sequence[int] = ()) -> DataFrame:
    """Malls with their site record, found by a corrected id for those in ``site_ids``.

    ``kinds`` are closed id ranges ``(low, high, kind)`` with an open top.
    """
    df = mall.filter(~F.col("mall_id").isin(list(excluded))) if excluded else mall
    key = codes.override(codes.decode(F.col("mall_id"), site_ids), F.col("cms_mall_id"))
    df = joins.enrich(df, [(site, {"id": key}, {"mall_name_en": "_name", "district": "_district", "website_url": "_url", "status": "_shown", "loc_long_en": "_address"})])
    kind = codes.band(F.col("mall_id"), kinds, other)
    district = F.when(F.col("_district").isNull(), "").otherwise(codes.decode(F.col("_district"), DISTRICTS, "NEW_TERRITORIES"))
    status = F.when(F.col("mall_id").isin(list(active)), "ACTIVE").otherwise(codes.override(codes.decode(F.col("status"), STATUS), F.col("status")))
    return df.select("mall_id", F.coalesce("_name", "name_lang1").alias("name_en"), F.coalesce("_address", F.lit("")).alias("address_en"), district.alias("district"), web_address(F.col("_url")).alias("website_url"),
                     codes.flag(F.col("status") == "A").alias("under_loyalty_program"), status.alias("status"), kind.alias("mall_type"), F.coalesce("_shown", F.lit(0)).alias("show_in_api"))


def car_parks(carpark: DataFrame, site: DataFrame, mall: DataFrame, *, site_ids: Mapping[int, int]) -> DataFrame:
    """Car parks with their site record and mall name."""
    key = codes.override(codes.decode(F.col("carpark_id"), site_ids), F.col("carpark_id"))
    df = joins.enrich(carpark, [(site, {"id": key}, {"name_en": "_name"}), (mall, {"mall_id": "mallid"}, {"name_lang1": "mall_name"})])
    return df.select("carpark_id", F.coalesce("_name", "name").alias("name_en"), F.col("mallid").alias("mall_id"), "mall_name")


def floor_plans(plan: DataFrame, kept: Sequence[int]) -> DataFrame:
    """Published floors and listed exceptions, once each."""
    return plan.filter((F.col("status") == 1) | F.col("id").isin(list(kept))).select(
        "id", F.coalesce("create_date", "last_update_date").alias("created_at"), F.coalesce("last_update_date", "create_date").alias("updated_at"), "floor_name_en", "mall_id").distinct()


def floor_phase_links(plan: DataFrame, kept: Sequence[int], *, block: int = 100_000) -> DataFrame:
    """Floor to phase with the floor's rank inside the phase."""
    rows = plan.filter((F.col("status") == 1) | F.col("id").isin(list(kept))).select(F.col("id").alias("floor_plan_id"), F.col("floor_phase").alias("phase_id"))
    return ordered.ordinal(rows, ["phase_id"], "floor_plan_id", "floor_plan_order", ordered.id_blocks("floor_plan_id", block))


def phases(phase: DataFrame, site: DataFrame, mall: DataFrame) -> DataFrame:
    """Published phases; an empty name falls back to the site's, then the mall's."""
    df = joins.enrich(phase.filter("status = 1"), [(site, {"id": "mall"}, {"mall_name_en": "_site", "id": "_site_id"}), (mall, {"cms_mall_id": "mall"}, {"mall_id": "_mall_id", "name_lang1": "_mall_name"})])
    name = text.first_present(F.col("phase_name_en"), F.col("_site"), F.col("_mall_name"))
    return df.select(F.col("phase_id").alias("id"), F.nullif("phone", F.lit("")).alias("phone"), name.alias("phase_name_en"), F.coalesce("_mall_id", "_site_id").alias("mall_id")).filter("mall_id is not null")


def main_categories(category: DataFrame) -> DataFrame:
    return category.filter("main_cat is null and status = 1").select("id", F.col("category_name_en").alias("main_name"), F.when(F.col("type") == 1, "Dining").otherwise("Shopping").alias("shop_type"))


def sub_categories(category: DataFrame) -> DataFrame:
    """Categories that are no main category, with the name of theirs."""
    mains = category.filter("main_cat is null and status = 1").select("id", F.col("category_name_en").alias("main_name")).distinct()
    subs = joins.anti_null_aware(category.filter("status = 1"), mains, {"id": "id"})
    df = joins.enrich(subs, [(mains, {"id": "main_cat"}, {"main_name": "_main"})])
    return df.select("id", F.col("category_name_en").alias("sub_name"), F.col("main_cat").alias("main_category_id"), F.concat("category_name_en", F.lit("_"), "_main").alias("alias_key"))


def brands(partner: DataFrame, category: DataFrame, *, category_ids: Mapping[int, int]) -> DataFrame:
    """Partners as brands, their category found by a corrected id."""
    key = codes.override(codes.decode(F.col("partner_id"), category_ids), F.col("partner_id"))
    df = joins.enrich(partner, [(category, {"brand_category_id": key}, {"name_lang1": "category_name"})])
    return df.select(F.col("partner_id").alias("brand_id"), F.col("name_lang1").alias("brand_name"), "category_name")


def brand_category_links(brand: DataFrame, *, brand_ids: Mapping[int, int]) -> DataFrame:
    return brand.filter("status = 'A'").select(codes.override(codes.decode(F.col("brand_id"), brand_ids), F.col("brand_id")).alias("brand_id"), "brand_category_id").distinct()


def shops(site_shop: DataFrame, shop: DataFrame, partner_shop: DataFrame, partners: Mapping[str, int], tickets: Mapping[int, str]) -> DataFrame:
    """Site shops with programme data and one code column per partner."""
    wide = joins.pivot_codes(partner_shop, ["shop_id"], "partner_id", "partner_shop_id", list(partners.values()))
    df = joins.enrich(site_shop, [(shop, {"shop_id": "id"}, {"status": "_status", "shop_no": "shop_no", "visible": "_visible"}),
                                  (wide, {"shop_id": "id"}, {f"partner_shop_id_{p}": f"{n}_shop_code" for n, p in partners.items()})])
    return df.select("id", F.col("shop_name").alias("name_en"), codes.decode(F.col("ticket_type"), tickets, "none").alias("ticket_type"), F.when(F.col("status") == 1, 1).otherwise(0).alias("display_in_directory"), "shop_no",
                     "mall_id", *[f"{n}_shop_code" for n in partners], F.when(F.col("_status") == "A", "ACTIVE").when(F.col("_status") == "V", "INVALID").otherwise("INACTIVE").alias("status"))


def shop_links(site_shop: DataFrame, col: str, target: str, *, excluded: Sequence[int] = (), min_len: int = 2) -> DataFrame:
    """(shop, target id, position) of a comma list; every position of the list and none past its end.

    A rule of the lists drops rows: tokens of fewer than ``min_len`` characters are no ids.
    """
    rows = lists.link_positions(site_shop.filter("status = 1").withColumn(col, F.replace(col, F.lit(" "), F.lit(""))), "id", col, min_len=min_len)
    out = rows.select(F.col("id").alias("shop_id"), F.col("token").try_cast("int").alias(target), F.col("position").alias("shop_order"))
    return out.filter(~F.col(target).isin(list(excluded))) if excluded else out
