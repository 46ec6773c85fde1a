"""Tables handed over to the customer platform."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import marts_parking, marts_services, registry  # noqa: F401
from checks.registry import check
from martkit.operators import sets
from martkit.plans import platform

REDEEMED = """
    red as (
      select o_orderkey as transaction_id, o_custkey % 30 as mall_id, case when o_custkey % 7 = 0 then 'RMCR' else 'P1' end as property_id, o_orderpriority as membership_tier,
             case when o_orderstatus = 'P' then 'Cancelled' else 'Collected' end as redemption_status_detail, case when o_orderkey % 3 = 0 then 'Redeem by 0 point' else 'Redeem by bonus point' end as redeem_type,
             case when o_orderkey % 5 = 0 then 0 else cast(o_custkey as int) end as redeemed_bonus_points, o_orderdate + interval '10' hour as redeem_datetime, cast(o_orderdate as date) as redeem_date,
             case when o_custkey % 11 = 0 then 'Suspended' else 'Active' end as member_status_detail, case when o_orderkey % 13 = 0 then 1 else 0 end as abnormal_case, 1 as redeemed_qty,
             case when cast(o_orderdate as date) < date '1996-03-12' then 1 else 0 end as redeem_datetime_before_launch from orders)"""


@check("mart_platform_redemption", f"""
    with {REDEEMED} select 'raw' as form, * from red
    union all select 'clean', * from red where redemption_status_detail <> 'Cancelled' and redeem_datetime >= timestamp '1996-03-12 14:00:00' and redeem_date < date '2001-07-01' and member_status_detail = 'Active' and abnormal_case = 0
      and not (redeemed_bonus_points = 0 and property_id = 'RMCR')""")
def _(t):
    day, o = F.to_date("o_orderdate"), F.col("o_orderkey")
    fact = t.orders.select(
        o.alias("transaction_id"), (F.col("o_custkey") % 30).alias("provider_mall_id"), F.when(F.col("o_custkey") % 7 == 0, "RMCR").otherwise("P1").alias("provider_property_id"), F.col("o_orderpriority").alias("member_tier"),
        F.when(F.col("o_orderstatus") == "P", "Cancelled").otherwise("Collected").alias("redemption_status_detail"), F.when(o % 3 == 0, "Redeem by 0 point").otherwise("Redeem by bonus point").alias("redeem_type"),
        F.when(o % 5 == 0, 0).otherwise(F.col("o_custkey").cast("int")).alias("redeemed_bonus_points"), (F.col("o_orderdate") + F.expr("interval 10 hours")).alias("redeem_datetime"), day.alias("redeem_date"),
        F.when(F.col("o_custkey") % 11 == 0, "Suspended").otherwise("Active").alias("member_status_detail"), F.when(o % 13 == 0, 1).otherwise(0).alias("abnormal_case"))
    raw, clean = platform.redemptions(fact, t.stage, launch=datetime(1996, 3, 12, 14), as_of="2001-07-01", cancelled=["Cancelled"],
                                      excluded=[(0, "Redeem by bonus point", "RMCR"), (0, "Redeem by 0 point", "RMCR")])
    return sets.union_all(raw.withColumn("form", F.lit("raw")), clean.withColumn("form", F.lit("clean")))


@check("mart_platform_points", """
    with p as (select event_id as id, 'T' || (user_id % 3) as membership_tier, case when user_id % 9 = 0 then 'Invalid' else 'Active' end as member_status_detail, case when event_type = 'error' then 1 else 0 end as abnormal_case,
                      case when ts < timestamp '2024-01-05 14:00:00' then 1 else 0 end as created_datetime_before_launch from events)
    select 'raw' as form, * from p union all select 'clean', * from p where member_status_detail = 'Active' and abnormal_case = 0 and created_datetime_before_launch = 0""")
def _(t):
    fact = t.events.select(
        F.col("event_id").alias("id"), F.concat(F.lit("T"), F.col("user_id") % 3).alias("member_tier"), F.when(F.col("user_id") % 9 == 0, "Invalid").otherwise("Active").alias("member_status_detail"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("abnormal_case"), F.when(F.col("ts") < F.lit(datetime(2024, 1, 5, 14)).cast("timestamp_ntz"), 1).otherwise(0).alias("created_datetime_before_launch"))
    raw, clean = platform.points(fact, t.stage)
    return sets.union_all(raw.withColumn("form", F.lit("raw")), clean.withColumn("form", F.lit("clean")))


@check("mart_platform_parking_redemption", """
    select *, row_number() over (order by car_in_datetime, event_id) as row_no from (select ts as car_in_datetime, event_id, event_type as redemption_type, '' as card_no from events) x""")
def _(t):
    return platform.export_table(t.events.select(F.col("ts").alias("car_in_datetime"), "event_id", F.col("event_type").alias("redemption_type")), platform.EXPORTS["parking_redemption"], t.stage)


@check("mart_platform_devices", "select event_id, case when user_id % 4 > 0 then user_id end as member_id from events where user_id % 4 > 0")
def _(t):
    return platform.export_table(t.events.select("event_id", F.when(F.col("user_id") % 4 > 0, F.col("user_id")).alias("member_id")), platform.EXPORTS["device"], t.stage)


@check("mart_platform_registration", "select c_custkey, case when c_nationkey = 3 then '' else cast(c_nationkey as string) end as from_mall_id from customer")
def _(t):
    return platform.registrations(t.customer.select("c_custkey", F.when(F.col("c_nationkey") == 3, "__HIVE_DEFAULT_PARTITION__").otherwise(F.col("c_nationkey").cast("string")).alias("from_mall_id")))


@check("mart_platform_inventory", """
    select p_partkey as gift_id, p_name as gift_name, case when p_size % 2 = 0 then p_type end as gift_business_nature, case when p_size % 2 = 0 then p_brand end as gift_trade_category, case when p_size % 2 = 0 then p_name end as gift_brand,
           case when p_size % 2 = 0 then p_type end as gift_nature, case when p_size % 2 = 0 then p_size end as gift_face_unit_value, '' as common_gift, '' as hotpick_gift, '' as redemption_weekday from part""")
def _(t):
    mapping = t.part.filter("p_size % 2 = 0").select(F.col("p_partkey").alias("cms_gift_id"), F.col("p_type").alias("business_nature"), F.col("p_brand").alias("trade_category"),
                                                     F.col("p_name").alias("brand_name"), F.col("p_type").alias("gift_nature"), F.col("p_size").alias("face_unit_value"))
    return platform.inventory(t.part.select(F.col("p_partkey").alias("gift_id"), F.col("p_name").alias("gift_name")), mapping)


@check("mart_platform_copies", "select 'shop' as name, s_suppkey as id, s_name as label from supplier union all select 'gift_content', p_partkey, p_name from part union all select 'point_lot', c_custkey, c_name from customer")
def _(t):
    parts = {"shop": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label")), "gift_content": t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label")),
             "point_lot": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"))}
    return sets.union_all(*[platform.export_table(df, platform.EXPORTS[n], t.stage).select(F.lit(n).alias("name"), "id", "label") for n, df in parts.items()])


NUMBERED = "row_number() over (order by car_in_datetime, {rest}) as row_no"


@check("mart_platform_parking_entry", f"select *, {NUMBERED.format(rest='lpn, carparkid, operation')} from (select distinct timestamp as car_in_datetime, lpn, carparkid, operation from src_gate_log) x")
def _(t):
    entries = t.derived("src_gate_log").select(F.col("timestamp").alias("car_in_datetime"), "lpn", "carparkid", "operation").distinct()
    return platform.export_table(entries, platform.EXPORTS["parking_entry"], t.stage)


@check("mart_platform_parking_invoice", f"""
    select *, {NUMBERED.format(rest='car_out_datetime, car_plate, member_id, property_id, invoice_no, shop_no')} from (
      select distinct car_in_datetime, car_out_datetime, car_plate, member_id, property_id, invoice_no, shop_no from src_parking_invoice) x""")
def _(t):
    rows = t.derived("src_parking_invoice").select("car_in_datetime", "car_out_datetime", "car_plate", "member_id", "property_id", "invoice_no", "shop_no").distinct()
    return platform.export_table(rows, platform.EXPORTS["parking_invoice"], t.stage)


def handed_over(name: str, source: str, constants: str = "") -> None:
    """The result of a registered mart in the platform's form; the twin wraps the mart's twin."""
    def run(spark, sf_dir):
        return platform.export_table(registry.QUERIES[source](spark, sf_dir), platform.EXPORTS[name], registry.Tables(spark, sf_dir).stage)

    registry.QUERIES[f"mart_platform_{name}"] = run
    registry.ORACLES[f"mart_platform_{name}"] = f"select *{constants} from ({registry.ORACLES[source]}) x"


handed_over("stamp_earn", "mart_stamp_earn")
handed_over("stamp_redemption", "mart_stamp_redemptions")
handed_over("stamp_member_spend", "mart_stamp_member_spend")
handed_over("coupon_content", "mart_coupon_content")
handed_over("parker_identity", "mart_parker_identity", ", '' as card_no")
