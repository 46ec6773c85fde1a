"""Stamp, mission, feature, content, feed and export marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.marts_commerce import good_fact
from checks.marts_core import CATEGORIES, DIM, LEDGER, REDEMPTION, doubles, ledger_fact, member_dim, redemption_fact
from checks.marts_parking import HISTORY, history
from checks.registry import Tables, check
from martkit.functions import dates
from martkit.plans import content, engagement, feeds, member, parking, stamps
from martkit.sources import readers

PROGRAMME = """
    prog as (
      select id as stamp_program_id, title_en, banner_desc_en, max_no_of_stamp as max_stamp_per_day, max_no_of_receipt as max_receipt_per_day, max_earn_stamp as max_stamp_per_program, createtime, status, stamp_desc_en,
             case when datefrom_collect > 0 then cast(strptime(cast(datefrom_collect as string), '%Y%m%d') as date) end as datefrom_collect, date '2000-12-31' as dateto_collect, date '1996-02-01' as datefrom_gift, date '2001-01-31' as dateto_gift,
             cast(id * 10 as string) as min_spend_for_a_stamp from src_stamp_card)"""
GIFTS = """
    gifts as (
      select id as stamp_program_id, 'G' || id as physical_gift, '' as points, '5' as stamp_required, '0' as approval_required from src_stamp_card
      union all select id, '', cast(id * 2 as string), '10', '1' from src_stamp_card)"""


@check("mart_stamp_programmes", f"with {PROGRAMME} select * from prog")
def _(t):
    return stamps.programmes(t.derived("src_stamp_card"))


@check("mart_stamp_gift_list", f"with {GIFTS} select * from gifts")
def _(t):
    return stamps.gift_list(t.derived("src_stamp_card"))


EARNED = "earned as (select id as stamp_transaction_id, vid as member_id, cardid as stamp_program_id, no_of_receipt, earn_stamp, lastupdate, case when no_of_receipt = 0 then 1 else 0 end as is_point_conversion from src_stamp_record)"
RECEIPTS = """
    rec as (select id as stamp_transaction_id, vid as member_id, cardid as stamp_program_id, lastupdate, cast(split_part(receipt_id, '::', 1) as bigint) as receipt_id from src_stamp_record
      union all select id, vid, cardid, lastupdate, cast(split_part(receipt_id, '::', 2) as bigint) from src_stamp_record)"""


@check("mart_stamp_earned", f"with {EARNED} select * from earned")
def _(t):
    return stamps.earned(t.derived("src_stamp_record"))


@check("mart_stamp_receipts", f"with {RECEIPTS} select * from rec")
def _(t):
    return stamps.receipts(t.derived("src_stamp_record"))


REDEEMED = """
    red as (
      select vid as member_id, cardid as stamp_program_id, case when substr(vid, 2) % 2 = 0 then 'G' || substr(vid, 2) else '' end as physical_gift, case when substr(vid, 2) % 2 = 1 then substr(vid, 2) else '' end as points,
             case when substr(vid, 2) % 2 = 0 then 0 else 1 end as point_or_gift, gift_stamp_required, pickup_mall_id, redeem_status, case when redeem_date <> '0' then cast(strptime(redeem_date, '%Y%m%d') as date) end as redeem_date, recordtime
      from src_stamp_redemption)""".replace("substr(vid, 2) %", "cast(substr(vid, 2) as int) %")


@check("mart_stamp_redemption_staging", f"with {REDEEMED} select * from red")
def _(t):
    return stamps.redemptions(t.derived("src_stamp_redemption"))


@check("mart_stamp_shop_staging", """
    select cardid as stamp_program_id, try_cast(split_part(shopid, '-', 1) as int) as mall_id, try_cast(split_part(shopid, '-', 2) as bigint) as shop_id, shopname_en from src_stamp_shop""")
def _(t):
    return stamps.shops(t.derived("src_stamp_shop"))


@check("mart_stamp_gift_inventory", f"""
    with {PROGRAMME}, {GIFTS}
    select g.stamp_program_id, title_en, stamp_desc_en, case when physical_gift = '' then 1 else 0 end as point_or_gift, points, physical_gift, stamp_required, approval_required, team, gift_status,
           coalesce(created_datetime, createtime) as create_datetime, coalesce(name_en, banner_desc_en) as name_en, coalesce(redemption_date_start, datefrom_gift) as redemption_date_start,
           coalesce(redemption_date_end, dateto_gift) as redemption_date_end, original_stock_level
    from gifts g left join prog p on g.stamp_program_id = p.stamp_program_id left join src_stamp_inventory i on physical_gift = gift_id""")
def _(t):
    card = t.derived("src_stamp_card")
    return stamps.stamp_gift_inventory(stamps.gift_list(card), stamps.programmes(card), t.derived("src_stamp_inventory"))


@check("mart_stamp_shops", """
    select distinct cardid as stamp_program_id, x.shop_id, shop_name, property_id, lms_trade_name, lms_standard_brand_name, lms_standard_trade_category
    from (select cardid, try_cast(split_part(shopid, '-', 1) as int) as mall_id, try_cast(split_part(shopid, '-', 2) as bigint) as shop_id from src_stamp_shop where cardid <> 0) x
    left join src_shop s on x.mall_id = s.mall_id and x.shop_id = s.mapping_shop_id""")
def _(t):
    return stamps.stamp_shops(stamps.shops(t.derived("src_stamp_shop")), t.derived("src_shop"))


@check("mart_stamp_redemptions", f"""
    with {DIM}, {PROGRAMME}, {REDEEMED}
    select r.* exclude (pickup_mall_id), m.team, m.property_id, cast(redeem_date - datefrom_gift + 1 as int) as day_since_collection_start, gender, age, age_group, residence, d.district
    from red r left join src_mall m on pickup_mall_id = mall_id left join prog p on r.stamp_program_id = p.stamp_program_id left join dim d on r.member_id = d.member_id""")
def _(t):
    return stamps.stamp_redemptions(stamps.redemptions(t.derived("src_stamp_redemption")), t.derived("src_mall"), stamps.programmes(t.derived("src_stamp_card")), member.slim(member_dim(t)))


STAMP_SPEND = f"""{PROGRAMME}, {EARNED}, {RECEIPTS},
    sspend as (select r.* exclude (lastupdate), receipt_transaction_date, team, property_id, shop_name, receipt_amount, lms_standard_brand_name, lms_standard_trade_category, title_en, earn_stamp
      from rec r left join src_fact f on r.receipt_id = f.receipt_id left join prog p on r.stamp_program_id = p.stamp_program_id left join earned e on r.stamp_transaction_id = e.stamp_transaction_id)"""


def stamp_spend(t: Tables):
    record = t.derived("src_stamp_record")
    return stamps.member_spend(stamps.receipts(record), t.derived("src_fact"), stamps.programmes(t.derived("src_stamp_card")), stamps.earned(record))


@check("mart_stamp_member_spend", f"with {STAMP_SPEND} select * replace (cast(receipt_amount as double) as receipt_amount) from sspend")
def _(t):
    return stamp_spend(t).withColumns(doubles("receipt_amount"))


@check("mart_stamp_earn", f"""
    with {DIM}, {STAMP_SPEND},
    b as (select member_id, stamp_transaction_id, stamp_program_id, count(distinct receipt_id) as no_receipt, min(receipt_transaction_date) as receipt_date_min, max(receipt_transaction_date) as receipt_date_max,
      sum(receipt_amount) as total_receipt_amount, string_agg(distinct property_id, '|') as property_group from sspend group by 1, 2, 3),
    g as (select member_id, stamp_transaction_id, stamp_program_id, cast(lastupdate as date) as stamp_last_updated_date, cast(sum(earn_stamp) as bigint) as stamps_earn from earned group by 1, 2, 3, 4)
    select g.*, no_receipt, receipt_date_min, receipt_date_max, cast(total_receipt_amount as double) as total_receipt_amount, property_group, title_en, gender, age, age_group, residence, d.district,
           cast(receipt_date_max - datefrom_collect + 1 as int) as day_since_program_start
    from g join b on g.member_id = b.member_id and g.stamp_transaction_id = b.stamp_transaction_id and g.stamp_program_id = b.stamp_program_id left join prog p on g.stamp_program_id = p.stamp_program_id
    left join dim d on g.member_id = d.member_id where stamps_earn > 0 and receipt_date_max >= datefrom_collect""")
def _(t):
    out = stamps.stamp_earn(stamps.earned(t.derived("src_stamp_record")), stamp_spend(t), stamps.programmes(t.derived("src_stamp_card")), member.slim(member_dim(t)))
    return out.withColumns(doubles("total_receipt_amount"))


@check("mart_mission_progress", """
    select a.mission_type, a.missionid, a.vid, no_record, case when b.mission_type = 'spending' then spending_total_no_receipt when b.mission_type = 'reward' then reward_total_redeem end as required_times, redeemed_bonus_points,
           case when c.vid is not null then 'Y' else 'N' end as completed, is_redeemed
    from (select mission_type, missionid, vid, count(*) as no_record, cast(sum(redeemed_bonus_points) as bigint) as redeemed_bonus_points from src_mission_record group by 1, 2, 3) a left join src_mission b on a.missionid = b.id
    left join (select missionid, vid, max(case when is_redeemed = 'yes' then 1 else 0 end) as is_redeemed from src_mission_completed group by 1, 2) c on a.missionid = c.missionid and a.vid = c.vid""")
def _(t):
    return engagement.mission_progress(t.derived("src_mission_record"), t.derived("src_mission"), t.derived("src_mission_completed"))


SPEND_PERIODS = {"Ever": "1996-03-12", "P3M": "2001-05-01", "P12M": "2000-08-01"}
POINT_PERIODS = {"P2MTD": "2024-01-05", "MTD": "2024-01-15"}
GOOD = "receipt_status_detail = 'Approved' and member_status_detail not in ('Suspended', 'Invalid', 'Waiting for verification') and abnormal_case = 0"
FEATURES = " union all ".join(
    [f"select member_id, 'Member_Spend_' || property_id || '_{p}' as feature, cast(cast(sum(receipt_amount) as decimal(38, 1)) as string) as value from src_fact where {GOOD} and receipt_transaction_date between date '{d}' and date '2001-08-01' group by member_id, property_id "
     f"union all select member_id, 'Member_Spend_Total_Malls_{p}', cast(cast(sum(receipt_amount) as decimal(38, 1)) as string) from src_fact where {GOOD} and receipt_transaction_date between date '{d}' and date '2001-08-01' group by member_id"
     for p, d in SPEND_PERIODS.items()]
    + [f"select member_id, 'Point_{n}_Total_Malls_{p}', cast(cast(sum(case when {c} then points else 0 end) as decimal(38, 1)) as string) from src_points_flat where kind <> 'E' and created_date between date '{d}' and date '2024-01-31' group by member_id"
       for p, d in POINT_PERIODS.items() for n, c in (("Earned", "points > 0 or kind = 'A'"), ("Burnt", "points < 0 and kind <> 'A'"))]
    + ["select 'M' || c_custkey, 'Is_Buyer', '1' from customer where c_acctbal > 9000", "select 'M' || c_custkey, 'Segment', c_mktsegment from customer where c_nationkey <> 3"])


@check("mart_member_features", f"""
    with src_points_flat as (select 'M' || user_id as member_id, case when event_type in ('error', 'purchase') then -1 else 1 end * cast(floor(value) as bigint) as points, cast(ts - interval '8' hour as date) as created_date,
      case event_type when 'signup' then 'A' when 'error' then 'E' else 'S' end as kind from events),
    f as ({FEATURES}), ids as (select distinct feature from f where feature not like '%P3M')
    select member_id, ids.feature as id, value, 'v1' as version, date '2001-08-01' as created_date, case when ids.feature like 'Member_Spend_%' or ids.feature like 'Point_%' then '2001-08-02' else '9999-12-31' end as end_date
    from f left join ids on f.feature = ids.feature""")
def _(t):
    # Feature ids: every feature but the three-month ones is known, under its own name.
    ledger = t.derived("src_points").select(F.upper("member_id").alias("member_id"), "points", F.when(F.col("action").isin("A", "E"), F.col("action")).otherwise("S").alias("bp_transaction_type"),
                                            dates.local_date(F.col("created_date")).alias("created_date"))
    customer = t.customer.withColumn("member_id", F.concat(F.lit("M"), "c_custkey"))
    parts = [engagement.spend_features(good_fact(t), SPEND_PERIODS, as_of="2001-08-01"), engagement.point_features(ledger, POINT_PERIODS, as_of="2024-01-31"),
             engagement.flag_feature(customer.filter("c_acctbal > 9000"), "Is_Buyer"), engagement.flag_feature(customer, "Segment", F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_mktsegment")))]
    names = [p.select("feature") for p in parts]
    ids = names[0].union(names[1]).union(names[2]).union(names[3]).filter(~F.col("feature").like("%P3M")).distinct().select(F.col("feature").alias("columnname"), F.col("feature").alias("id"))
    return engagement.member_features(parts, ids, as_of="2001-08-01", version="v1")


@check("mart_parker_feature", f"""
    with {HISTORY} select member_id, 'Member_Parker_Type_Latest' as feature, case when max(case when identify_type = 'identify by Contactless Parking' then 1 else 0 end) = 1 then 'Contactless Parker' else 'Non-Contactless Parker' end as value
    from history group by 1""")
def _(t):
    return engagement.parker_feature(parking.parker_identity(history(t)))


@check("mart_business_overlap", f"""
    with {DIM}, s as (select hashmobileno, min(regdttm) as r from src_store_profile group by 1), p as (select hashmobileno, min(regdttm) as r from src_telco_profile group by 1)
    select distinct l.hashmobileno, globalcustid, l.member_id, createdttm, case when lower(lobmemid_store) = 'store member' then 1 else 0 end as store, case when lower(lobmemid_telco) = 'telco member' then 1 else 0 end as telco,
           member_status_detail, registration_datetime, s.r as store_registration_datetime, case when s.r is not null then 1 else 0 end as store_active, p.r as telco_registration_datetime, case when p.r is not null then 1 else 0 end as telco_active
    from src_linkage l left join dim d on l.member_id = d.member_id left join s on l.hashmobileno = s.hashmobileno and lower(lobmemid_store) = 'store member' left join p on l.hashmobileno = p.hashmobileno and lower(lobmemid_telco) = 'telco member'""")
def _(t):
    linkage = engagement.linkage_flags(t.derived("src_linkage"), ["store", "telco"])
    return engagement.business_overlap(linkage, {"store": t.derived("src_store_profile"), "telco": t.derived("src_telco_profile")}, member.slim(member_dim(t)))


@check("mart_attribute_copy", "select id, cat, try_cast(left(createdttm, 10) as date) as createdttm, cat as partition_key from src_attribute")
def _(t):
    return engagement.attribute_copy(t.derived("src_attribute"), day_columns=["createdttm"], by="cat")


@check("mart_rfm_copy", "select id, cast(recency as int) as recency, try_cast(frequency as int) as frequency, cast(monetary as float) as monetary, date '2022-01-15' as ref_date from src_rfm")
def _(t):
    return engagement.rfm_copy(t.derived("src_rfm"), ints=["recency", "frequency"], floats=["monetary"], day="ref_date")


@check("mart_vehicle_brands", "select distinct trim(upper(brand)) as brand, trim(upper(car_plate)) as car_plate, cast(strptime(last_seen, '%Y%m%d') as date) as last_seen from src_car_profile")
def _(t):
    return engagement.vehicle_brands(t.derived("src_car_profile"))


@check("mart_approval_holidays", """
    with h as (select distinct cast(tag as date) as d from src_calendar where type = 12 and status = 'A' and isodow(cast(tag as date)) <= 5 and tag >= '1996-01-01')
    select receipt_id, max((select count(*) from h where d between receipt_upload_date and coalesce(case when receipt_status_detail = 'Rejected' then null else approve_or_reject_date end, date '2001-08-01'))) as no_of_ph from src_fact group by receipt_id""")
def _(t):
    fact = t.derived("src_fact").withColumn("approve_or_reject_date", F.when(F.col("receipt_status_detail") != "Rejected", F.col("approve_or_reject_date")))
    return engagement.approval_holidays(fact, t.derived("src_calendar"), as_of="2001-08-01", since="1996-01-01")


@check("mart_coupon_links", """
    select coupon_id, x as shop_id from (select coupon_id, unnest([cast(coupon_id as string), 'x', cast(nation as string)]) as x from (
      select s_suppkey as coupon_id, s_nationkey as nation from supplier where s_suppkey % 4 <> 0 and s_nationkey <> 9
      ) a union all select s_suppkey, '9' from supplier where s_suppkey % 4 <> 0 and s_nationkey = 9) y""")
def _(t):
    return content.item_links(t.derived("src_coupon_json"), "coupon_id", "usage_shop_id", "shop_id")


@check("mart_coupon_points", """
    select s_suppkey as coupon_id, case when s_suppkey % 5 = 1 then 7 when s_suppkey % 5 in (2, 3) then cast(s_suppkey as int) end as bonus_point,
           case when s_suppkey % 5 = 1 then '1' end as member_level_id from supplier where s_suppkey % 5 <> 4""")
def _(t):
    return content.coupon_points(t.derived("src_coupon_json"))


@check("mart_coupon_content", """
    with c as (select *, s_suppkey % 2 = 0 as mixed, s_suppkey % 5 as kind from supplier)
    select s_suppkey as coupon_id, s_name as name_lang1, case when s_suppkey % 3 = 0 then timestamp '1970-01-01 23:59:59' else timestamp '2022-01-01' end as usage_expiry_date,
           case when mixed then '0' else '' end as amount_1, case when mixed then cast(s_nationkey as string) else '' end as amount_2,
           case when mixed then cast(s_suppkey as string) when kind = 1 then '1,' || (100 + s_suppkey % 800) when kind in (2, 3) then cast(s_suppkey as string) else '' end as bonus_point_1,
           case when mixed then '5' when kind = 1 then '7' else '' end as bonus_point_2, case when kind = 1 then '1' else '' end as member_level_id_1, '' as member_level_id_2,
           case when mixed then '1' else '' end as tier_1, case when mixed then '2' else '' end as tier_2 from c""")
def _(t):
    return content.coupon_content(t.derived("src_coupon_json").drop("usage_shop_id", "reward_brand_id"))


@check("mart_gift_content", """
    select p_partkey as gift_id, p_name as name_lang1, reserve_expiry_date, cast(p_size as double) as bonus_point_1, cast(p_size % 4 as string) as member_level_id_1, case when p_size % 3 = 0 then cast(p_size % 5 as string) end as car_park_redeem_hours,
           cast(null as string) as car_park_min_spending_amount from part join src_gift_json on p_partkey = gift_id where p_size % 8 <> 0""")
def _(t):
    return content.gift_content(t.derived("src_gift_json").drop("redeem_bonus_points_with_cash", "reward_brand_id"))


@check("mart_redeem_conditions", """
    select p_partkey as parent_id, 'T' || (p_size % 3) as type, 'A' as status, 'D' || (p_size % 4) as "1_frequency_type", cast(p_size as string) as "1_value" from part""")
def _(t):
    return content.redeem_conditions(t.derived("src_typed_condition"), {"1": ["frequency_type", "value"]})


@check("mart_condition_weekdays", """
    select distinct p_partkey as parent_id, cast(w as string) as weekday from (select p_partkey, unnest([p_size % 7, (p_size + 1) % 7]) as w from part where p_size % 2 = 0) x""")
def _(t):
    return content.condition_weekdays(t.derived("src_typed_condition"), 2)


@check("mart_brand_shops", """
    select s_suppkey as brand_id, s_name as brand_name, cast(s_nationkey as int) as brand_category_id, case when s_nationkey < 20 then n_name end as category_name, x.mall_id, x.shop_id
    from supplier join nation on s_nationkey = n_nationkey left join (
      select s_suppkey as k, cast(s_nationkey as int) as mall_id, cast(s_suppkey as int) as shop_id from supplier where s_suppkey % 6 <> 0 union all select s_suppkey, cast(s_nationkey as int), 7 from supplier where s_suppkey % 6 <> 0
      union all select s_suppkey, 3, 9 from supplier where s_suppkey % 6 <> 0) x on k = s_suppkey""")
def _(t):
    return content.brand_shops(t.derived("src_brand"), t.derived("src_brand_category"))


@check("mart_payment_tiers", """
    with tiers as (
      select s_suppkey as gift_id, 1 as tier, 0.0e0 as amount, cast(s_suppkey as double) as bonus_point, case when s_suppkey % 10 = 0 then null else cast(s_nationkey as int) end as reward_brand_id, 'c' as src from supplier where s_suppkey % 2 = 0
      union all select s_suppkey, 2, cast(s_nationkey as double), 5, case when s_suppkey % 10 = 0 then null else cast(s_nationkey as int) end, 'c' from supplier where s_suppkey % 2 = 0
      union all select p_partkey, 1, cast(p_size as double), 0, cast(p_size as int), 'g' from part where p_size % 4 = 0 union all select p_partkey, 2, p_size + 1, 0, cast(p_size as int), 'g' from part where p_size % 4 = 0
      union all select p_partkey, 1, 0, 0, cast(p_size as int), 'g' from part where p_size % 4 = 1)
    select gift_id, tier, amount, bonus_point, case when amount = 0 and bonus_point <> 0 then 'full point' when amount <> 0 and bonus_point = 0 then 'full cash' when amount <> 0 then 'point + cash' else '' end as redeem_method,
           case when min(amount) over w = 0 and min(bonus_point) over w = 0 then 'Points + Cash Only' when sum(amount) over w > 0 and sum(bonus_point) over w > 0 then 'Hybrid' when sum(amount) over w = 0 then 'Points Only' else 'Cash Only' end as redeem_method_combination,
           reward_brand_id from tiers window w as (partition by src, gift_id)""")
def _(t):
    return content.payment_tiers({"coupon_id": t.derived("src_coupon_json"), "gift_id": t.derived("src_gift_json")})


@check("mart_food_orders", f"""
    with {DIM}, o as (select *, nullif(regexp_extract(invoice_no, '^M([0-9]+)S([0-9]+)', 1), '') as ma, nullif(regexp_extract(invoice_no, '^M([0-9]+)S([0-9]+)', 2), '') as sh from src_food_order)
    select o.invoice_no, m.team, cast(ma as int) as mall_id, m.property_id, cast(sh as bigint) as shop_id, s.shop_name, s.lms_standard_brand_name, purchase_date + interval '8' hour as purchase_datetime, create_date + interval '8' hour as create_datetime,
           cast(purchase_date + interval '8' hour as date) as purchase_date, case when o.status = 0 then last_update_date end as cancel_datetime, o.status as order_status,
           case o.status when 0 then 'Cancelled Order' when 12 then 'Ready for Pickup' else '' end as order_status_detail, last_update_date + interval '8' hour as last_update_datetime, member_no as member_id, member_status_detail,
           cast(original_amount as double) as original_amount, cast(5 as double) as discount_amount, cast(sales_amount as double) as sales_amount, payment_status,
           case payment_status when -1 then 'Not Confirmed Status' when 1 then 'Payment Confirmed' else '' end as payment_status_detail, pay_method
    from o join dim d on member_no = d.member_id left join src_food_payment p on o.invoice_no = p.invoice_no left join src_mall m on cast(ma as int) = m.mall_id left join src_shop s on cast(sh as bigint) = s.mapping_shop_id""")
def _(t):
    out = feeds.food_orders(t.derived("src_food_order"), t.derived("src_food_payment"), t.derived("src_mall"), t.derived("src_shop"), member_dim(t))
    return out.withColumns(doubles("original_amount", "discount_amount", "sales_amount"))


HIDE = "case when {m} in (select member_id from src_hidden_member) and {c} is not null and length({c}) <> 64 then sha256(upper({c})) else {c} end"


@check("mart_charging_feed", f"""
    select rsr_id, status, createDttm as createdttm, externalMemberId as externalmemberid, {HIDE.format(m='externalMemberId', c='lp')} as lp, {HIDE.format(m='externalMemberId', c='lpin')} as lpin, {HIDE.format(m='externalMemberId', c='lpOut')} as lpout,
           cast(fee as double) as fee from src_session""")
def _(t):
    session = t.derived("src_session")
    root = t.scratch("sessions")  # yesterday's sessions arrive as JSON lines
    session.filter("createDttm >= '2024-01-29'").withColumn("day", F.date_format("createDttm", "yyyyMMdd")).write.option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").partitionBy("day").json(root)
    delta = readers.read_json(t.spark, f"{root}/day=*/*.json", session.schema)
    return feeds.charging_feed(session.filter("createDttm < '2024-01-29'"), delta, t.derived("src_hidden_member")).withColumns(doubles("fee"))


@check("mart_activity_history", "select event_id, user_id, action_type, '' as ip_address, case action_type when 1 then 'Login' when 2 then 'Change Status' when 3 then 'Change Password' when 4 then 'Forget Password' when 5 then 'Verified' when 6 then 'Register' when 7 then 'Reset Password' else '' end as action_type_detail from src_history_row")
def _(t):
    return feeds.activity_history(t.derived("src_history_row"))


@check("mart_autopay_members", "select id, memid as member_id, case when status_fa in (0, 1) then status_fa end as status_freeze_autopayment, case when status_fa in (0, 1) then 1 when status_fa = 2 then 0 end as status_enable_autopayment, case status_ps when 0 then 1 when 1 then 0 end as status_all_payment_settled from src_carpark_member")
def _(t):
    return feeds.autopay_members(t.derived("src_carpark_member"))


@check("mart_autopay_log", "select mem_id as member_id, case when action = 1 then 1 else -1 end as autopayment_activate, created_at from src_update_record where action in (1, 2)")
def _(t):
    return feeds.autopay_log(t.derived("src_update_record"))


@check("mart_autopay_transactions", f"""
    select id, carpark_id, member_id, {HIDE.format(m='member_id', c='car_plate')} as car_plate, case payment_type when 1 then 'Credit Card' when 2 then 'Mall Admin' when 3 then 'App' end as payment_type,
           case payment_result when 0 then 'Unpaid' when 1 then 'Success' when 2 then 'Freeze' when 3 then 'Pay Error' end as payment_result, mallid as mall_id from src_autopay_list left join src_carpark_list on carparkid = carpark_id""")
def _(t):
    return feeds.autopay_transactions(t.derived("src_autopay_list"), t.derived("src_carpark_list"), t.derived("src_hidden_member"))


@check("mart_vehicles", f"select {HIDE.format(m='memberId', c='trim(lpn)')} as lpn, memberId, validationsts from src_vehicle")
def _(t):
    return feeds.trimmed_plates(t.derived("src_vehicle"), t.derived("src_hidden_member"), "memberId")


@check("mart_partner_members", "select mapping_id, status, member_id from src_partner_mapping m left join src_phone p on m.phone = p.phone")
def _(t):
    return feeds.partner_members(t.derived("src_partner_mapping"), t.derived("src_phone"))


@check("mart_tagged_rewards", "select id, r.tag_id, name_lang1 from src_reward_tag r left join src_tag g on r.tag_id = g.tag_id")
def _(t):
    return feeds.tagged_rewards(t.derived("src_reward_tag"), t.derived("src_tag"))


@check("mart_sso_houses", """
    select mapping_id, s.app_id, '' as account_id, data, app_name, unnest(string_split(replace(coalesce(data, ''), ';', ''), ',')) as house from src_sso s left join src_application a on s.app_id = a.app_id""")
def _(t):
    return feeds.sso_houses(t.derived("src_sso"), t.derived("src_application"))


@check("mart_earn_transactions", "select id, datetime, case valid_to_earn_point when 'N' then 'Rejected' when 'W' then 'Approved' when 'P' then 'Partial Approved' end as valid_to_earn_point from src_earn where datetime >= timestamp '2024-01-10'")
def _(t):
    return feeds.earn_transactions(t.derived("src_earn"), since="2024-01-10")


@check("mart_device_changes", "select * from src_device where cast(created_date as date) = date '2024-01-15' or cast(updated_date as date) = date '2024-01-15'")
def _(t):
    return feeds.device_changes(t.derived("src_device"), as_of="2024-01-16")


@check("mart_member_profile", "select member_id, try_cast(visits as int) as visits, try_cast(spend as double) as spend, cast(replace(joined, '/', '-') as date) as joined from src_profile_text")
def _(t):
    return feeds.member_profile(t.derived("src_profile_text"), {"visits": "int", "spend": "double", "joined": "date"}, {"joined": "yyyy/MM/dd"})


def _log_parts(t: Tables, name: str):
    text_ = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias(name)
    return [text_, *[F.date_format("ts", f).alias(f"{name}_{p}") for p, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]]


@check("mart_tracking_log", """
    select event_id, event_type, date_trunc('second', ts) as log_date, cast(year(ts) as int) as log_date_year, cast(month(ts) as int) as log_date_month, cast(day(ts) as int) as log_date_day,
           year(ts) || '-' || month(ts) || '-' || day(ts) as partition_key from events where cast(ts as date) = date '2024-01-15'""")
def _(t):
    out = feeds.daily_log(t.events.select("event_id", "event_type", *_log_parts(t, "log_date")), feeds.TRACKING_LOG, day="2024-01-15")
    return out.withColumn("log_date", F.col("log_date").cast("timestamp_ntz"))


@check("mart_location_log", """
    select user_id, cast(event_id % 500 as int) as point_of_interest_radius, cast(cast(user_id as double) / 4 as float) as latitude, cast(-cast(user_id + 1 as double) / 8 as float) as longitude, date_trunc('second', ts) as visited_time,
           cast(year(ts) as int) as visited_time_year, cast(month(ts) as int) as visited_time_month, cast(day(ts) as int) as visited_time_day, year(ts) || '-' || month(ts) || '-' || day(ts) as partition_key
    from events where cast(ts as date) = date '2024-01-15'""")
def _(t):
    number = lambda c: c.cast("string")
    raw = t.events.select("user_id", number(F.col("event_id") % 500).alias("point_of_interest_radius"), number(F.col("user_id") / 4).alias("latitude"), number(-(F.col("user_id") + 1) / 8).alias("longitude"), *_log_parts(t, "visited_time"))
    return feeds.daily_log(raw, feeds.LOCATION_LOG, day="2024-01-15").withColumn("visited_time", F.col("visited_time").cast("timestamp_ntz"))


@check("mart_delivery_log", """
    select event_id as delivery_log_id, 'M' || user_id as member_id, date_trunc('second', ts) as event_date, cast(ts as date) as dt from events where cast(ts as date) = date '2024-01-15'""")
def _(t):
    raw = t.events.select(F.col("event_id").cast("string").alias("Delivery Log ID"), F.concat(F.lit("M"), "user_id").alias("Member ID"), F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("Event Date"))
    return feeds.delivery_log(raw, {"delivery_log_id": "bigint", "event_date": "timestamp"}, {"event_date": "dd/MM/yyyy HH:mm:ss"}, day="2024-01-15", ts="event_date")


BAD = "('Suspended', 'Invalid', 'Waiting for verification', 'Marked For Deletion')"


@check("mart_export_redemption", f"""
    with {DIM}, {CATEGORIES}, {REDEMPTION}
    select distinct transaction_id, redemption_status_detail, redeem_type, redeem_datetime, redeem_forfeit_datetime, collected_or_used_datetime, cancel_datetime, provider_mall_id as mall_id, m.property_id, a.member_id, item_type, a.gift_id,
           trim(case when n.new_gift_type is not null then nullif(n.new_gift_type, 'NULL') else nullif(a.gift_type, 'NULL') end) as gift_type, trim(case when n.new_sub_gift_type is not null then nullif(n.new_sub_gift_type, 'NULL') else nullif(a.sub_gift_type, 'NULL') end) as sub_gift_type,
           case when a.sub_gift_type = 'Point Dollar' then 'Point Dollar' else gift_name end as gift_name, gift_unit_cost,
           cast(replace(replace(v.face_value, 'HK$', ''), ',', '') as double) as gift_face_unit_value, gift_redeemed_in_mall_id, m2.property_id as gift_redeemed_in_property_id, 1 as redeemed_qty, redeemed_bonus_points, parking_redeem_hour,
           gift_used_in_mall_id, m3.property_id as gift_used_in_property_id, gift_used_in_shop_id, s.shop_name as gift_used_in_shop_name, s.lms_standard_brand_name as gift_used_in_lms_standard_brand_name
    from all_rows a left join dim d on a.member_id = d.member_id left join src_mall m on provider_mall_id = m.mall_id left join src_gift_new_category n on a.gift_id = n.gift_id left join src_shop s on a.gift_used_in_shop_id = s.mapping_shop_id
    left join src_gift_detail v on a.gift_id = v.gift_id left join src_mall m2 on gift_redeemed_in_mall_id = m2.mall_id left join src_mall m3 on gift_used_in_mall_id = m3.mall_id
    where a.member_id <> 'M21' and redeem_datetime >= timestamp '2000-08-01' and redemption_status_detail not in ('Cancelled Redemption', 'Point + Cash Auto Cancellation') and member_status_detail not in {BAD}
      and not (redeemed_tier is not distinct from 7 and item_type in ('Free Parking', 'Mall Gift')) and cast(redeem_datetime - interval '8' hour as date) < date '2001-08-01'
      and not (redeemed_bonus_points is not distinct from 0 and redeem_type is not distinct from 'Redeem by 0 point' and m.property_id is not distinct from 'P3')""")
def _(t):
    of = {"as_of": "2001-08-01", "cancelled": ["Cancelled Redemption", "Point + Cash Auto Cancellation"]}
    out = feeds.redemption_export(redemption_fact(t, keep=lambda rows: feeds.recent_redemptions(rows, **of)), **of, excluded=[(0, "Redeem by 0 point", "P3")])
    return out.withColumns(doubles("gift_unit_cost"))


COUNTABLE = f"receipt_transaction_date >= date '2000-08-01' and receipt_status_detail = 'Approved' and abnormal_case = 0 and member_status_detail not in {BAD} and team not in ('Partner') and receipt_upload_date < date '2001-08-01'"


@check("mart_export_spending", f"select receipt_id, replace(left(invoice_no, 30), '|', ' ') as invoice_no, receipt_transaction_date, member_id, shop_name, cast(receipt_amount as double) as receipt_amount from src_fact where {COUNTABLE}")
def _(t):
    return feeds.spending_export(t.derived("src_fact"), as_of="2001-08-01", invoice_width=30, columns=["receipt_id", "invoice_no", "receipt_transaction_date", "member_id", "shop_name", "receipt_amount"]).withColumns(doubles("receipt_amount"))


@check("mart_export_monthly_spending", f"""
    select *, row_number() over (order by year_id, month_id, member_id, property_id nulls first, lms_standard_trade_category, platform nulls first, partner nulls first) as spending_aggregate_id from (
      select strftime(receipt_transaction_date, '%Y') as year_id, strftime(receipt_transaction_date, '%m') as month_id, member_id, property_id, coalesce(lms_standard_trade_category, 'Others') as lms_standard_trade_category, platform, partner,
             cast(sum(receipt_amount) as double) as spending_amount, count(distinct receipt_id) as number_of_receipt from src_fact where {COUNTABLE} group by all) x""")
def _(t):
    return feeds.monthly_spending(t.derived("src_fact"), t.stage, as_of="2001-08-01").withColumns(doubles("spending_amount"))


@check("mart_export_points", f"""
    with {DIM}, {LEDGER}
    select distinct bonus_points_transaction_id, created_datetime, l.mall_id, m.property_id, l.member_id, bp_transaction_type, replace(bp_transaction_type_detail_1, '"', '') as bp_transaction_type_detail_1, replace(bp_transaction_type_detail_2, '"', '') as bp_transaction_type_detail_2,
           points, translate(remark, '|', ' ') as remark, expiry_date, updated_date
    from ledger l join dim d on l.member_id = d.member_id left join src_mall m on l.mall_id = m.mall_id where l.member_id <> 'M7' and created_datetime_before_launch = 0 and created_date >= date '2023-01-01' and member_status_detail not in {BAD}""")
def _(t):
    return feeds.points_export(ledger_fact(t), as_of="2024-01-31").distinct()


@check("mart_export_registration", """
    select 'M' || c_custkey as member_id, case when c_nationkey = 3 then 'NULL' else cast(c_nationkey as string) end as from_mall_id, 'web ' || c_mktsegment as channel, replace(c_name, '#', ' ') as link, c_mktsegment as source from customer""")
def _(t):
    registration = t.customer.select(
        F.concat(F.lit("M"), "c_custkey").alias("member_id"), F.when(F.col("c_nationkey") == 3, "__HIVE_DEFAULT_PARTITION__").otherwise(F.col("c_nationkey").cast("string")).alias("from_mall_id"),
        F.concat(F.lit("web|"), "c_mktsegment").alias("channel"), F.translate("c_name", "#", "|").alias("link"), F.col("c_mktsegment").alias("source"), F.lit(1).alias("internal"))
    return feeds.registration_export(registration, ["member_id", "from_mall_id", "channel", "link", "source"])


@check("mart_export_point_lots", "select event_id as member_mall_bonus_points_id, ts as created_date, user_id as member_id, value as bonus_points, event_type as type from events")
def _(t):
    lots = t.events.select(F.col("event_id").alias("member_mall_bonus_points_id"), F.col("ts").alias("created_date"), F.col("user_id").alias("member_id"), F.col("value").alias("bonus_points"), F.col("event_type").alias("type"), "props")
    return feeds.point_lot_export(lots, [c for c in feeds.POINT_LOT if c in lots.columns])


@check("mart_export_members", f"""
    with {DIM} select d.member_id, registration_date, coalesce(is_migrated_any, 0) as is_migrated_any, coalesce(is_migrated_p1, 0) as is_migrated_p1, case when registration_date < date '2019-01-20' then 1 else 0 end as registration_date_before_launch,
           case when registration_date < date '2019-01-20' then 1 else 0 end as is_staff, '' as phone from dim d left join src_migrated m on d.member_id = m.member_id where registration_date < date '2019-02-20'""")
def _(t):
    dim = member_dim(t).select("member_id", "registration_date")
    return feeds.member_export(dim, t.derived("src_migrated"), as_of="2019-02-20", launch="2019-01-20", flags=["is_migrated_any", "is_migrated_p1"])


@check("mart_export_spending_by_year", f"""
    select case when year(receipt_upload_date) < 2000 then 'before' else 'since' end as part, count(*) as n, cast(sum(receipt_amount) as double) as amount from src_fact
    where receipt_status_detail = 'Approved' and abnormal_case = 0 and member_status_detail not in {BAD} and receipt_transaction_date >= date '1996-01-01' and receipt_id not in (select receipt_id from src_pre_shoot)
      and (shop_id not in (select shop_id from src_abnormal_shop) or platform = 'api') group by 1""")
def _(t):
    before, since = feeds.spending_for_platform(t.derived("src_fact"), t.derived("src_pre_shoot"), t.derived("src_abnormal_shop"), since="1996-01-01", split_year=2000)
    tagged = [df.agg(F.count(F.lit(1)).alias("n"), F.sum("receipt_amount").cast("double").alias("amount")).withColumn("part", F.lit(p)) for p, df in (("before", before), ("since", since))]
    return tagged[0].unionByName(tagged[1])


@check("mart_fact_reenriched", f"""
    with {DIM} select distinct receipt_id, f.member_id, d.gender, d.age_group, s.shop_name from src_fact f left join dim d on f.member_id = d.member_id left join src_shop s on f.shop_id = s.mapping_shop_id""")
def _(t):
    path = t.scratch("fact-copy")
    t.derived("src_fact").select("receipt_id", "member_id", "shop_id", "gender", "age_group", "shop_name").write.parquet(path)
    copy = t.spark.read.parquet(path)
    out = feeds.reenriched(copy, ["gender", "age_group", "shop_name"], [(member_dim(t), {"member_id": "member_id"}, {"gender": "gender", "age_group": "age_group"}),
                                                                       (t.derived("src_shop"), {"mapping_shop_id": "shop_id"}, {"shop_name": "shop_name"})])
    return out.drop("shop_id")
