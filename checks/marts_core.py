"""Member, spending, point, redemption and inventory marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import Tables, check
from martkit.plans import inventory, member, points, redemption, spending

AGE = "case " + " ".join(f"when age between {a} and {b or 999} then '{n}'" for a, b, n in member.AGE_BANDS) + " end"
STATUS = "case status when 'W' then 'Waiting for verification' when 'A' then 'Active' when 'L' then 'Locked' when 'S' then 'Suspended' when 'V' then 'Invalid' when 'X' then 'Marked For Deletion' end"
MONTH = "case birth_mth " + " ".join(f"when {i} then '{m}'" for i, m in member.MONTHS.items()) + " end"
RESIDENCE = "case when city_lang1 like '%China%' or city_lang1 like '%Mainland%' then 'Mainland' else country_lang1 end"
# The member dimension, written independently of the builder.
DIM = f"""
    dim as (
      select m.member_id, l.name_lang1 as member_tier, {STATUS} as member_status_detail, registration_date as registration_datetime,
             cast(registration_date - interval '8' hour as date) as registration_date, update_date, phone_prefix as mobile_prefix,
             case when status = 'V' then null when title = 1 then 'Male' when title in (2, 3) then 'Female' else 'Unknown' end as gender,
             case when status = 'V' then null else case title when 1 then 'Mr.' when 2 then 'Mrs.' when 3 then 'Miss.' else 'Unknown' end end as title,
             case when status = 'V' or age > 99 then null else age end as age, case when status = 'V' or age > 99 then 'undefined' else {AGE} end as age_group,
             case when status = 'V' then null else {MONTH} end as birthday_month, {RESIDENCE} as residence, d.district_name as district, d.district_cs,
             case s.default_language when 1 then 'English' when 2 then 'Traditional Chinese' when 3 then 'Simplified Chinese' else 'Unknown' end as default_language, referrer,
             cast(s.receive_promotion_msg as smallint) as optin_msg, cast(s.receive_promotion_sms as smallint) as optin_sms, cast(s.receive_promotion_email as smallint) as optin_email,
             cast(s.receive_promotion_mail as smallint) as optin_mail, cast(s.receive_promotion_call as smallint) as optin_call
      from src_member m left join src_member_setting s on m.member_id = s.member_id left join src_member_profile p on m.member_id = p.member_id
      left join src_member_level l on p.member_level_id = l.member_level_id left join src_district d on m.district = d.district where m.member_id <> 'M13')"""


def member_dim(t: Tables):
    return member.member_dimension(t.derived("src_member"), t.derived("src_member_setting"), t.derived("src_member_profile"), t.derived("src_member_level"),
                                   t.derived("src_district"), exclude=["M13"])


@check("mart_member", f"with {DIM} select * from dim")
def _(t):
    return member_dim(t)


@check("mart_resident_group", f"""
    with {DIM}, names as (select distinct surname from src_surname)
    select dim.member_id, case when residence = 'Home SAR' and (default_language = 'Simplified Chinese' or mobile_prefix = '86' or first_name_lang1 in (select surname from names)
        or last_name_lang1 in (select surname from names)) then 'Home settled' when residence = 'Home SAR' then 'Home local' when residence in ('Macau', 'Taiwan', 'Undefined') then 'Others'
        when residence in ('China', 'Mainland') then 'Mainland tourist' else residence end as residence_group
    from dim join src_member m on dim.member_id = m.member_id""")
def _(t):
    return member.resident_group(member_dim(t), t.derived("src_member"), t.derived("src_surname"), home="Home SAR", settled="Home settled", local="Home local",
                                 grouped=["Macau", "Taiwan", "Undefined"])


LINES = """
    lines as (
      select receipt_id, invoice_no, case r.status when 'A' then 'Approved' when 'R' then 'Rejected' when 'W' then 'Waiting for Approval' when 'V' then 'Invalid' end as receipt_status_detail,
             created_by, created_date as receipt_upload_datetime, cast(created_date - interval '8' hour as date) as receipt_upload_date, receipt_datetime as receipt_transaction_datetime,
             cast(receipt_date as date) as receipt_transaction_date, r.spending_transaction_id, case when r.status in ('A', 'R') then updated_by end as approve_or_reject_by,
             approval_date as approve_or_reject_datetime, cast(approval_date - interval '8' hour as date) as approve_or_reject_date, reject_reason_lang1 as reject_reason,
             case type when 'B' then 'Spending to Earn Point' when 'G' then 'Spending to Redeem Gift' when 'S' then 'Spending to Redeem Gift' end as receipt_type_detail,
             r.mall_id, m.property_id, m.team, member_id, shop_id, case payment_type_lang1 when 'BoC Pay' then 'Boc Pay' when 'UnionPay' then 'Union Pay' when 'Visa' then 'VISA' else payment_type_lang1 end as payment_type,
             original_amount as receipt_amount, case when original_amount < earned_points then original_amount when earned_points is null then 0 else earned_points end as earned_points,
             case when receipt_id in (select value from src_abnormal) then 1 else 0 end as abnormal_case, r.updated_date, platform,
             case when platform = 'api' then channel else p.name_lang1 end as partner, auto_approved as ocr_auto_approved, ocr_id
      from src_receipt r join src_transaction t on r.spending_transaction_id = t.spending_transaction_id
      left join (select result, name_lang1 from src_partner_link k join src_partner q on k.partner_id = q.partner_id where success = 1) p on p.result = r.spending_transaction_id
      left join src_mall m on r.mall_id = m.mall_id where member_id <> 'M13')"""
FACT = f"""{DIM}, {LINES},
    fact as (
      select l.* replace (case when receipt_transaction_date < date '2001-05-03' then 'frozen' else platform end as platform), member_status_detail, registration_date, gender, age, age_group,
             residence, d.district, d.district_cs, member_tier, shop_name, lms_agreement_no, lms_trade_name, lms_standard_brand_name, lms_standard_trade_category, lms_standard_group,
             cast(lms_charge_area as string) as lms_charge_area, receipt_transaction_date as partition_day
      from lines l left join dim d on l.member_id = d.member_id left join src_shop s on l.shop_id = s.mapping_shop_id)"""


def doubles(*names):
    """Decimal amounts as doubles, the type the comparison uses."""
    return {n: F.col(n).cast("double") for n in names}


AMOUNTS_SQL = "replace (cast(receipt_amount as double) as receipt_amount, cast(earned_points as double) as earned_points)"


def lines(t: Tables, attributes=None, food_orders=None):
    partners = spending.partner_names(t.derived("src_partner_link"), t.derived("src_partner"))
    return spending.spending_lines(t.derived("src_receipt"), t.derived("src_transaction"), partners, t.derived("src_mall"), t.derived("src_abnormal"), exclude_members=["M13"],
                                   attributes=attributes, food_orders=food_orders)


def spending_fact(t: Tables, attributed: bool = False):
    """The spending fact; the frozen history is the same lines marked in their platform."""
    dims = (member.slim(member_dim(t)), t.derived("src_shop"))
    delta = lines(t, dims if attributed else None)
    history = delta.withColumn("platform", F.lit("frozen"))
    return spending.spending_fact(delta, history, *dims, cut="2001-05-03", attributed=attributed)


@check("mart_spending", f"with {FACT} select * {AMOUNTS_SQL} from fact")
def _(t):
    return spending_fact(t, attributed=True).withColumns(doubles("receipt_amount", "earned_points"))


@check("mart_spending_split", f"""
    with {FACT} select case when mall_id in (24) then 'partner' else 'mall' end as sink, count(*) as n, cast(sum(receipt_amount) as double) as amount from fact group by 1""")
def _(t):
    mall, partner = spending.split_partner(spending_fact(t), [24])
    tagged = [df.groupBy(F.lit(n).alias("sink")).agg(F.count(F.lit(1)).alias("n"), F.sum("receipt_amount").cast("double").alias("amount")) for n, df in (("mall", mall), ("partner", partner))]
    return tagged[0].unionByName(tagged[1])


POINTS = """
    pts as (
      select r.receipt_id, r.spending_transaction_id, case when t.earned_points - coalesce(prior, 0) > amount then amount when t.earned_points - coalesce(prior, 0) > 0 then t.earned_points - coalesce(prior, 0)
        else 0 end as earned_points from (select receipt_id, spending_transaction_id, amount, sum(amount) over (partition by spending_transaction_id order by receipt_id range between unbounded preceding and current row exclude group) as prior
        from src_receipt) r left join src_transaction t on r.spending_transaction_id = t.spending_transaction_id)"""


@check("mart_allocated_points", f"with {POINTS} select receipt_id, spending_transaction_id, cast(earned_points as double) as earned_points from pts")
def _(t):
    out = spending.allocated_points(t.derived("src_receipt"), t.derived("src_transaction"), block=100)
    return out.withColumn("earned_points", F.col("earned_points").cast("double"))


@check("mart_spending_full_variant", f"""
    with {LINES}, {POINTS}
    select distinct l.receipt_id, invoice_no, receipt_status_detail, member_id, platform, partner, cast(coalesce(c.correct_receipt_amount, receipt_amount) as double) as receipt_amount,
           cast(pts.earned_points as double) as earned_points, case when d.receipt_id is not null then 1 else abnormal_case end as abnormal_case
    from lines l left join pts on l.receipt_id = pts.receipt_id left join src_corrected c on l.receipt_id = c.receipt_id left join src_duplicate d on l.receipt_id = d.receipt_id
    where invoice_no not in (select invoice_no from src_food_header where payment_status = 0 or order_status not in (2, 12, 99) or member_status_detail is null)""")
def _(t):
    pts = spending.allocated_points(t.derived("src_receipt"), t.derived("src_transaction"), block=100)
    kept = ["receipt_id", "invoice_no", "receipt_status_detail", "member_id", "platform", "partner", "abnormal_case"]
    wanted = lines(t, food_orders=spending.inactive_food_orders(t.derived("src_food_header")))
    out = spending.spending_fact_full(wanted, pts, t.derived("src_corrected"), t.derived("src_duplicate"), columns=[*kept, "receipt_amount", "earned_points"])
    return out.select(*kept, *[c.alias(n) for n, c in doubles("receipt_amount", "earned_points").items()])


ACTION = "case action " + " ".join(f"when '{k}' then '{v}'" for k, v in points.ACTIONS.items()) + " end"
LEDGER = f"""
    offer as (
      select event_id as id, cast(user_id as string) as object_id, ' Offer ' || (user_id % 10) || ' ' as name_lang1 from events where event_type = 'view'
      union all select event_id, cast(user_id as string), null from events where event_type = 'purchase'
      union all select event_id, cast(user_id + 1000 as string), 'Two' from events where event_type = 'purchase'),
    expiry as (
      select e.member_mall_bonus_points_id as id, updated_date, case when from_expiry_date is distinct from to_expiry_date then to_expiry_date
        when year(expiry_date) < 1970 then timestamp '1970-01-01 23:59:59' else expiry_date end as expiry_date
      from src_expiry e left join src_expiry_map m on e.member_mall_bonus_points_id = m.from_member_mall_bonus_points_id),
    ledger as (
      select distinct bonus_points_transaction_id, p.created_by, p.created_date as created_datetime, cast(p.created_date - interval '8' hour as date) as created_date, points, upper(p.member_id) as member_id,
             spending_transaction_id, redemption_transaction_id, replace(remark, chr(10), '') as remark, action as bp_transaction_type, {ACTION} as bp_transaction_type_detail_1,
             trim(case action when 'A' then adjust_reason_lang1 when 'D' then o.name_lang1 end) as bp_transaction_type_detail_2, x.expiry_date, 0 as abnormal_case,
             case when p.created_date < timestamp '2024-01-05 14:00:00' or (p.created_date = timestamp '2024-01-06' and action = 'A' and remark = 'Clean-up adjustment') then 1 else 0 end as created_datetime_before_launch,
             case when action in ('G', 'R') then g.mall_id when action = 'C' then c.mall_id else p.mall_id end as mall_id, campaign_id, x.updated_date
      from src_points p left join offer o on p.bonus_points_transaction_id = o.id left join expiry x on p.member_mall_bonus_points_id = x.id
      left join src_gift g on o.object_id = g.gift_id left join src_coupon c on o.object_id = c.coupon_id)"""


def ledger_lines(t: Tables):
    expiry = points.expiry_dates(t.derived("src_expiry"), t.derived("src_expiry_map"))
    return points.ledger_lines(t.derived("src_points"), expiry, t.derived("src_gift"), t.derived("src_coupon"), t.derived("src_mall"), launch=datetime(2024, 1, 5, 14),
                               cleanup=datetime(2024, 1, 6), cleanup_remark="Clean-up adjustment")


def ledger_fact(t: Tables):
    delta = ledger_lines(t)
    return points.ledger_fact(delta, delta.withColumn("campaign_id", F.lit("frozen")), member.slim(member_dim(t)), cut="2024-01-11", staff_before="2019-01-03", exclude_members=["M7"])


@check("mart_point_ledger", f"""
    with {DIM}, {LEDGER}
    select distinct l.* replace (case when created_date < date '2024-01-11' then 'frozen' else campaign_id end as campaign_id), m.property_id, age, age_group, residence, d.district, member_tier, member_status_detail, gender,
           case when registration_date < date '2019-01-03' then 1 else 0 end as is_staff
    from ledger l join dim d on l.member_id = d.member_id left join src_mall m on l.mall_id = m.mall_id where l.member_id <> 'M7'""")
def _(t):
    return ledger_fact(t)


CATEGORIES = """
    tops as (
      select category_id, name from src_category where parent_id is null or parent_id = category_id
      union all select c.category_id, p.name from src_category c left join src_category p on c.parent_id = p.category_id where c.parent_id is not null and c.parent_id <> c.category_id and p.parent_id is null),
    cats as (select c.category_id, tops.name as gift_type, c.name as sub_gift_type from src_category c left join tops on c.category_id = tops.category_id)"""
REDEEM_TYPE = "case when {k} = 'S' then 'Redeem by receipt' when {k} = 'B' and {p} = 0 then 'Redeem by 0 point' when {k} = 'B' then 'Redeem by bonus point' when {k} = 'N' then 'point + cash type' end"
EV = "'Redeem for the EV charging fee'"
REDEMPTION = f"""
    all_rows as (
      select gift_redemption_transaction_id as transaction_id, case r.status when 'P' then 'Redeemed but not yet collected Mall Gift' when 'R' then 'Redeemed and collected Mall Gift' when 'C' then 'Cancelled Redemption'
               when 'F' then 'Redeemed but forfeited Mall Gift' when 'L' then 'Point + Cash Auto Cancellation' end as redemption_status_detail,
             {REDEEM_TYPE.format(k='redeem_type', p='redeemed_bonus_points')} as redeem_type, reserve_datetime as redeem_datetime, r.reserve_expiry_date as redeem_forfeit_datetime, redeem_datetime as collected_or_used_datetime,
             cancel_datetime, g.mall_id as provider_mall_id, member_id, case when extra_function = 'C' then 'Free Parking' else 'Mall Gift' end as item_type, r.gift_id, gift_type, sub_gift_type, g.name_lang1 as gift_name,
             cast(g.value_amount as double) as gift_unit_cost, r.mall_id as gift_redeemed_in_mall_id, redeemed_tier, redeemed_bonus_points, cast(redeemed_amount as double) as redeemed_amount, payment_transaction_id,
             car_park_redeem_hours as parking_redeem_hour, cast(null as double) as linked_spend, cast(null as int) as gift_used_in_mall_id, cast(null as bigint) as gift_used_in_shop_id, cast(null as string) as gift_used_ref_code, updated_date
      from src_gift_redemption r left join src_gift g on r.gift_id = g.gift_id left join cats on g.gift_category_id = cats.category_id
      union all
      select coupon_redemption_transaction_id, case r.status when 'R' then 'Redeemed but not yet used Shop Gift' when 'U' then 'Redeemed and used Shop Gift' when 'C' then 'Cancelled Redemption'
               when 'E' then 'Redeemed but forfeited Shop Gift' when 'W' then 'Point + Cash Waiting for Payment' end,
             {REDEEM_TYPE.format(k='redeem_type', p='redeem_bonus_points')}, redeem_datetime, expiry_date, used_datetime, cancel_datetime, g.mall_id, member_id,
             case when g.name_lang1 like '%Mall e-Certificate%' and g.mall_id = 0 then 'Mall e-Certificate' else 'Shop Gift' end, r.coupon_id, gift_type, sub_gift_type, g.name_lang1, cast(g.value_amount as double), r.mall_id,
             redeemed_tier, redeem_bonus_points, cast(redeemed_amount as double), payment_transaction_id, null, null, used_mall_id, used_shop_id, ref_code, updated_date
      from src_coupon_redemption r left join src_coupon g on r.coupon_id = g.coupon_id left join cats on g.coupon_category_id = cats.category_id
      union all
      select x.trans_id, case when f.trans_date is null then 'Used Point Dollar for Spending' else 'Refunded Point Dollar Transaction' end, 'Point Dollar', p.trans_date, null, p.trans_date, f.trans_date, 0, x.member_id, 'Point Dollar',
             x.point_dollar_transaction_id, 'Point Dollar', 'Point Dollar', null, cast(p.amount as double), p.mall_id, null, x.points * -1, 0, null, null, cast(p.total_amount as double), p.mall_id, p.shop_id, null, x.updated_date
      from src_pd_exchange x join src_pd p on x.point_dollar_transaction_id = p.trans_id and p.trans_type = 'P'
      left join (select r.ori_trans_id, r.trans_date from src_pd r join src_pd_exchange y on y.point_dollar_transaction_id = r.trans_id where r.trans_type = 'R') f on x.point_dollar_transaction_id = f.ori_trans_id
      union all
      select cast(bonus_points_transaction_id as string), {EV}, 'Redeem by bonus point', created_datetime + interval '8' hour, null, created_datetime + interval '8' hour, null, cast(mall_id as int), member_id, {EV}, {EV}, {EV}, {EV}, {EV}, 0,
             cast(mall_id as int), null, cast(total as bigint) * -1, 0, null, null, null, cast(mall_id as int), null, null, updated_date + interval '8' hour
      from (select *, rank() over (partition by member_id, mall_id, cast(created_datetime as date) order by created_datetime, bonus_points_transaction_id) as r,
              sum(case when points < 0 then points end) over (partition by member_id, mall_id, cast(created_datetime as date)) as total from src_charging) c where r = 1 and points < 0)"""


def redemption_fact(t: Tables, keep=None):
    """The redemption fact, or the rows of it that ``keep`` leaves."""
    cats = redemption.category_names(t.derived("src_category"), "category_id", "parent_id", "name")
    lookups = redemption.gift_lookups(t.derived("src_gift_brand"), t.derived("src_gift_new_category"), t.derived("src_gift_detail"))
    parts = [redemption.gift_rows(t.derived("src_gift_redemption"), t.derived("src_gift"), cats, lookups),
             redemption.coupon_rows(t.derived("src_coupon_redemption"), t.derived("src_coupon"), cats, certificate="Mall e-Certificate", lookups=lookups),
             redemption.point_dollar_rows(t.derived("src_pd_exchange"), t.derived("src_pd"), lookups), redemption.charging_rows(t.derived("src_charging"), lookups=lookups)]
    abnormal = t.derived("src_gift_redemption").filter("redeemed_tier = 7").select(F.col("gift_redemption_transaction_id").alias("value"))
    rows = None if keep else sum(t.derived(n).count() for n in ("src_gift_redemption", "src_coupon_redemption", "src_pd_exchange", "src_charging"))
    return redemption.redemption_fact(parts, member.slim(member_dim(t)), t.derived("src_mall"), t.derived("src_shop"), abnormal, staff_until="2019-01-03", exclude_members=["M21"],
                                      rows=rows, keep=keep)


@check("mart_redemption", f"""
    with {DIM}, {CATEGORIES}, {REDEMPTION}
    select distinct a.* replace (trim(case when n.new_gift_type is not null then nullif(n.new_gift_type, 'NULL') else nullif(a.gift_type, 'NULL') end) as gift_type,
             trim(case when n.new_sub_gift_type is not null then nullif(n.new_sub_gift_type, 'NULL') else nullif(a.sub_gift_type, 'NULL') end) as sub_gift_type),
           member_status_detail, gender, age, age_group, residence, d.district, member_tier, reward_brand_id, reward_brand_name, v.trade_category as gift_trade_category, s.shop_name as gift_used_in_shop_name,
           s.lms_standard_brand_name as gift_used_in_brand_name, m1.property_id as provider_property_id, m2.property_id as gift_redeemed_in_property_id, m3.property_id as gift_used_in_property_id,
           case when redeemed_tier = 7 and item_type in ('Free Parking', 'Mall Gift') then 1 else 0 end as abnormal_case, case when registration_date <= date '2019-01-03' then 1 else 0 end as is_staff,
           cast(redeem_datetime - interval '8' hour as date) as redeem_date, cast(redeem_datetime - interval '8' hour as date) as partition_day,
           case when isodow(redeem_datetime - interval '8' hour) <= 5 then 'Weekday' else 'Weekend' end as redeem_weekday_kind,
           cast(replace(replace(v.face_value, 'HK$', ''), ',', '') as double) as gift_face_unit_value,
           case when redeem_type = 'Point Dollar' then 'Point Dollar' when redeem_type = 'Redeem by bonus point' then 'Full Point' when redeem_type = 'Redeem by receipt' then 'Full Spending'
             when redeem_type = 'Redeem by 0 point' then redeem_type when redeem_type = 'point + cash type' and redeemed_amount = 0 then 'Full Point'
             when redeem_type = 'point + cash type' and redeemed_bonus_points = 0 then 'Full Cash' when redeem_type = 'point + cash type' then 'Point + Cash' end as redeem_method
    from all_rows a left join dim d on a.member_id = d.member_id left join src_gift_brand b on a.gift_id = b.gift_id left join src_gift_new_category n on a.gift_id = n.gift_id
    left join src_gift_detail v on a.gift_id = v.gift_id left join src_shop s on a.gift_used_in_shop_id = s.mapping_shop_id left join src_mall m1 on provider_mall_id = m1.mall_id
    left join src_mall m2 on gift_redeemed_in_mall_id = m2.mall_id left join src_mall m3 on gift_used_in_mall_id = m3.mall_id where a.member_id <> 'M21'""")
def _(t):
    return redemption_fact(t).withColumns(doubles("gift_unit_cost", "redeemed_amount", "linked_spend"))


def stock_sql(redemptions, item, tx, used):
    return f"""select {item} as item_id, mall_id, count(distinct {tx}) as redeemed_qty, count(distinct case when status = '{used}' then {tx} end) as used_qty,
        count(case when redeem_datetime >= timestamp '2001-08-01' then {tx} end) as mtd_redeemed_qty from {redemptions} where status not in ('C', 'L') group by 1, 2"""


POSITION = """
      select c.item_id as gift_id, m.team, m.property_id, c.item_type, c.status as gift_status, case c.status when 'A' then 'Active' when 'I' then 'Inactive' when 'V' then 'Invalid' end as gift_status_detail,
             c.created_date as created_datetime, strftime(c.created_date, '%Y%m') as created_datetime_yearmonth, c.name as name_en, gift_type, sub_gift_type, cast(c.unit_cost as double) as gift_unit_cost,
             case when year(try_cast(q.start_date as date)) < 2019 then null else try_cast(q.start_date as date) end as redemption_date_start,
             case when year(try_cast(q.end_date as date)) < 2019 then null else try_cast(q.end_date as date) end as redemption_date_end, c.redeem_type, c.required_points as required_redeem_bonus_point,
             coalesce(c.required_spending, q.min_matched_receipt_total_amount) as required_redeem_spending, q.frequency_type as redemption_limit_type, q.value as redemption_limit_qty,
             case when year(c.expiry_date) < 2019 then null else cast(c.expiry_date as date) end as reserve_expiry_date, c.expiry_day as reserve_expiry_day,
             case c.unlimited_inventory when 0 then 'Limited Inventory' when 1 then 'Unlimited Inventory' end as inventory_type, k.property_id as stock_at_property_id,
             cast(coalesce(s.original_stock_level, 0) as bigint) as original_stock_level, cast(coalesce(s.stock_level, 0) as bigint) as physical_stock_level, coalesce(v.redeemed_qty, 0) as redeemed_stock_level,
             coalesce(v.used_qty, 0) as collected_or_used_stock_level, coalesce(s.original_stock_level, 0) - coalesce(v.redeemed_qty, 0) as stock_level_available_for_redemption,
             coalesce(v.mtd_redeemed_qty, 0) as mtd_redeemed_stock_level
      from {items} c join src_mall m on c.mall_id = m.mall_id left join cats on c.category_id = cats.category_id left join src_condition q on q.parent_id = c.item_id left join src_stock s on s.parent_id = c.item_id
      left join src_mall k on s.mall_id = k.mall_id left join {moves} v on v.item_id = c.item_id and v.mall_id = s.mall_id"""
INVENTORY = f"""
    gift_moves as ({stock_sql('src_gift_redemption', 'gift_id', 'gift_redemption_transaction_id', 'R')}),
    coupon_moves as ({stock_sql('src_coupon_redemption', 'coupon_id', 'coupon_redemption_transaction_id', 'U')}),
    gift_items as (select gift_id as item_id, mall_id, gift_category_id as category_id, case when extra_function = 'C' then 'Free Parking' else 'Mall Gift' end as item_type, status, created_date, name_lang1 as name,
      value_amount as unit_cost, {REDEEM_TYPE.format(k='type', p='bonus_point_1')} as redeem_type, cast(bonus_point_1 as double) as required_points,
      case when extra_function = 'C' then car_park_min_spending_amount end as required_spending, unlimited_inventory, reserve_expiry_date as expiry_date, reserve_expiry_day as expiry_day from src_gift),
    coupon_items as (select c.coupon_id as item_id, mall_id, coupon_category_id as category_id, case when name_lang1 like '%Mall e-Certificate%' then 'Mall e-Certificate' else 'Shop Gift' end as item_type, status, created_date,
      name_lang1 as name, value_amount as unit_cost, {REDEEM_TYPE.format(k='type', p="cast(replace(bonus_point, ',', '') as double)")} as redeem_type, cast(replace(bonus_point, ',', '') as double) as required_points,
      cast(null as int) as required_spending, unlimited_inventory, usage_expiry_date as expiry_date, usage_expiry_day as expiry_day from src_coupon c join src_coupon_redeem r on c.coupon_id = r.coupon_id),
    pos as ({POSITION.format(items='gift_items', moves='gift_moves')} union all {POSITION.format(items='coupon_items', moves='coupon_moves')})"""


@check("mart_gift_inventory", f"""
    with {CATEGORIES}, {INVENTORY}
    select distinct p.* replace (case when lower(trim(coalesce(n.new_gift_type, p.gift_type))) in ('null', '') then null else trim(coalesce(n.new_gift_type, p.gift_type)) end as gift_type,
             case when lower(trim(coalesce(n.new_sub_gift_type, p.sub_gift_type))) in ('null', '') then null else trim(coalesce(n.new_sub_gift_type, p.sub_gift_type)) end as sub_gift_type),
           show_in_api, reward_brand_id, upper(reward_brand_id) as reward_brand_name, redeem_method_combination, case when exists (select 1 from src_condition q where q.parent_id = p.gift_id and condition_type = 132) then 1 else 0 end as selected_member
    from pos p left join src_api_flag a on p.gift_id = a.gift_id left join src_gift_brand b on p.gift_id = b.gift_id left join src_gift_new_category n on p.gift_id = n.gift_id""")
def _(t):
    cats = redemption.category_names(t.derived("src_category"), "category_id", "parent_id", "name")
    mall, cond, stock = t.derived("src_mall"), t.derived("src_condition"), t.derived("src_stock")
    gifts = inventory.positions(inventory.gift_content_items(t.derived("src_gift")), cats, cond, stock, mall, inventory.movements(
        t.derived("src_gift_redemption"), "gift_id", "gift_redemption_transaction_id", ["R"], "2001-08-01"))
    coupons = inventory.positions(inventory.coupon_content_items(t.derived("src_coupon"), t.derived("src_coupon_redeem"), certificate="Mall e-Certificate"), cats, cond, stock, mall,
                                  inventory.movements(t.derived("src_coupon_redemption"), "coupon_id", "coupon_redemption_transaction_id", ["U"], "2001-08-01"))
    brands = t.part.select(F.col("p_brand").alias("brand_id"), F.upper("p_brand").alias("brand_name")).distinct()
    out = inventory.gift_inventory([gifts, coupons], t.derived("src_gift_new_category"), t.derived("src_api_flag"), t.derived("src_gift_brand"), brands, cond)
    return out.withColumn("gift_unit_cost", F.col("gift_unit_cost").cast("double"))
