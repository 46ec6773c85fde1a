"""Segment, campaign, sales and shop marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.marts_core import doubles
from checks.registry import Tables, check
from martkit.plans import campaign, sales, segments, shop

GOOD = "receipt_status_detail = 'Approved' and member_status_detail not in ('Suspended', 'Invalid', 'Waiting for verification') and abnormal_case = 0"


def good_fact(t: Tables):
    return t.derived("src_fact").filter(GOOD)


BUYER_RULES = segments.SegmentRules(
    criteria=(segments.Criterion(9000.0, 1), segments.Criterion(4000.0, {"SMALL": 3, "*": 2})), merged={"ECONOMY": "STANDARD"}, excluded=("PROMO",), amount_share=0.3, visit_share=0.3, floor_months=2)


def buyers_sql(per_month: float, visits: str) -> str:
    return f"""
      select member_id from (
        select c.*, t.*, greatest(round(datediff('month', t.f, date '2001-07-31') + case when t.f = last_day(t.f) then 0 else (31 - day(t.f)) / 31.0 end), 2) as m from
          (select member_id, cat, sum(receipt_amount) as ca, count(*) as cv from base group by 1, 2) c
          join (select member_id as mid, sum(receipt_amount) as ta, count(*) as tv, min(receipt_transaction_date) as f from base group by 1) t on member_id = mid) x
      where cat not in ('PROMO') and ca >= 0.3 * ta and cv >= m * ({visits}) and cv >= 0.3 * tv and ta >= m * {per_month}"""


BUYERS = f"""
    fact as (select *, case when lms_standard_trade_category = 'ECONOMY' then 'STANDARD' else lms_standard_trade_category end as cat from src_fact where {GOOD}),
    base as (select * from fact where receipt_transaction_date between date '2000-08-01' and date '2001-07-31'),
    now as ({buyers_sql(9000, '1')} union {buyers_sql(4000, "case when cat = 'SMALL' then 3 else 2 end")}),
    listed as (select 'M' || (s_suppkey * 3) as member_id, date '2000-12-31' as period from supplier where s_nationkey < 6 union select member_id, date '2001-07-31' from now)"""


def buyers(t: Tables):
    previous = t.supplier.filter("s_nationkey < 6").select(F.concat(F.lit("M"), F.col("s_suppkey") * 3).alias("member_id"), F.lit("2000-12-31").alias("period"))
    return segments.buyer_list(previous, segments.monthly_buyers(good_fact(t), BUYER_RULES, as_of="2001-08-15"))


@check("mart_buyer_list", f"with {BUYERS} select * from listed")
def _(t):
    return buyers(t)


@check("mart_buyer_types", f"""
    with {BUYERS}
    select member_id, period, cat as buyer_type from (
      select f.member_id, p.period, cat, row_number() over (partition by f.member_id order by sum(receipt_amount) desc, cat) as r
      from fact f join (select member_id, min(period) as period from listed group by 1) p on f.member_id = p.member_id and receipt_transaction_date between period - 365 and period group by 1, 2, 3) x where r = 1""")
def _(t):
    return segments.buyer_types(buyers(t), good_fact(t), BUYER_RULES)


MECH = """
    mech as (
      select t.spending_campaign_id, t.tier_id, tier_order as campaign_tier, redeem_amount, reward_id, qty as coupon_qty, c.status as campaign_status, start_date as campaign_start_date, end_date as campaign_end_date,
             name_lang1 as campaign_name, type as campaign_type, condition_id as campaign_condition_id, ownership as campaign_owner,
             case when cast(start_date as date) <= date '2001-07-31' and end_date >= timestamp '2001-05-03' then 1 else 0 end as display_in_transaction
      from src_tier t left join src_tier_reward r on t.tier_id = r.tier_id left join src_campaign c on t.spending_campaign_id = c.spending_campaign_id left join src_owner o on t.spending_campaign_id = o.spending_campaign_id)"""


def mechanism(t: Tables):
    return campaign.mechanisms(t.derived("src_tier"), t.derived("src_tier_reward"), t.derived("src_campaign"), t.derived("src_owner"), as_of="2001-08-01")


@check("mart_campaign_mechanisms", f"with {MECH} select * from mech")
def _(t):
    return mechanism(t)


LINKED = f"""{MECH},
    sel as (select distinct * from mech where display_in_transaction = 1),
    sp as (select * replace (replace(lower(regexp_replace(invoice_no, '[^0-9A-Za-z]', '', 'g')), 'r', '') as invoice_no) from src_cspend),
    cond as (select c.condition_id, c.min_receipt_amount, m.mall_id, p.payment_method, s.shop_id from src_spend_condition c left join src_condition_mall m on c.condition_id = m.condition_id
      left join src_condition_payment p on c.condition_id = p.condition_id left join src_condition_shop s on c.condition_id = s.condition_id),
    conv as (
      select distinct id, member_id, c.spending_campaign_id, c.tier_id, redemption_date as redemption_datetime, cast(redemption_date - interval '8' hour as date) as redemption_date, mall_id, created_date as created_datetime,
             cast(created_date - interval '8' hour as date) as created_date, campaign_condition_id from src_conversion c join sel on c.spending_campaign_id = sel.spending_campaign_id and c.tier_id = sel.tier_id),
    direct as (
      select distinct receipt_id, sp.member_id, sp.mall_id as spending_mall_id, receipt_transaction_date as spending_transaction_date, sp.shop_id as spending_shop_id, payment_type as spending_payment_type, receipt_amount,
             spending_campaign_id, tier_id, redemption_date, conv.mall_id as redemption_mall_id, campaign_condition_id
      from sp join conv on sp.member_id = conv.member_id and receipt_upload_date = conv.created_date and receipt_upload_datetime between created_datetime - interval '19' second and created_datetime + interval '10' second
      join cond on condition_id = campaign_condition_id and (cond.mall_id is null or cond.mall_id = sp.mall_id) and (payment_method is null or payment_method = payment_type) and (cond.shop_id is null or cond.shop_id = sp.shop_id)
        and (min_receipt_amount is null or receipt_amount >= min_receipt_amount) where platform = 'counter'),
    cp as (
      select k.*, cast(coupon_redeem_datetime - interval '8' hour as date) as coupon_redeem_date, cast(coupon_used_datetime - interval '8' hour as date) as coupon_used_date,
             case when min_spending_amount - coupon_value_amount <= 0 then 0 else min_spending_amount - coupon_value_amount end as min_top_up_amount from src_ccoupon k),
    given as (
      select distinct cp.*, sel.spending_campaign_id, sel.tier_id, sel.campaign_tier from cp join sel on coupon_id = reward_id join conv on redeem_coupon_member_id = member_id and sel.spending_campaign_id = conv.spending_campaign_id
        and sel.tier_id = conv.tier_id and coupon_redeem_datetime between redemption_datetime - interval '2' second and redemption_datetime + interval '2' second and coupon_redeemed_mall_id = conv.mall_id
      where coupon_redeem_date < date '1998-06-01'
      union select distinct cp.*, sel.spending_campaign_id, sel.tier_id, sel.campaign_tier from cp join src_ccoupon_map m on coupon_redemption_transaction_id = redemption_transaction_id join conv on m.id = conv.id
        join sel on conv.tier_id = sel.tier_id where coupon_redeem_date >= date '1998-06-01'),
    fk as (select distinct member_id, spending_mall_id, spending_transaction_date, spending_campaign_id, tier_id, redemption_date, redemption_mall_id from direct),
    raw as (
      select distinct sp.*, fk.spending_campaign_id, fk.tier_id, fk.redemption_date, fk.redemption_mall_id, case when d.receipt_id is not null then 'First Direct Spend'
        when g.tier_id is not null and receipt_upload_date = receipt_transaction_date then 'Second Direct Spend' else 'First Indirect Spend' end as linked_spend_type
      from sp join fk on sp.member_id = fk.member_id and sp.mall_id = spending_mall_id and receipt_transaction_date = spending_transaction_date
      left join direct d on sp.receipt_id = d.receipt_id and fk.spending_campaign_id = d.spending_campaign_id and fk.tier_id = d.tier_id and fk.redemption_date = d.redemption_date and fk.redemption_mall_id = d.redemption_mall_id
      left join (select * from given where coupon_used_date = coupon_redeem_date) g on fk.spending_campaign_id = g.spending_campaign_id and fk.tier_id = g.tier_id and fk.redemption_date = coupon_redeem_date
        and fk.redemption_mall_id = coupon_redeemed_mall_id and sp.member_id = redeem_coupon_member_id and sp.shop_id = coupon_used_in_shop_id
      union
      select sp.*, l.spending_campaign_id, l.tier_id, l.coupon_redeem_date, l.coupon_redeemed_mall_id, case when k.tier_id is not null then 'Second Direct Spend' else 'Second Indirect Spend' end
      from sp join (select * from given where coupon_used_date <> coupon_redeem_date) l on sp.member_id = l.redeem_coupon_member_id and sp.mall_id = l.coupon_used_in_mall_id and receipt_transaction_date = l.coupon_used_date
      left join (select * from given where coupon_used_date <> coupon_redeem_date) k on sp.member_id = k.redeem_coupon_member_id and sp.shop_id = k.coupon_used_in_shop_id and receipt_transaction_date = k.coupon_used_date
        and l.spending_campaign_id = k.spending_campaign_id and l.tier_id = k.tier_id),
    raw2 as (
      select * from raw r where not (linked_spend_type = 'First Indirect Spend' and exists (select 1 from raw d where d.linked_spend_type = 'First Direct Spend' and d.spending_campaign_id = r.spending_campaign_id
        and d.tier_id = r.tier_id and d.redemption_date = r.redemption_date and d.redemption_mall_id = r.redemption_mall_id and d.member_id = r.member_id and d.invoice_no = r.invoice_no and d.shop_id = r.shop_id))),
    raw3 as (select * exclude (k) from (select *, rank() over (partition by spending_campaign_id, tier_id, redemption_date, redemption_mall_id, member_id, invoice_no, shop_id, linked_spend_type order by receipt_id) as k from raw2) x where k = 1),
    seen as (select distinct spending_campaign_id, member_id, invoice_no, linked_spend_type as k from raw),
    linked as (
      select r.*, case when linked_spend_type <> 'First Direct Spend' and exists (select 1 from seen where k = 'First Direct Spend' and seen.spending_campaign_id = r.spending_campaign_id and seen.member_id = r.member_id and seen.invoice_no = r.invoice_no)
          then 'same receipt already exists within campaign'
        when linked_spend_type in ('First Indirect Spend', 'Second Indirect Spend') and exists (select 1 from seen where k = 'Second Direct Spend' and seen.spending_campaign_id = r.spending_campaign_id and seen.member_id = r.member_id
          and seen.invoice_no = r.invoice_no) then 'same receipt already exists within campaign'
        when linked_spend_type = 'Second Indirect Spend' and exists (select 1 from seen where k = 'First Indirect Spend' and seen.spending_campaign_id = r.spending_campaign_id and seen.member_id = r.member_id
          and seen.invoice_no = r.invoice_no) then 'same receipt already exists within campaign' else 'valid receipt to count spending' end as spending_filter from raw3 r)"""


def campaign_parts(t: Tables):
    mech = mechanism(t)
    chosen = campaign.selected(mech)
    sp = campaign.campaign_spending(t.derived("src_cspend"))
    conv = campaign.conversions(t.derived("src_conversion"), chosen)
    rules = campaign.conditions(t.derived("src_spend_condition"), t.derived("src_condition_mall"), t.derived("src_condition_payment"), t.derived("src_condition_shop"))
    direct = campaign.first_direct(sp, conv, rules)
    given = campaign.coupons_redeemed(t.derived("src_ccoupon"), chosen, conv, t.derived("src_ccoupon_map"), switch="1998-06-01")
    return mech, sp, direct, given


@check("mart_campaign_first_direct", f"with {LINKED} select * replace (cast(receipt_amount as double) as receipt_amount) from direct")
def _(t):
    return campaign_parts(t)[2].withColumns(doubles("receipt_amount"))


@check("mart_campaign_first_direct_by_index", f"with {LINKED} select * replace (cast(receipt_amount as double) as receipt_amount) from direct")
def _(t):
    lists = [t.derived(f"src_{n}") for n in ("spend_condition", "condition_mall", "condition_payment", "condition_shop")]
    conv = campaign.conversions(t.derived("src_conversion"), campaign.selected(mechanism(t)))
    direct = campaign.first_direct(campaign.campaign_spending(t.derived("src_cspend")), conv, campaign.condition_index(*lists, t.stage), amounts=lists[0])
    return direct.withColumns(doubles("receipt_amount"))


@check("mart_campaign_coupons", f"with {LINKED} select coupon_redemption_transaction_id, spending_campaign_id, tier_id, campaign_tier, coupon_redeem_date, coupon_used_date, cast(min_top_up_amount as double) as min_top_up_amount from given")
def _(t):
    return campaign_parts(t)[3].select("coupon_redemption_transaction_id", "spending_campaign_id", "tier_id", "campaign_tier", "coupon_redeem_date", "coupon_used_date",
                                       F.col("min_top_up_amount").cast("double").alias("min_top_up_amount"))


@check("mart_campaign_transactions", f"""
    with {LINKED},
    used as (select coupon_used_in_mall_id, redeem_coupon_member_id, coupon_used_in_shop_id, coupon_used_date, coupon_redeem_date, coupon_redeemed_mall_id, spending_campaign_id, tier_id, sum(min_top_up_amount) as top
      from given where redemption_status_detail = 'used' group by all),
    gap as (select * from used u where not exists (select 1 from linked l where linked_spend_type = 'Second Direct Spend' and spending_filter = 'valid receipt to count spending' and l.member_id = u.redeem_coupon_member_id
      and l.receipt_transaction_date = u.coupon_used_date and l.shop_id = u.coupon_used_in_shop_id and l.tier_id = u.tier_id)),
    rows as (
      select receipt_id, invoice_no, receipt_transaction_date, mall_id, member_id, shop_id, lms_standard_brand_name, lms_standard_trade_category, receipt_amount, spending_campaign_id, tier_id, redemption_date, redemption_mall_id, linked_spend_type,
             spending_filter, payment_type from linked
      union select null, 'No_Invoice_Upload', coupon_used_date, coupon_used_in_mall_id, redeem_coupon_member_id, coupon_used_in_shop_id, s.lms_standard_brand_name, s.lms_standard_trade_category, coalesce(top, 0), spending_campaign_id, tier_id,
             coupon_redeem_date, coupon_redeemed_mall_id, 'Second Direct Spend without Invoice', 'No_Invoice_Upload', null from gap left join src_shop s on coupon_used_in_shop_id = s.mapping_shop_id)
    select r.* replace (cast(receipt_amount as double) as receipt_amount), campaign_tier, campaign_name, property_id as redemption_property_id
    from rows r left join (select distinct tier_id, campaign_tier, campaign_name from mech) m on r.tier_id = m.tier_id left join src_mall a on redemption_mall_id = a.mall_id""")
def _(t):
    rules = campaign.conditions(t.derived("src_spend_condition"), t.derived("src_condition_mall"), t.derived("src_condition_payment"), t.derived("src_condition_shop"))
    out = campaign.campaign_linked_spending(t.derived("src_cspend"), mechanism(t), t.derived("src_conversion"), rules, t.derived("src_ccoupon"), t.derived("src_ccoupon_map"), t.derived("src_shop"),
                                            t.derived("src_mall"), switch="1998-06-01", used_status="used", stage=t.stage)
    return out.drop("receipt_upload_datetime", "receipt_upload_date", "platform", "campaign_start_date", "campaign_end_date").withColumns(doubles("receipt_amount"))


@check("mart_campaign_archive", f"""
    with {MECH} select id, member_id, spending_campaign_id from src_conversion where spending_campaign_id in (select spending_campaign_id from mech where display_in_transaction = 0)""")
def _(t):
    return campaign.archived(t.derived("src_conversion").select("id", "member_id", "spending_campaign_id"), mechanism(t))


MALL_CODES = {f"NATION_{i} MALL": f"P{i % 24}" for i in range(25)}
UNDEF = "case when {c} is null or lower(trim({c})) in ('', '#n/a', 'none', 'null', 'to be confirmed') then 'UNDEFINABLE' else {c} end"
SALES = f"""
    ts as (
      select m.team, cast(month as string) as month, m.property_id, {UNDEF.format(c='l.standard_trade_category')} as category, {UNDEF.format(c='l.standard_brand_name')} as brand, sum(lms_sales) as lms_sales
      from src_tenant_sales s left join src_lease l on s.agreement_no = l.agreement_no
      left join src_sales_mall m on m.property_id = 'P' || (cast(split_part(split_part(s.mall, ' ', 1), '_', 2) as int) % 24) where month <> 200003 and s.agreement_no not in ('E5', 'E77') group by all),
    bs as (
      select f.team as steam, strftime(receipt_transaction_date, '%Y%m') as month, property_id, case when lower(trim(lms_standard_trade_category)) in ('#n/a', '', 'to be confirmed') then 'UNDEFINABLE' else lms_standard_trade_category end as scat,
             lms_standard_brand_name as brand, sum(receipt_amount) as member_spend
      from src_fact f where {GOOD} and receipt_amount <> 0 and receipt_id not in (select receipt_id from src_pre_shoot) and (shop_id not in (select shop_id from src_abnormal_shop) or platform = 'api') group by all),
    both_sides as (
      select t.team, t.month, t.property_id, t.category, t.brand, t.lms_sales, b.steam, b.scat, b.member_spend, case when b.month is null then 'left' else 'both' end as matched
      from ts t left join bs b on t.month = b.month and t.property_id = b.property_id and t.brand = b.brand
      union all select null, b.month, b.property_id, null, b.brand, null, b.steam, b.scat, b.member_spend, 'right' from bs b left join ts t on t.month = b.month and t.property_id = b.property_id and t.brand = b.brand
      where t.month is null and b.month in (select month from ts))"""


def reconciled(t: Tables):
    left = sales.tenant_sales(t.derived("src_tenant_sales"), t.derived("src_lease"), t.derived("src_sales_mall"), mall_codes=MALL_CODES, excluded_leases=["E5", "E77"], excluded_months=[200003])
    right = sales.brand_spending(sales.countable_spending(good_fact(t), t.derived("src_pre_shoot"), t.derived("src_abnormal_shop")))
    return sales.reconciled(left, right)


@check("mart_sales_unmatched_brands", f"""
    with {SALES} select coalesce(team, steam) as team, month, coalesce(category, scat) as category, brand, cast(coalesce(member_spend, 0) as double) as member_spend, cast(coalesce(lms_sales, 0) as double) as lms_sales, property_id
    from both_sides where matched <> 'both'""")
def _(t):
    return sales.unmatched_brands(reconciled(t)).withColumns(doubles("member_spend", "lms_sales"))


CONTRIBUTION = """
    rows as (select coalesce(team, steam) as team, cast(month as int) as month, property_id, coalesce(scat, category) as category, case when matched = 'both' then brand else 'UNDEFINABLE' end as brand, coalesce(member_spend, 0) as member_spend,
      coalesce(lms_sales, 0) as lms_sales from both_sides),
    ok as (select r.* from rows r left join src_joined j on r.property_id = j.property_id where j.property_id is null or month > joined_month)"""


@check("mart_sales_contribution", f"""
    with {SALES}, {CONTRIBUTION}
    select team, month, property_id, category, brand, cast(sum(member_spend) as double) as member_spend, cast(sum(lms_sales) as double) as lms_sales, cast(strptime(month || '01', '%Y%m%d') as date) as sales_date,
           case when grouping(category) = 1 then 'mall' when grouping(brand) = 1 then 'category' else 'brand' end as level
    from ok group by grouping sets ((team, month, property_id, category, brand), (team, month, property_id, category), (team, month, property_id))""")
def _(t):
    return sales.contribution(reconciled(t), t.derived("src_joined")).withColumns(doubles("member_spend", "lms_sales"))


@check("mart_sales_refresh", """
    with due as (select distinct month from src_tenant_sales order by month desc limit 2),
    fresh as (select * replace (lms_sales + 10 as lms_sales) from src_tenant_sales where month >= 200101)
    select agreement_no, case when agreement_no = 'E100' then 'MOVED MALL' else mall end as mall, month, cast(lms_sales as double) as lms_sales from (
      select * from src_tenant_sales where month not in (select month from due) union all select * from fresh where month in (select month from due)) x""")
def _(t):
    history = t.derived("src_tenant_sales")
    fresh = history.filter("month >= 200101").withColumn("lms_sales", (F.col("lms_sales") + 10).cast("decimal(18,2)"))
    return sales.refreshed_sales(history, fresh, relabel={"E100": "MOVED MALL"}).withColumns(doubles("lms_sales"))


@check("mart_sales_refresh_check", """
    with due as (select distinct month from src_tenant_sales order by month desc limit 2)
    select month, count(*) as rows_before, cast(sum(lms_sales) as double) as total_before, count(*) as rows_after, cast(sum(case when month in (select month from due) then lms_sales + 10 else lms_sales end) as double) as total_after
    from src_tenant_sales group by month""")
def _(t):
    history = t.derived("src_tenant_sales")
    fresh = history.withColumn("lms_sales", (F.col("lms_sales") + 10).cast("decimal(18,2)"))
    return sales.sales_check(history, sales.refreshed_sales(history, fresh)).withColumns(doubles("total_before", "total_after"))


MAPPED = """
    prev as (select shop_id, lms_agreement_no from src_lease_map where updated_month = '200105'),
    mapped as (
      select s.shop_id, s.status as shop_status, case s.status when 'A' then 'Active' when 'I' then 'Inactive' when 'V' then 'Invalid' end as shop_status_detail, m.property_id, case when right(shop_no, 1) = ',' then left(shop_no, length(shop_no) - 1) else shop_no end as unit_no,
             trim(name_lang1) as shop_name, p.lms_agreement_no, replace(l.trade_name, '^', chr(39)) as lms_trade_name, l.main_unit_no, l.property_id as lms_property_id, replace(l.standard_brand_name, '^', chr(39)) as standard_brand_name,
             replace(l.standard_group, '^', chr(39)) as standard_group, replace(l.standard_trade_category, '^', chr(39)) as standard_trade_category, coalesce(l.updated_month, '200107') as updated_month
      from src_shop_raw s left join src_mall m on s.mall_id = m.mall_id left join prev p on s.shop_id = p.shop_id left join src_lease l on p.lms_agreement_no = l.agreement_no)"""


def lease_mapping(t: Tables):
    previous = t.derived("src_lease_map").filter("updated_month = '200105'")
    return sales.lease_mapping(t.derived("src_shop_raw"), previous, t.derived("src_lease"), t.derived("src_mall"), month="200107")


@check("mart_lease_mapping", f"with {MAPPED} select * from mapped")
def _(t):
    return lease_mapping(t)


@check("mart_lease_active_without", f"with {MAPPED} select shop_id, property_id from mapped where lms_agreement_no is null and shop_status = 'A'")
def _(t):
    return sales.active_without_lease(lease_mapping(t)).select("shop_id", "property_id")


@check("mart_lease_name_differences", f"with {MAPPED} select shop_id, shop_name, standard_brand_name from mapped where shop_status = 'A' and shop_name <> standard_brand_name")
def _(t):
    return sales.name_differences(lease_mapping(t)).select("shop_id", "shop_name", "standard_brand_name")


@check("mart_shop", """
    with latest as (select m.* from src_lease_map m join (select shop_id as k, max(updated_month) as u from src_lease_map group by 1) x on m.shop_id = k and m.updated_month = u)
    select s.shop_id, s.status as shop_status, case s.status when 'A' then 'Active' when 'I' then 'Inactive' when 'V' then 'Invalid' end as shop_status_detail, s.visible as shop_visible,
           case s.visible when 'V' then 'Visible' when 'I' then 'Invisible' end as shop_visible_detail, replace(s.name_lang1, chr(10), '') as shop_name, s.floor,
           case when right(shop_no, 1) = ',' then left(shop_no, length(shop_no) - 1) else shop_no end as unit_no, m.team, s.mall_id, w.status as mall_status, case w.status when 'A' then 'Active' when 'I' then 'Inactive' end as mall_status_detail,
           m.property_id, replace(w.name_lang1, chr(10), '') as mall_name, l.agreement_no as lms_agreement_no, l.main_unit_no as lms_unit_no, l.trade_name as lms_trade_name, l.standard_brand_name as lms_standard_brand_name,
           l.standard_group as lms_standard_group, l.charge_area as lms_charge_area,
           case when l.standard_trade_category is null or trim(l.standard_trade_category) in ('', 'To Be Confirmed') then 'UNDEFINABLE' else l.standard_trade_category end as lms_standard_trade_category
    from src_shop_raw s join src_mall_raw w on s.mall_id = w.mall_id join src_mall m on s.mall_id = m.mall_id left join latest k on s.shop_id = k.shop_id left join src_lease l on k.lms_agreement_no = l.agreement_no""")
def _(t):
    return shop.shop_dimension(t.derived("src_shop_raw"), t.derived("src_mall_raw"), t.derived("src_mall"), t.derived("src_lease_map"), t.derived("src_lease"))


@check("mart_shop_display_categories", """
    select c.id as cms_shop_id, c.shop_name as cms_shop_name, c.mall_id, display_main_cat as app_display_cat_id, category_name as app_display_cat_name, rfm_trade_cat
    from src_cms_shop c left join src_cms_category k on display_main_cat = k.id left join src_rfm_category r on category_name = cms_trade_cat where status = 1""")
def _(t):
    return shop.display_categories(t.derived("src_cms_shop"), t.derived("src_cms_category"), t.derived("src_rfm_category"))
