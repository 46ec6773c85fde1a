"""Activity feed, customer-system and directory marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Tables, check
from martkit.plans import activity, crm, directory


def iso(c: str, hours: int = 16) -> str:
    return f"strftime({c} - interval '{hours}' hour, '%Y-%m-%dT%H:%M:%S') || '.000Z'"


FEED = f"""
    base as (
      select l.*, json_extract_string(matched_rules_json, '$.extra_offer[0].name_lang1') as offer, json_extract_string(matched_rules_json, '$.extra_offer[0].name_lang2') as offer2, json_extract_string(matched_rules_json, '$.extra_offer[0].name_lang3') as offer3, left(redemption_transaction_id, 2) as src from src_feed_ledger l),
    k as (
      select b.*, case when action = 'D' and lower(offer) like '%conversion%' then 'conversion' when action = 'D' then 'promotion' when action = 'A' and adjust_reason_lang1 = 'Used Point Dollar Spending' then 'pd' when action = 'A' then 'adjustment'
        when action in ('E', 'N') then 'expiry' when src = 'GR' and lower(gn.name_lang1) like '%free parking%' then 'free' when src = 'GR' then 'gift' when src = 'CR' then 'coupon' when src = 'ER' then 'event' when redemption_transaction_id is null then 'reward' end as kind
      from base b left join src_feed_gift_redemption gr on redemption_transaction_id = gift_redemption_transaction_id left join src_feed_gift gn on gr.gift_id = gn.gift_id
      where action in ('D', 'A', 'E', 'N', 'C', 'M', 'R', 'T'))
    select case kind when 'conversion' then 'M' || k.mall_id when 'promotion' then 'M' || k.mall_id when 'pd' then 'M' || p.mall_id when 'coupon' then 'M' || c.used_mall_id else '' end as mall,
           case when kind in ('gift', 'coupon') then y.order_reference_no else '' end as invoice_no, case kind when 'gift' then cast(g.redeemed_amount as string) when 'coupon' then cast(c.redeemed_amount as string) else '' end as amount,
           case when kind in ('gift', 'coupon') then y.payment_type else '' end as payment_type, {iso('k.created_date')} as activity_at, case kind when 'pd' then 'S' || p.shop_id when 'coupon' then 'S' || c.used_shop_id else '' end as shop,
           case when kind in ('pd', 'coupon') then s.shop_name else '' end as shop_name,
           case when kind in ('conversion', 'promotion', 'expiry') then k.status when kind = 'pd' then x.status when kind = 'gift' then g.status when kind = 'coupon' then c.status when kind = 'event' then e.status else '' end as status, '' as updated_by,
           k.member_id, cast(points as string) as points, '' as approval_at, '' as reject_reason,
           case kind when 'pd' then p.trans_type when 'gift' then g.redeem_type when 'coupon' then c.redeem_type when 'event' then e.redeem_type else '' end as type, '' as auto_approved, '' as ocr_id, '' as receipt_id, '' as created_by,
           case when kind in ('gift', 'coupon') then {iso('y.created_date')} else '' end as created_at, '' as updated_at, '' as partner_id, '' as platform, '' as channel,
           case kind when 'gift' then 'M' || g.mall_id when 'coupon' then 'M' || c.mall_id when 'event' then 'M' || e.mall_id else '' end as pickup_point,
           case kind when 'pd' then 'Point Dollar' when 'gift' then replace(gn.name_lang1, '"', '') when 'coupon' then cn.name_lang1 when 'event' then e.event_name else '' end as reward_name,
           case kind when 'gift' then cast(g.gift_id as string) when 'coupon' then cast(c.coupon_id as string) when 'event' then cast(e.event_id as string) else '' end as reward_id,
           case when kind = 'coupon' then {iso('c.expiry_date')} else '' end as expiry_at, case when kind = 'event' then {iso('e.session_end')} else '' end as reserve_at,
           case kind when 'gift' then {iso('g.cancel_datetime')} when 'coupon' then {iso('c.cancel_datetime')} else '' end as cancel_at, case when kind = 'coupon' then {iso('c.used_datetime')} else '' end as used_at,
           '' as linked_sales_amount, '' as min_spending_amount, case when kind = 'pd' then cast(p.amount as string) else '' end as point_dollar_amount, case when kind in ('gift', 'coupon') then y.status else '' end as payment_status, '' as url, '' as small_url,
           cast(bonus_points_transaction_id as string) as bp_transaction_id, action, case kind when 'conversion' then 'Conversion' when 'promotion' then 'Promotion' when 'adjustment' then 'Reward/ Point Adjustment' when 'expiry' then 'Expiry' else 'Reward' end as file_name,
           case when kind in ('conversion', 'promotion', 'free', 'gift', 'coupon') then offer when kind in ('adjustment', 'pd') then adjust_reason_lang1 when kind = 'event' then en.name_lang1 else '' end as display_name,
           case when kind in ('conversion', 'promotion', 'free', 'gift', 'coupon') then offer2 when kind in ('adjustment', 'pd') then adjust_reason_lang2 when kind = 'event' then replace(en.name_lang2, '"', '') else '' end as display_name_lang2,
           case when kind in ('conversion', 'promotion', 'free', 'gift', 'coupon') then offer3 when kind in ('adjustment', 'pd') then adjust_reason_lang3 when kind = 'event' then en.name_lang3 else '' end as display_name_lang3,
           case when kind in ('free', 'gift') then greatest(k.updated_date, g.updated_date) when kind = 'coupon' then greatest(k.updated_date, c.updated_date) when kind = 'event' then greatest(k.updated_date, e.updated_date) else k.updated_date end as retrieve_timestamp
    from k left join src_feed_exchange x on redemption_transaction_id = x.trans_id left join src_feed_pd p on x.point_dollar_transaction_id = p.trans_id left join src_feed_gift_redemption g on redemption_transaction_id = gift_redemption_transaction_id
    left join src_feed_gift gn on g.gift_id = gn.gift_id left join src_feed_coupon_redemption c on redemption_transaction_id = coupon_redemption_transaction_id left join src_feed_coupon cn on c.coupon_id = cn.coupon_id
    left join src_feed_event_redemption e on redemption_transaction_id = event_redemption_transaction_id left join src_feed_event en on e.event_id = en.event_id
    left join src_feed_payment y on y.payment_transaction_id = coalesce(g.payment_transaction_id, c.payment_transaction_id) left join src_shop s on s.mapping_shop_id = coalesce(p.shop_id, c.used_shop_id)
    where kind is not null"""


@check("mart_activity_ledger", f"with {FEED}")
def _(t):
    ledger = t.derived("src_feed_ledger")
    return activity.ledger_activities(ledger, *[t.derived(f"src_feed_{n}") for n in ("exchange", "pd", "gift_redemption", "gift", "coupon_redemption", "coupon", "event_redemption", "event", "payment")], t.derived("src_shop"))


@check("mart_activity_receipts_delta", f"""
    select 'M' || r.mall_id as mall, r.invoice_no, cast(r.original_amount as string) as amount, r.payment_type_lang1 as payment_type, {iso('coalesce(r.receipt_datetime, r.receipt_date)')} as activity_at, 'S' || r.shop_id as shop, r.status, r.updated_by,
           t.member_id, cast(t.earned_points as string) as points, {iso('t.approval_date')} as approval_at, t.reject_reason_lang1 as reject_reason, t.type, case when t.auto_approved then 'TRUE' else 'FALSE' end as auto_approved, cast(r.receipt_id as string) as receipt_id,
           {iso('r.created_date')} as created_at, 'B' || partner_id as partner_id, cast(b.bonus_points_transaction_id as string) as bp_transaction_id, b.action, 'Receipt' as file_name, 'Upload Receipt' as display_name, '上傳單據' as display_name_lang2, '上传单据' as display_name_lang3, r.updated_date as retrieve_timestamp
    from src_transaction t left join src_receipt r on t.spending_transaction_id = r.spending_transaction_id left join src_partner_link p on t.spending_transaction_id = p.result
    join (select * from src_feed_ledger where updated_date >= timestamp '2024-01-10') b on t.spending_transaction_id = b.spending_transaction_id""")
def _(t):
    ledger = activity.changed_ledger(t.derived("src_feed_ledger"), "delta", days=21, as_of="2024-01-31")
    out = activity.activity_feed(activity.receipt_activities(ledger, t.derived("src_transaction"), t.derived("src_receipt"), t.derived("src_partner_link")))
    return out.select("mall", "invoice_no", "amount", "payment_type", "activity_at", "shop", "status", "updated_by", "member_id", "points", "approval_at", "reject_reason", "type", "auto_approved", "receipt_id", "created_at",
                      "partner_id", "bp_transaction_id", "action", "file_name", "display_name", "display_name_lang2", "display_name_lang3", "retrieve_timestamp")


APPS = {"store": 5001, "telco": 5004}
CRM = f"""
    bind as (select * from (select m.member_id, app_id, b.status, b.updated_date, row_number() over (partition by app_id, m.member_id order by b.updated_date desc, b.status) as r from src_crm_binding b join src_crm_member m on b.phone = m.phone
      where app_id in (5001, 5004)) x where r = 1),
    crm as (
      select m.member_id, title as salutation, first_name_lang1 as first_name, last_name_lang1 as last_name, 'M' || from_mall_id as registration_source, case when a.status = 'A' then 'TRUE' else 'FALSE' end as store_member, {iso('a.updated_date', 0)} as store_bind_date,
             case when b.status = 'A' then 'TRUE' else 'FALSE' end as telco_member, {iso('b.updated_date', 0)} as telco_bind_date, age, birth_mth, {iso('registration_date', 0)} as creation_date, m.status, default_language,
             {', '.join(f"case when receive_promotion_{f} = 1 then 'TRUE' else 'FALSE' end as receive_{f}" for f in crm.FLAGS)}, country_lang1 as country,
             case when district_lang1 = 'N/A' and sub_district_lang1 = 'N/A' then null when district_lang1 <> 'N/A' and sub_district_lang1 = 'N/A' then district_lang1 when district_lang1 = 'N/A' and sub_district_lang1 <> 'N/A' then sub_district_lang1
               when district_lang1 <> 'N/A' and sub_district_lang1 <> 'N/A' then district_lang1 || ' , ' || sub_district_lang1 end as street,
             cast(greatest(update_date, s.updated_date, a.updated_date, b.updated_date) as date) as retrieval_date
      from src_crm_member m left join src_crm_setting s on m.member_id = s.member_id left join bind a on m.member_id = a.member_id and a.app_id = 5001 left join bind b on m.member_id = b.member_id and b.app_id = 5004)"""


def crm_rows(t: Tables):
    member = t.derived("src_crm_member")
    return crm.member_rows(member, t.derived("src_crm_setting"), crm.partner_bindings(t.derived("src_crm_binding"), member, APPS), APPS)


@check("mart_crm_members", f"with {CRM} select * from crm")
def _(t):
    return crm_rows(t)


@check("mart_crm_member_upsert", f"""
    with {CRM}, t0 as (select member_id, 'old' as first_name, date '2020-01-01' as retrieval_date from crm where member_id not like 'M1%'), d as (select member_id, first_name from crm where retrieval_date >= date '2021-02-10')
    select coalesce(t0.member_id, d.member_id) as member_id, case when d.member_id is not null then d.first_name else t0.first_name end as first_name, case when d.member_id is not null then date '2021-02-20' else t0.retrieval_date end as retrieval_date
    from t0 full outer join d on t0.member_id = d.member_id""")
def _(t):
    rows = crm_rows(t).select("member_id", "first_name", "retrieval_date")
    target = rows.filter(~F.col("member_id").like("M1%")).select("member_id", F.lit("old").alias("first_name"), F.lit("2020-01-01").cast("date").alias("retrieval_date"))
    return crm.apply_delta(target, crm.member_delta(rows, as_of="2021-02-20", days=10), as_of="2021-02-20")


VEHICLE = """
    log as (select e.*, upper(trim(lpn)) as k, mallid from src_user_event e left join src_crm_carpark c on e.carpark_id = c.id where type in (1, 2, 7))
    select distinct v.lpn as car_plate, v.memberId as member_id, 'FALSE' as inactive, case when validationsts = 1 then 'TRUE' else 'FALSE' end as validated, type as event_type, event_time, cast(carpark_id as string) as car_park_id, 'M' || mallid as mall
    from src_crm_vehicle v left join log on upper(trim(v.lpn)) = k and v.memberId = log.member_id
    union select lpn, member_id, 'TRUE', 'FALSE', type, event_time, cast(carpark_id as string), 'M' || mallid from log
    where not exists (select 1 from src_crm_vehicle v where upper(trim(v.lpn)) = log.k and v.memberId = log.member_id)"""


@check("mart_crm_vehicles", f"with {VEHICLE}")
def _(t):
    return crm.registered_vehicles(t.derived("src_crm_vehicle"), t.derived("src_user_event"), t.derived("src_crm_carpark"))


@check("mart_directory_malls", """
    select m.mall_id, coalesce(mall_name_en, name_lang1) as name_en, coalesce(loc_long_en, '') as address_en, case when district is null then '' when district = 0 then 'HONG_KONG_ISLAND' when district = 1 then 'KOWLOON' else 'NEW_TERRITORIES' end as district,
           case when left(website_url, 3) = 'www' then 'http://' || website_url else website_url end as website_url, case when m.status = 'A' then 1 else 0 end as under_loyalty_program,
           case when m.mall_id in (14) then 'ACTIVE' when m.status = 'A' then 'ACTIVE' when m.status = 'I' then 'INACTIVE' when m.status = 'V' then 'INVALID' else m.status end as status,
           case when m.mall_id between 2000 and 2100 then 'GATED' when m.mall_id between 6000 and 6100 then 'CLUB' when m.mall_id between 5000 and 5100 then 'PARTNER' when m.mall_id >= 7000 then 'PARTNER' when m.mall_id < 900 then 'OWN' else 'OTHER' end as mall_type,
           coalesce(s.status, 0) as show_in_api
    from src_dir_mall m left join src_dir_site s on s.id = case when m.mall_id = 13 then 1 else cms_mall_id end where m.mall_id <> 20""")
def _(t):
    return directory.malls(t.derived("src_dir_mall"), t.derived("src_dir_site"), site_ids={13: 1}, active=[14], excluded=[20],
                           kinds=[(0, 899, "OWN"), (2000, 2100, "GATED"), (6000, 6100, "CLUB"), (5000, 5100, "PARTNER"), (7000, None, "PARTNER")])


@check("mart_directory_car_parks", """
    select carpark_id, coalesce(name_en, name) as name_en, mallid as mall_id, name_lang1 as mall_name from src_dir_carpark c left join src_dir_carpark_site s on s.id = case carpark_id when 1 then 3 else carpark_id end left join src_dir_mall m on mallid = m.mall_id""")
def _(t):
    return directory.car_parks(t.derived("src_dir_carpark"), t.derived("src_dir_carpark_site"), t.derived("src_dir_mall"), site_ids={1: 3})


@check("mart_directory_floor_plans", """
    select distinct id, coalesce(create_date, last_update_date) as created_at, coalesce(last_update_date, create_date) as updated_at, floor_name_en, mall_id from src_dir_floor where status = 1 or id in (2, 4, 8)""")
def _(t):
    return directory.floor_plans(t.derived("src_dir_floor"), [2, 4, 8])


@check("mart_directory_floor_links", "select id as floor_plan_id, floor_phase as phase_id, rank() over (partition by floor_phase order by id) as floor_plan_order from src_dir_floor where status = 1 or id in (2, 4, 8)")
def _(t):
    return directory.floor_phase_links(t.derived("src_dir_floor"), [2, 4, 8], block=100)


@check("mart_directory_phases", """
    select phase_id as id, nullif(phone, '') as phone, case when phase_name_en <> '' then phase_name_en else coalesce(mall_name_en, name_lang1) end as phase_name_en, coalesce(m.mall_id, s.id) as mall_id
    from src_dir_phase p left join src_dir_site s on p.mall = s.id left join src_dir_mall m on p.mall = m.cms_mall_id where p.status = 1 and coalesce(m.mall_id, s.id) is not null""")
def _(t):
    return directory.phases(t.derived("src_dir_phase"), t.derived("src_dir_site"), t.derived("src_dir_mall"))


@check("mart_directory_main_categories", "select id, category_name_en as main_name, case when type = 1 then 'Dining' else 'Shopping' end as shop_type from src_dir_category where main_cat is null and status = 1")
def _(t):
    return directory.main_categories(t.derived("src_dir_category"))


@check("mart_directory_sub_categories", """
    select c.id, c.category_name_en as sub_name, c.main_cat as main_category_id, c.category_name_en || '_' || m.category_name_en as alias_key from src_dir_category c
    left join (select distinct id, category_name_en from src_dir_category where main_cat is null and status = 1) m on c.main_cat = m.id where c.id not in (select id from src_dir_category where main_cat is null and status = 1) and c.status = 1""")
def _(t):
    return directory.sub_categories(t.derived("src_dir_category"))


@check("mart_directory_brands", """
    select partner_id as brand_id, p.name_lang1 as brand_name, c.name_lang1 as category_name from src_dir_partner p left join src_brand_category c on c.brand_category_id = case partner_id when 50 then 2 when 51 then 19 else partner_id end""")
def _(t):
    return directory.brands(t.derived("src_dir_partner"), t.derived("src_brand_category"), category_ids={50: 2, 51: 19})


@check("mart_directory_brand_links", "select distinct case brand_id when 2 then 5001 when 19 then 5004 else brand_id end as brand_id, brand_category_id from src_dir_brand where status = 'A'")
def _(t):
    return directory.brand_category_links(t.derived("src_dir_brand"), brand_ids={2: 5001, 19: 5004})


@check("mart_directory_shops", """
    select c.id, shop_name as name_en, case ticket_type when 1 then 'ticket a' when 2 then 'ticket b' when 3 then 'ticket c' else 'none' end as ticket_type, case when c.status = 1 then 1 else 0 end as display_in_directory, shop_no, c.mall_id,
           a.partner_shop_id as store_shop_code, b.partner_shop_id as telco_shop_code, case when s.status = 'A' then 'ACTIVE' when s.status = 'V' then 'INVALID' else 'INACTIVE' end as status
    from src_dir_shop c left join src_shop_raw s on c.id = s.shop_id left join (select * from src_dir_partner_shop where partner_id = 5001) a on c.id = a.shop_id left join (select * from src_dir_partner_shop where partner_id = 5004) b on c.id = b.shop_id""")
def _(t):
    return directory.shops(t.derived("src_dir_shop"), t.derived("src_shop_raw"), t.derived("src_dir_partner_shop"), APPS, {1: "ticket a", 2: "ticket b", 3: "ticket c"})


@check("mart_directory_shop_floor_links", """
    select id as shop_id, cast(w as int) as floor_plan_id, cast(p as int) as shop_order from (select id, unnest(string_split(replace(floor, ' ', ''), ',')) as w, generate_subscripts(string_split(replace(floor, ' ', ''), ','), 1) as p from src_dir_shop where status = 1) x
    where length(w) >= 2 and cast(w as int) not in (12, 13)""")
def _(t):
    return directory.shop_links(t.derived("src_dir_shop"), "floor", "floor_plan_id", excluded=[12, 13])
