"""Parking and registration marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.marts_core import doubles
from checks.registry import Tables, check
from martkit.operators import distincts
from martkit.plans import parking, registration

CARPARKS = {"p3": "PC3", "Site Three": "PC3"}
PROPERTIES = {"P3": "PROP3", "p4": "PROP4"}
PLACED = "case upper(property_id) when 'P3' then 'PC3' else property_id end as carpark_id, case upper(property_id) when 'P3' then 'PROP3' when 'P4' then 'PROP4' else property_id end as property_id"
HIDE = "case when upper(member_id) in (select upper(member_id) from src_hidden_member) then sha256(upper({c})) else {c} end"
VISITS = f"""
    vis as (
      select distinct car_in_datetime, car_out_datetime, trim(car_plate) as plate, coalesce(trim(car_type), '') as car_type, member_id, parked_minute, property_id, total_paid_minute, total_parking_fee, total_redeem_minute
      from src_visit where parked_minute >= 15 and year(car_in_datetime) >= 2000),
    entry as (select distinct case when name = 'Site Three' then 'PC3' when name = 'P3' then 'PC3' else name end as cp, g.timestamp as t, lower(lpn) as plate from src_gate g join src_site s on g.carparkid = s.id where lower(operation) = 'in'),
    visits as (
      select v.car_in_datetime, v.car_out_datetime, {HIDE.format(c='v.plate')} as car_plate, car_type, member_id, parked_minute, {PLACED}, total_paid_minute, total_parking_fee, total_redeem_minute,
             case when e.t is not null then 1 else 0 end as is_contactless
      from vis v left join entry e on e.cp = case upper(v.property_id) when 'P3' then 'PC3' else v.property_id end and e.t = v.car_in_datetime and e.plate = lower(v.plate))"""


def by_table(df, *names):
    """The fixture split into the tables a control table would name."""
    return [df.filter(F.col("source_table") == n).drop("source_table") for n in names]


def visits(t: Tables):
    rows = parking.visit_rows(by_table(t.derived("src_visit"), "A", "N", "R"), min_year=2000)
    entries = parking.contactless_entries(t.derived("src_gate"), t.derived("src_site"), CARPARKS)
    return parking.parking_visits(rows, entries, t.derived("src_hidden_member"), carparks=CARPARKS, properties=PROPERTIES)


@check("mart_parking_visits", f"with {VISITS} select distinct * from visits")
def _(t):
    return visits(t)


@check("mart_parking_gate_visits", """
    select timestamp as car_in_datetime, out_ts as car_out_datetime, lpn as car_plate, cast(date_sub('minute', timestamp, out_ts) as int) as parked_minute, 'GP-' || mall_name as property_id,
           cast(carparkid as string) as carpark_id, 1 as is_contactless
    from (select g.*, (select min(o.timestamp) from src_gate_log o where o.lpn = g.lpn and o.carparkid = g.carparkid and o.operation = 'out' and o.timestamp > g.timestamp) as out_ts
          from src_gate_log g where operation = 'in') x left join src_mall m on x.carparkid = m.mall_id""")
def _(t):
    return parking.gate_visits(t.derived("src_gate_log"), t.derived("src_mall"), prefix="GP-")


@check("mart_parking_daily", f"""
    with {VISITS}, u as (select distinct * from visits)
    select property_id, carpark_id, cast(car_in_datetime - interval '8' hour as date) as car_in_date, car_plate, count(distinct carpark_id || car_plate || cast(car_in_datetime as string)) as total_freq,
           cast(sum(parked_minute) as bigint) as total_parked_minute, cast(sum(total_paid_minute) as bigint) as total_paid_minute, cast(sum(total_parking_fee) as bigint) as total_parking_fee,
           cast(sum(total_redeem_minute) as bigint) as total_redeem_minute, count(distinct case when is_contactless = 1 then carpark_id || car_plate || cast(car_in_datetime as string) end) as total_freq_with_contactless,
           cast(sum(case when is_contactless = 1 then parked_minute else 0 end) as bigint) as total_parked_minute_with_contactless, cast(sum(case when is_contactless = 1 then total_paid_minute else 0 end) as bigint) as total_paid_minute_with_contactless,
           cast(sum(case when is_contactless = 1 then total_parking_fee else 0 end) as bigint) as total_parking_fee_with_contactless, cast(sum(case when is_contactless = 1 then total_redeem_minute else 0 end) as bigint) as total_redeem_minute_with_contactless
    from u group by 1, 2, 3, 4""")
def _(t):
    return parking.daily_visits(visits(t))


INVOICES = f"""
    invoices as (
      select distinct car_in_datetime, car_out_datetime, {HIDE.format(c="trim(car_plate)")} as car_plate, member_id, {PLACED}, invoice_amount, regexp_replace(invoice_no, '^0+', '') as invoice_no, redemption_datetime,
             'food' as shop_category, '' as shop_name, shop_no from src_parking_invoice where year(car_in_datetime) >= 1996)"""


def invoices(t: Tables):
    return parking.parking_invoices(by_table(t.derived("src_parking_invoice"), "F", "O"), t.derived("src_hidden_member"), carparks=CARPARKS, properties=PROPERTIES, min_year=1996)


@check("mart_parking_invoices", f"with {INVOICES} select * replace (cast(invoice_amount as double) as invoice_amount) from invoices")
def _(t):
    return invoices(t).withColumns(doubles("invoice_amount"))


@check("mart_parking_redemptions", f"""
    select distinct date_trunc('minute', car_in_datetime) as car_in_datetime, date_trunc('minute', car_out_datetime) as car_out_datetime, date_trunc('minute', redemption_datetime) as redemption_datetime,
           {HIDE.format(c="trim(car_plate)")} as car_plate, member_id, {PLACED}, redeemed_minute, redeemed_parking_fee, 'ccc' as redemption_type from src_parking_redemption where property_id <> ''""")
def _(t):
    parts = by_table(t.derived("src_parking_redemption"), "click", "view", "error", "purchase", "signup")
    return parking.parking_redemptions(parts, t.derived("src_hidden_member"), carparks=CARPARKS, properties=PROPERTIES)


def spending_side(t: Tables):
    """Receipts in the shape of the spending fact, at the places the parking invoices know."""
    return t.lineitem.select(
        F.concat(F.lit("M"), (F.col("l_suppkey") * 3).cast("string")).alias("member_id"), F.concat(F.lit("P"), (F.col("l_suppkey") % 20).cast("string")).alias("property_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("receipt_id"), F.to_date("l_shipdate").alias("receipt_transaction_date"),
        F.concat(F.lit("0INV-"), "l_orderkey", F.lit("r"), "l_linenumber").alias("invoice_no"), F.lit("shop").alias("shop_name"), F.col("l_extendedprice").cast("decimal(18,2)").alias("receipt_amount"))


HISTORY = f"""{INVOICES},
    spend as (
      select 'M' || (l_suppkey * 3) as member_id, 'P' || (l_suppkey % 20) as property_id, l_orderkey * 10 + l_linenumber as receipt_id, cast(l_shipdate as date) as receipt_transaction_date,
             '0INV-' || l_orderkey || 'r' || l_linenumber as invoice_no, 'shop' as shop_name, cast(l_extendedprice as decimal(18, 2)) as receipt_amount from lineitem),
    evidence as (
      select 'identify by Invoice' as identify_type, s.member_id, upper(trim(i.car_plate)) as car_plate, s.property_id, s.receipt_id, s.receipt_transaction_date, s.invoice_no, s.shop_name, s.receipt_amount,
             i.property_id as property_id_parking, i.redemption_datetime as redeemed_at, i.invoice_no as invoice_no_parking, i.invoice_amount as receipt_amount_parking, cast(null as string) as redemption_transaction_id,
             cast(null as timestamp) as charged_at
      from spend s join invoices i on s.receipt_transaction_date = cast(i.car_in_datetime - interval '8' hour as date) and s.property_id = i.property_id
        and lower(regexp_replace(s.invoice_no, '^0+', '')) = lower(i.invoice_no) and s.receipt_amount = i.invoice_amount where i.member_id not like 'M%'
      union all select 'identify by Contactless Parking', memberId, upper(trim(lpn)), null, null, null, null, null, null, null, null, null, null, null, null from src_vehicle where validationsts = 1 and memberId <> ''
      union all select 'identify by Inapp Free Parking Redemption', member_id, upper(trim(lpn)), null, null, null, null, null, null, null, r_time, null, null, t_id, null
        from src_tid_log join src_activity_log on rlog_id = log_id join src_app_redemption on t_id = transaction_id where member_id <> ''
      union all select 'identify by member parking', upper(trim(member_id)), upper(trim(car_plate)), null, null, null, null, null, null, property_id, redemption_datetime, invoice_no, invoice_amount, null, null from invoices where member_id like 'M%'
      union all select 'identify by EV Charging', externalMemberId, upper(trim(lp)), null, null, null, null, null, null, null, null, null, null, null, createDttm + interval '8' hour from src_session
        where status in ('Settled', 'Unsettled') and externalMemberId is not null),
    history as (
      select e.* replace (case when status = 'V' and length(car_plate) <> 64 then sha256(car_plate) else car_plate end as car_plate) from (select distinct * from evidence) e
      join (select upper(member_id) as mid, status from src_member) m on upper(e.member_id) = m.mid)"""


def evidence(t: Tables):
    inv = invoices(t)
    return [parking.invoice_evidence(spending_side(t), inv, member_prefix="M"), parking.vehicle_evidence(t.derived("src_vehicle")),
            parking.app_evidence(t.derived("src_tid_log"), t.derived("src_activity_log"), t.derived("src_app_redemption")), parking.parking_evidence(inv, member_prefix="M"),
            parking.charging_evidence(t.derived("src_session"))]


def history(t: Tables):
    return parking.identity_history(evidence(t), t.derived("src_member"))


@check("mart_parker_identity_history", f"with {HISTORY} select * replace (cast(receipt_amount as double) as receipt_amount, cast(receipt_amount_parking as double) as receipt_amount_parking) from history")
def _(t):
    return history(t).withColumns(doubles("receipt_amount", "receipt_amount_parking"))


@check("mart_parker_identity", f"""
    with {HISTORY}
    select member_id, car_plate, max(case when identify_type = 'identify by Contactless Parking' then 1 else 0 end) as is_contactless_carplate,
           max(case when identify_type in ('identify by Invoice', 'identify by Inapp Free Parking Redemption', 'identify by member parking') then 1 else 0 end) as is_member_parking_carplate,
           max(case when identify_type = 'identify by EV Charging' then 1 else 0 end) as is_ev_charging_carplate from history group by 1, 2""")
def _(t):
    return parking.parker_identity_of(evidence(t), t.derived("src_member"))


AS_OF = "2024-01-20"
PAIRS = """
    today as (select distinct trim(lower(lpn)) as lpn, trim(lower(member_id)) as member_id, type from src_user_event where type in (2, 7) and member_id is not null and event_time > timestamp '2024-01-19'),
    pairs as (
      select trim(lower(lpn)) as lpn, trim(lower(memberId)) as member_id from src_vehicle where validationsts = 1 and trim(lower(lpn)) || trim(lower(memberId)) not in (select lpn || member_id from today)
      union all select lpn, member_id from today where type = 2)"""


def pairs(t: Tables):
    return parking.contactless_pairs(t.derived("src_vehicle"), t.derived("src_user_event"), as_of=AS_OF)


@check("mart_parking_counters", f"""
    with {HISTORY}, {PAIRS},
    parkers as (
      select distinct trim(lower(member_id)) as member_id, trim(lower(car_plate)) as car_plate from history h left join (select transaction_id, redeem_date from src_app_redemption) r on h.redemption_transaction_id = r.transaction_id
      where (identify_type like '%Inapp%' and redeem_date <= date '2024-01-19') or (identify_type = 'identify by Invoice' and receipt_transaction_date <= date '2024-01-19')
         or (identify_type = 'identify by member parking' and cast(redeemed_at as date) <= date '2024-01-19') or (identify_type = 'identify by EV Charging' and cast(charged_at as date) <= date '2024-01-19')),
    pay as (select member_id from (select trim(lower(member_id)) as member_id, autopayment_activate as s from src_autopay_base
      union all select trim(lower(member_id)), cast(autopayment_activate as int) from src_autopay_log where created_at < timestamp '2024-01-20') x group by 1 having sum(s) > 0),
    others as (select * from parkers where member_id not in (select member_id from pairs where member_id is not null))
    select (select count(distinct lpn) from pairs) as contactless_lpn, (select count(distinct member_id) from pairs) as contactless_parker, (select count(distinct lower(lpn)) from src_gate_log) as contactless_entries_during_that_month,
           (select count(distinct member_id) from others) as non_contactless_parker, (select count(distinct car_plate) from others) as non_contactless_lpn, (select count(*) from pay) as autopay_user,
           (select count(*) from pay where member_id in (select member_id from pairs where member_id is not null)) as autopay_contactless_user, date '2024-01-19' as update_date""")
def _(t):
    parkers = parking.parkers_until(history(t), t.derived("src_app_redemption"), as_of=AS_OF)
    pay = parking.autopay_members(t.derived("src_autopay_base"), t.derived("src_autopay_log"), as_of=AS_OF)
    return parking.parking_counters(t.derived("src_gate_log"), pairs(t), parkers, pay, as_of=AS_OF)


@check("mart_parking_entries_from_states", "select cast(count(distinct trim(lower(lpn))) as bigint) as contactless_entries_during_that_month, date '2024-01-19' as update_date from src_gate_log")
def _(t):
    log = t.derived("src_gate_log")
    numbers = parking.plates(log, t.stage)
    days = t.stage(parking.entry_states(log, numbers), "entries")
    newest = days.agg(F.max("day")).first()[0]
    so_far = distincts.merge_states(days.filter(F.col("day") < F.lit(newest)), [])
    return parking.entries_so_far(so_far, days.filter(F.col("day") == F.lit(newest)), as_of=AS_OF)[0]


@check("mart_parking_counters_by_mall", f"""
    with {PAIRS},
    act as (select distinct trim(lower(e.member_id)) as member_id, trim(lower(e.lpn)) as lpn, property_id from src_user_event e join (select member_id as m, lpn as l, max(event_time) as t from src_user_event where type = 7 group by 1, 2) x
      on e.member_id = m and e.lpn = l and e.event_time = t left join src_merchant c on e.carpark_id = c.carpark_id left join src_mall a on c.mall_id = a.mall_id where e.type = 7)
    select coalesce(property_id, 'Can not check') as property_id, count(distinct p.member_id) as contactless_parker, count(distinct p.lpn) as contactless_lpn, date '2024-01-19' as update_date
    from pairs p left join act on p.member_id = act.member_id and p.lpn = act.lpn group by 1""")
def _(t):
    return parking.counters_by_mall(pairs(t), t.derived("src_user_event"), t.derived("src_merchant"), t.derived("src_mall"), as_of=AS_OF)


RULES = registration.Rules(
    website_names=("Portal",), website_keys=("k3",), mini_keys=("k4",), pages=("pages/register",), inapp_links=("https://h/x/new?inapp=true",), campaign_links={"https://h/camp/": "store"},
    api_malls={5004: "telco", 5005: "bus"}, api_campaigns={"oneclick": "TELCO_ONE"}, lost_links=((5000, "PQ2_", "QRCODE", "CROSS"),), source_names={"S3": "SX"}, non_mall=("P7",))
VISIT_SQL = """
    vst as (
      select openid, last_track_time, member_id, case kind when 'purchase' then 1 when 'view' then 2 when 'click' then 3 else 4 end as scene_rank, oa, btl, key, mgm from (
      select distinct 'o' || user_id as openid, event_type as kind, user_id % 30 as g, wallclock('2019-01-01 05:00:00') + interval '1' hour * (user_id % 20000) + interval '1' minute * (event_id % 60) as last_track_time,
             case when event_type in ('view', 'purchase') then 'm' || user_id when event_type = 'signup' then 'M' || user_id end as member_id, case when event_type = 'view' then 'p' || (user_id % 30) end as oa,
             case when event_type = 'click' then 'p' || (user_id % 30) end as btl, case when event_type = 'purchase' then 'k' || (user_id % 4) end as key, case when event_type = 'signup' then 'MGM-7' end as mgm
      from events where event_type <> 'error') y)"""
LABEL = "coalesce(oa, btl, key, case when mgm is not null then 'MGM' end)"


def channel(t: Tables):
    return registration.member_channel(t.derived("src_reg_member"), t.derived("src_reg_activity"), t.derived("src_reg_key"), t.derived("src_reg_placed"), RULES)


CHANNEL = """
    chan as (
      select m.member_id, registration_date, created_by, h.channel, phone_prefix as mobile_prefix, case when p.member_id is null then m.from_mall_id else p.from_mall_id end as from_mall_id,
             case when p.member_id is null then m.from_mall_name else p.from_mall_name end as from_mall_name
      from src_reg_member m left join (
        select member_id, case when coalesce(name, 'Manual Create') = 'Portal' or a.api_key = 'k3' then 'Website' when a.api_key = 'k4' or coalesce(name, '') like '%Wechat%' then 'Wechat' else coalesce(name, 'Manual Create') end as channel
        from src_reg_activity a left join src_reg_key k on a.api_key = k.api_key where action_type = 6) h on m.member_id = h.member_id left join src_reg_placed p on m.member_id = p.member_id)"""


@check("mart_registration_channel", f"with {CHANNEL} select * from chan")
def _(t):
    return channel(t)


@check("mart_registration_attribution", f"""
    with {CHANNEL}, {VISIT_SQL},
    bym as (select distinct on (upper(v.member_id)) upper(v.member_id) as k, {LABEL} as source from vst v join src_reg_member m on upper(v.member_id) = upper(m.member_id) and cast(last_track_time as date) = cast(registration_date as date)
      order by upper(v.member_id), last_track_time, scene_rank),
    rec as (select distinct on (vip_num) vip_num, openid from src_reg_receiver order by vip_num, created_date, openid),
    daily as (select distinct on (openid, cast(last_track_time as date)) openid, cast(last_track_time as date) as d, {LABEL} as source from vst order by openid, cast(last_track_time as date), last_track_time, scene_rank),
    byo as (select vip_num as member_id, source from rec join src_reg_member m on vip_num = m.member_id join daily on rec.openid = daily.openid and d = cast(registration_date as date)),
    link as (select member_id, url_params from src_reg_link where member_id not in (select member_id from src_reg_fix) union all select member_id, url_params from src_reg_fix),
    man as (select distinct on (lower(login_name)) login_name, property_id from src_reg_user u left join src_mall m on u.mall_id = m.mall_id order by lower(login_name), case when status = 'A' then 0 else 1 end, updated_date desc, u.mall_id),
    a as (
      select c.*, url_params, nullif(regexp_extract(url_params, '[?&]utm_source=([^&#]*)', 1), '') as us, nullif(regexp_extract(url_params, '[?&]utm_mall=([^&#]*)', 1), '') as um,
             nullif(regexp_extract(url_params, '[?&]utm_medium=([^&#]*)', 1), '') as ume, nullif(regexp_extract(url_params, '[?&]utm_campaign=([^&#]*)', 1), '') as uc, bym.k, bym.source as ms, byo.source as os, man.property_id as site
      from chan c left join link on c.member_id = link.member_id left join bym on upper(c.member_id) = bym.k left join byo on c.member_id = byo.member_id left join man on c.created_by = man.login_name),
    b as (
      select *, case when from_mall_id in (5004, 5005) then 'x' when channel = 'Website' then url_params when channel = 'Wechat' then coalesce(k, 'scene') end as has_link,
        upper(case when from_mall_id = 5004 then 'telco' when from_mall_id = 5005 then 'bus' when channel = 'Website' and url_params = 'https://h/x/new?inapp=true' then 'inapp' when channel = 'Website' and url_params like 'https://h/camp/%' then 'store'
          when channel = 'Website' then coalesce(us, um) when channel = 'Wechat' and k is not null then ms when channel = 'Wechat' then os when channel = 'Manual Create' then site end) as src from a),
    c as (
      select b.*, case when from_mall_id = 5000 and from_mall_name like 'PQ2%' and (channel is null or channel not in ('Website', 'Wechat') or (channel = 'Website' and url_params is null) or (channel = 'Wechat' and k is null and os is null)) then 1 else 0 end as lost, p.mall as pm
      from b left join (select distinct upper(trackingpath) as tp, mall from src_path_mall) p on p.tp = b.src),
    d as (
      select c.*, case when lost = 1 then 'GATE' when channel = 'Wechat' and pm is not null then upper(pm) when src = 'S3' then 'SX' when src is null then 'OTHERS' else src end as final from c),
    e as (select d.*, coalesce(upper(s.allocate_source), final) as alloc from d left join src_source_map s on upper(s.source) = final),
    sites as (select upper(property_id) as p, min(team) as team, min(mall_type) as mall_type from src_reg_mall group by 1)
    select member_id, registration_date, created_by, mobile_prefix, from_mall_id, from_mall_name, channel, final as source,
           case when lost = 1 then 'QRCODE' when from_mall_id = 5004 then 'TELCO' when from_mall_id = 5005 then 'BUS' when channel = 'Website' then upper(ume) end as medium,
           case when lost = 1 then 'CROSS' when from_mall_id = 5004 then 'TELCO_ONE' when from_mall_id = 5005 then upper(from_mall_name) when channel = 'Website' then upper(uc) end as campaign,
           case when s1.team is null or final = 'P7' then 'NON-MALL' else 'Mall' end as mall_non_mall, case when s1.team is null or final = 'P7' then 'NON-MALL' else s1.team end as team,
           case when lower(s2.mall_type) = 'mall' then 'MALL' else 'NON-MALL' end as allocate_mall_non_mall, case when lower(s2.mall_type) = 'mall' then s2.team else 'NON-MALL' end as allocate_team, alloc as allocate_source
    from e left join sites s1 on final = s1.p left join sites s2 on alloc = s2.p""")
def _(t):
    member, log = t.derived("src_reg_member"), t.derived("src_reg_log")
    seen = registration.tracking_visits(log, RULES)
    out = registration.registration_attribution(
        channel(t), registration.website_links(t.derived("src_reg_link"), t.derived("src_reg_fix")), registration.tracking_by_member(seen, member),
        registration.tracking_by_openid(seen, t.derived("src_reg_receiver"), member), registration.manual_sites(t.derived("src_reg_user"), t.derived("src_mall")), t.derived("src_path_mall"),
        t.derived("src_source_map"), t.derived("src_reg_mall"), RULES)
    return out.drop("link")


PATTERNS = (('"query":{"key":"', "$.query.key", ""), ('"query":{"scene":"', "$.query.scene", ""), ('"query":{"oa":"', "$.query.oa", ""))
TRACK = """
    trk as (
      select 'pages/register' as path, 'o' || user_id as openid, wallclock('2019-01-01 05:00:00') + interval '1' hour * (user_id % 20000) + interval '1' minute * (event_id % 60) as last_track_time,
             case event_type when 'click' then 'p' || (user_id % 30) when 'view' then 'p' || (user_id % 30) when 'purchase' then 'k' || (user_id % 4) else 'MGM-7' end as label, event_type as kind from events where event_type <> 'error')"""


@check("mart_tracking_first_visit", f"""
    with {TRACK}
    select distinct path, openid, last_track_time, 'N/A' as scene, label as extracted_mall_id, coalesce(mall, 'OTHERS') as finalised_mall_id
    from (select *, rank() over (partition by openid order by last_track_time) as r from trk) x left join src_path_mall on upper(trackingpath) = upper(label) where r = 1""")
def _(t):
    out = registration.tracking_attribution(t.derived("src_reg_log"), t.derived("src_path_mall"), pages=["pages/register"], since_year=2019, patterns=PATTERNS)
    return out.distinct()


@check("mart_tracking_by_scene", f"""
    with {TRACK}, f as (select distinct path, openid, last_track_time, label from (select *, rank() over (partition by openid, kind order by last_track_time) as r from trk) x where r = 1)
    select distinct path, openid, last_track_time, 'N/A' as scene, label as extracted_mall_id, coalesce(mall, 'OTHERS') as finalised_mall_id
    from (select *, rank() over (partition by openid, label order by last_track_time) as r from f) y left join src_path_mall on upper(trackingpath) = upper(label) where r = 1""")
def _(t):
    return registration.tracking_attribution(t.derived("src_reg_log"), t.derived("src_path_mall"), pages=["pages/register"], since_year=2019, by_scene=True, patterns=PATTERNS)
