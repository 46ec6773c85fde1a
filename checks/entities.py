"""Source-shaped relations derived from the given tables.

The text is plain SQL that Spark and the oracle both accept, so the marts on the
Spark side and their SQL twins start from the same rows.
"""

ENTITIES: dict[str, str] = {
    # Two-level src_category tree: ordinary tops, a self-parented top, a top that has a
    # parent, children of each, and an orphan.
    "src_category": """
      select 1000 + r_regionkey as category_id,
             case when r_regionkey = 4 then 1000 + r_regionkey when r_regionkey = 3 then 1000 end as parent_id, r_name as name from region
      union all
      select n_nationkey, case when n_nationkey = 7 then 9999 else 1000 + n_regionkey end, n_name from nation""",
    # Campaign rules with open tests: one or two per nation.
    "src_rule": """
      select n_nationkey as rule_id, n_nationkey as nation, case when n_nationkey % 3 = 0 then cast(null as string) when n_nationkey % 3 = 1 then 'F' else 'O' end as status,
             case when n_nationkey % 2 = 0 then cast(null as string) else '1-URGENT' end as priority,
             case when n_nationkey % 5 = 0 then cast(null as double) else 200000.0e0 end as min_amount from nation
      union all
      select 100 + n_nationkey, n_nationkey, 'P', cast(null as string), 50000.0e0 from nation where n_nationkey > 10""",
    # Lists of accepted values of many rules; a rule without rows in a list accepts all.
    "src_offer_status": "select s_suppkey as offer, st from supplier join (select distinct o_orderstatus as st from orders) x on ascii(st) % 4 = (4 - s_suppkey % 4) % 4",
    "src_offer_priority": "select s_suppkey as offer, pr from supplier join (select distinct o_orderpriority as pr from orders) x on ascii(pr) % 5 = (5 - s_suppkey * 7 % 5) % 5 where s_suppkey % 9 > 0",
    "src_offer_month": "select s_suppkey as offer, mo from supplier join (select distinct cast(month(o_orderdate) as int) as mo from orders) x on mo % 3 = (3 - s_suppkey % 3) % 3",
    "src_offer_segment": "select s_suppkey as offer, seg from supplier join (select distinct c_mktsegment as seg from customer) x on length(seg) % 3 = (3 - s_suppkey % 3) % 3",
    "src_offer_nation": "select s_suppkey as offer, n_nationkey as na from supplier join nation on n_nationkey % 4 = (4 - s_suppkey % 4) % 4 where s_suppkey % 3 > 0",
    # Members and their attributes.
    "src_member": """
      select 'M' || c_custkey as member_id, c_custkey as member_no,
             case c_custkey % 8 when 0 then 'W' when 1 then 'L' when 2 then 'S' when 3 then 'V' when 4 then 'X' else 'A' end as status,
             cast(c_custkey % 5 as int) as title, cast(8 + c_custkey % 101 as int) as age, cast(1 + c_custkey % 13 as int) as birth_mth, c_nationkey as district,
             case c_nationkey % 4 when 0 then 'Home SAR' when 1 then 'Macau' when 2 then 'Taiwan' else 'Undefined' end as country_lang1,
             case when c_custkey % 11 = 0 then 'South China' when c_custkey % 13 = 0 then 'Mainland X' else 'City' end as city_lang1,
             case when c_custkey % 7 = 0 then '86' else '852' end as phone_prefix, 'R' || (c_custkey % 9) as referrer,
             'F' || (c_custkey % 50) as first_name_lang1, 'L' || (c_custkey % 40) as last_name_lang1, c_nationkey as from_mall_id, 'U' || (c_custkey % 3) as created_by,
             c_acctbal as balance, wallclock('2019-01-01 05:00:00') + interval '1' hour * (c_custkey % 20000) as registration_date,
             wallclock('2021-01-01 00:00:00') + interval '1' minute * (c_custkey % 90000) as update_date from customer""",
    "src_member_setting": """
      select 'M' || c_custkey as member_id, cast(c_custkey % 5 as int) as default_language, cast(c_custkey % 2 as int) as receive_promotion_msg,
             cast(c_custkey % 3 as int) as receive_promotion_sms, 1 as receive_promotion_email, 0 as receive_promotion_mail, cast(c_nationkey % 2 as int) as receive_promotion_call
      from customer where c_acctbal >= 0""",
    "src_member_profile": "select 'M' || c_custkey as member_id, cast(c_custkey % 6 as int) as member_level_id from customer",
    "src_member_level": "select r_regionkey as member_level_id, r_name as name_lang1 from region",
    "src_district": "select n_nationkey as district, n_name as district_name, lower(n_name) as district_cs from nation where n_nationkey < 22",
    "src_surname": "select 'F' || (s_suppkey % 7) as surname from supplier union all select 'L' || (s_suppkey % 5) from supplier",
    # Spending.
    "src_receipt": """
      select l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber as receipt_id, '00INV-' || l_orderkey || 'r' || l_linenumber as invoice_no,
             case when l_tax = 0.08 then 'none' else 'T' || l_orderkey end as spending_transaction_id, 'U' || l_suppkey as created_by, 'V' || l_suppkey as updated_by,
             l_shipdate + interval '1' hour * (l_partkey % 24) as created_date, l_shipdate as receipt_date, l_shipdate + interval '1' minute * (l_partkey % 1440) as receipt_datetime,
             case l_returnflag || l_linestatus when 'NO' then 'W' when 'RF' then 'R' when 'RO' then 'V' else 'A' end as status, cast(l_suppkey % 26 as int) as mall_id,
             l_partkey as shop_id, case l_linenumber when 1 then 'BoC Pay' when 2 then 'UnionPay' when 3 then 'Visa' when 4 then 'Cash' end as payment_type_lang1,
             cast(l_extendedprice as decimal(18, 2)) as original_amount, cast(l_extendedprice as decimal(18, 2)) as amount, l_shipdate + interval '2' day as updated_date, l_suppkey as ocr_id
      from lineitem""",
    "src_transaction": """
      select 'T' || o_orderkey as spending_transaction_id, o_orderdate + interval '1' hour * (o_custkey % 24) as approval_date,
             case when o_custkey % 9 = 0 then 'Unclear' end as reject_reason_lang1, case o_orderstatus when 'F' then 'B' when 'O' then 'G' else 'Z' end as type, 'M' || o_custkey as member_id,
             case o_orderpriority when '1-URGENT' then 'api' when '2-HIGH' then 'counter' else 'app' end as platform, 'CH' || (o_custkey % 4) as channel,
             case when o_orderpriority <> '5-LOW' then cast((o_custkey * 7) % 90000 as decimal(18, 2)) end as earned_points, o_custkey % 2 = 0 as auto_approved, o_orderdate as updated_date
      from orders""",
    "src_partner_link": "select 'T' || o_orderkey as result, o_custkey % 120 as partner_id, cast(o_custkey % 2 as int) as success from orders where o_orderstatus = 'F'",
    "src_partner": "select s_suppkey as partner_id, s_name as name_lang1 from supplier",
    "src_mall": """
      select n_nationkey as mall_id, 'P' || (n_nationkey % 20) as property_id, case when n_regionkey = 4 then 'Partner' else r_name end as team, n_name as mall_name,
             'D' || n_regionkey as district, case when n_nationkey % 2 = 0 then 'large' else 'small' end as mall_type from nation join region on n_regionkey = r_regionkey""",
    "src_abnormal": "select receipt_id as value from src_receipt where original_amount < 1500",
    "src_shop": """
      select p_partkey as mapping_shop_id, p_name as shop_name, 'P' || (p_size % 20) as property_id, cast(p_size % 25 as int) as mall_id, 'A' || p_partkey as lms_agreement_no,
             upper(p_name) as lms_trade_name, p_brand as lms_standard_brand_name, p_type as lms_standard_trade_category, 'G' || (p_size % 3) as lms_standard_group, p_size as lms_charge_area
      from part where p_size < 48""",
    "src_corrected": "select receipt_id, amount + 1 as correct_receipt_amount from src_receipt where original_amount > 90000",
    "src_duplicate": "select receipt_id from src_receipt where payment_type_lang1 = 'Cash' and shop_id % 10 = 0",
    "src_food_header": """
      select '00INV-' || o_orderkey || 'r1' as invoice_no, cast(o_custkey % 2 as int) as payment_status, case o_orderstatus when 'F' then 2 when 'O' then 12 else 5 end as order_status,
             case when o_orderpriority <> '3-MEDIUM' then 'Active' end as member_status_detail from orders""",
    # Point ledger.
    "src_points": """
      select event_id as bonus_points_transaction_id, 'U' || (user_id % 4) as created_by, ts as created_date,
             case event_type when 'signup' then 'A' when 'error' then 'E' when 'click' then 'S' when 'view' then case when user_id % 2 = 0 then 'D' else 'G' end
               else case user_id % 3 when 0 then 'C' when 1 then 'R' else 'M' end end as action,
             cast(user_id % 25 as int) as mall_id, case when event_type in ('error', 'purchase') then -1 else 1 end * cast(floor(value) as bigint) as points, 'm' || user_id as member_id,
             'T' || event_id as spending_transaction_id, 'G' || event_id as redemption_transaction_id, 'C' || (user_id % 5) as campaign_id,
             case when value > 100 then 'big' || chr(10) || 'one' when value > 50 then 'Clean-up adjustment' else 'note' end as remark, 'Reason ' || (user_id % 3) as adjust_reason_lang1,
             case event_type when 'click' then '{"base_offer":"s' || (user_id % 3) || '"}'
               when 'view' then '{"base_offer":"b","matched_date":"2024-01-01","extra_offer":[{"object_id":"' || user_id || '","name_lang1":" Offer ' || (user_id % 10) || ' "}]}'
               when 'purchase' then '{"base_offer":"p","extra_offer":[{"object_id":"' || user_id || '"},{"object_id":"' || (user_id + 1000) || '","name_lang1":"Two"}]}'
               when 'error' then '{"extra_offer":[]}' end as matched_rules_json, event_id as member_mall_bonus_points_id from events""",
    "src_expiry": """
      select event_id as member_mall_bonus_points_id, ts + interval '1' day as updated_date, case when value < 5 then wallclock('0001-01-01 00:00:00') else ts + interval '365' day end as expiry_date
      from events where event_type <> 'error'""",
    "src_expiry_map": """
      select event_id as from_member_mall_bonus_points_id, case when value > 3 then ts + interval '365' day end as from_expiry_date,
             case when user_id % 2 = 0 then ts + interval '400' day when value > 3 then ts + interval '365' day end as to_expiry_date from events where event_type in ('view', 'purchase')""",
    # Gifts, coupons and their redemptions.
    "src_gift": """
      select cast(p_partkey as string) as gift_id, cast(p_size % 25 as int) as mall_id, cast(p_size % 30 as int) as gift_category_id, case when p_size % 10 = 0 then 'C' end as extra_function,
             p_name as name_lang1, cast(p_retailprice as decimal(18, 2)) as value_amount, cast(p_size % 5 as int) as car_park_redeem_hours, case p_size % 3 when 0 then 'A' when 1 then 'I' else 'Q' end as status,
             case p_partkey % 4 when 0 then 'S' when 1 then 'B' when 2 then 'N' else 'Q' end as type, cast(p_size % 6 as int) as bonus_point_1, cast(p_size * 10 as int) as car_park_min_spending_amount,
             cast(p_size % 3 as int) as unlimited_inventory, wallclock('2018-06-01 00:00:00') + interval '1' day * p_size * 20 as created_date,
             case when p_size % 7 = 0 then null else wallclock('2018-06-01 00:00:00') + interval '1' day * p_size * 10 end as reserve_expiry_date, cast(p_size % 9 as int) as reserve_expiry_day from part""",
    "src_coupon": """
      select cast(100000000 + s_suppkey as string) as coupon_id, cast(s_suppkey % 7 as int) as mall_id, cast(s_nationkey as int) as coupon_category_id,
             case when s_suppkey % 5 = 0 then 'Mall e-Certificate ' || s_suppkey when s_suppkey % 6 = 0 then null else s_name end as name_lang1, cast(s_acctbal as decimal(18, 2)) as value_amount,
             case s_suppkey % 4 when 0 then 'A' when 1 then 'V' else 'I' end as status, case s_suppkey % 4 when 0 then 'S' when 1 then 'N' else 'B' end as type,
             cast(s_suppkey % 2 as int) as unlimited_inventory, wallclock('2020-01-01 00:00:00') + interval '1' day * s_suppkey as created_date,
             wallclock('2018-12-20 00:00:00') + interval '1' day * s_suppkey as usage_expiry_date, cast(s_suppkey % 30 as int) as usage_expiry_day from supplier""",
    "src_coupon_redeem": "select cast(100000000 + s_suppkey as string) as coupon_id, case s_suppkey % 3 when 0 then '0' when 1 then '1,500' else '20' end as bonus_point from supplier",
    "src_gift_redemption": """
      select 'G' || (l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber) as gift_redemption_transaction_id,
             case l_linenumber when 1 then 'P' when 2 then 'R' when 3 then 'C' when 4 then 'F' when 5 then 'L' else 'R' end as status, case l_suppkey % 4 when 0 then 'S' when 1 then 'B' when 2 then 'N' else 'Q' end as redeem_type,
             l_shipdate + interval '1' hour * (l_partkey % 30) as reserve_datetime, l_shipdate + interval '30' day as reserve_expiry_date,
             case when l_linenumber % 2 = 0 then l_shipdate + interval '3' day end as redeem_datetime, case when l_linenumber = 3 then l_shipdate + interval '1' day end as cancel_datetime,
             'M' || (l_suppkey * 3) as member_id, cast(l_partkey as string) as gift_id, cast(l_suppkey % 25 as int) as mall_id, l_linenumber as redeemed_tier, cast(floor(l_quantity) as bigint) % 10 as redeemed_bonus_points,
             cast(case when l_linenumber % 2 = 0 then 0 else l_quantity end as decimal(18, 2)) as redeemed_amount, 'Y' || l_orderkey as payment_transaction_id, l_shipdate as updated_date
      from lineitem where l_returnflag = 'R'""",
    "src_coupon_redemption": """
      select 'C' || (l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber) as coupon_redemption_transaction_id,
             case l_linenumber when 1 then 'R' when 2 then 'U' when 3 then 'C' when 4 then 'E' when 5 then 'W' else 'U' end as status, case l_partkey % 4 when 0 then 'S' when 1 then 'B' when 2 then 'N' else 'Q' end as redeem_type,
             l_shipdate + interval '1' hour * (l_partkey % 30) as redeem_datetime, l_shipdate + interval '60' day as expiry_date, case when l_linenumber % 2 = 0 then l_shipdate + interval '3' day end as used_datetime,
             case when l_linenumber = 3 then l_shipdate + interval '1' day end as cancel_datetime, 'M' || (l_suppkey * 3) as member_id, cast(100000000 + l_suppkey as string) as coupon_id,
             cast(l_partkey % 25 as int) as mall_id, l_linenumber as redeemed_tier, cast(floor(l_quantity) as bigint) % 10 as redeem_bonus_points,
             cast(case when l_linenumber % 2 = 0 then 0 else l_quantity end as decimal(18, 2)) as redeemed_amount, 'REF' || l_orderkey as ref_code, cast(l_suppkey % 25 as int) as used_mall_id,
             l_partkey as used_shop_id, 'Z' || l_orderkey as payment_transaction_id, l_shipdate as updated_date from lineitem where l_returnflag = 'A'""",
    "src_pd_exchange": """
      select 'X' || o_orderkey as trans_id, 'M' || o_custkey as member_id, o_custkey + 100 as points, 'P' || o_orderkey as point_dollar_transaction_id, o_orderdate + interval '1' day as updated_date from orders
      union all select 'Y' || o_orderkey, 'M' || o_custkey, o_custkey, 'R' || o_orderkey, o_orderdate from orders where o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "src_pd": """
      select 'P' || o_orderkey as trans_id, 'P' as trans_type, cast(null as string) as ori_trans_id, o_orderdate as trans_date, cast(o_totalprice as decimal(18, 2)) as amount,
             cast(o_totalprice as decimal(18, 2)) + 10 as total_amount, cast(o_custkey % 25 as int) as mall_id, o_custkey as shop_id from orders where o_orderstatus <> 'P'
      union all
      select 'R' || o_orderkey, 'R', 'P' || o_orderkey, o_orderdate + interval '5' day, cast(o_totalprice as decimal(18, 2)), cast(o_totalprice as decimal(18, 2)), cast(o_custkey % 25 as int), o_custkey
      from orders where o_orderpriority in ('1-URGENT', '3-MEDIUM')""",
    "src_charging": """
      select event_id as bonus_points_transaction_id, 'M' || user_id as member_id, cast(user_id % 25 as string) as mall_id, ts as created_datetime,
             case when value > 15 then 5 else -1 * cast(floor(value) as bigint) - 1 end as points, ts + interval '1' hour as updated_date from events where event_type in ('purchase', 'view')""",
    "src_gift_new_category": "select cast(p_partkey as string) as gift_id, case when p_size < 5 then 'NULL' when p_size < 10 then ' New ' end as new_gift_type, case when p_size > 40 then 'null' when p_size > 35 then 'Sub' end as new_sub_gift_type from part where p_size <> 20",
    "src_gift_brand": "select cast(p_partkey as string) as gift_id, p_brand as reward_brand_id, upper(p_brand) as reward_brand_name, p_type as redeem_method_combination from part where p_partkey % 3 = 0",
    "src_gift_detail": "select cast(p_partkey as string) as gift_id, p_type as trade_category, 'HK$' || case when p_size < 10 then '1,' else '' end || '250.5' as face_value from part where p_size < 30",
    "src_stock": "select cast(p_partkey as string) as parent_id, cast(p_size % 25 as int) as mall_id, cast(p_size * 10 as int) as original_stock_level, cast(p_size * 4 as int) as stock_level from part where p_size % 6 <> 0 union all select cast(100000000 + s_suppkey as string), cast(s_suppkey % 25 as int), 500, 20 from supplier",
    "src_condition": """
      select cast(p_partkey as string) as parent_id, case when p_size % 4 = 0 then '' when p_size % 4 = 1 then '2018-05-01' else '2021-03-01' end as start_date, '2022-0' || (1 + p_size % 9) || '-15' as end_date,
             'D' || (p_size % 3) as frequency_type, cast(p_size % 8 as int) as value, cast(p_size * 100 as int) as min_matched_receipt_total_amount, case when p_size % 5 = 0 then 132 else 7 end as condition_type
      from part where p_size > 12""",
    "src_api_flag": "select cast(p_partkey as string) as gift_id, cast(p_size % 2 as int) as show_in_api from part",
    # Parking.
    "src_visit": """
      select l_returnflag as source_table, l_shipdate + interval '1' minute * (l_partkey % 1440) as car_in_datetime,
             l_shipdate + interval '1' minute * ((l_partkey % 1440) + cast(floor(l_quantity) as bigint)) as car_out_datetime, ' ab' || l_suppkey || ' ' as car_plate,
             case when l_linenumber > 5 then null else ' car ' end as car_type, 'm' || (l_suppkey * 3) as member_id, cast(floor(l_quantity) as int) as parked_minute, 'P' || (l_suppkey % 20) as property_id,
             l_linenumber * 10 as total_paid_minute, l_linenumber * 5 as total_parking_fee, l_linenumber * 2 as total_redeem_minute from lineitem""",
    "src_gate": """
      select 2000 + cast(l_suppkey % 20 as int) as carparkid, l_shipdate + interval '1' minute * (l_partkey % 1440) as timestamp, 'AB' || l_suppkey as lpn, 'IN' as operation from lineitem where l_linestatus = 'O'""",
    "src_site": "select 2000 + n_nationkey as id, case when n_nationkey = 3 then 'Site Three' else 'P' || n_nationkey end as name from nation",
    "src_gate_log": """
      select 'L' || user_id as lpn, 3 + cast(user_id % 3 as int) as carparkid, ts as timestamp, case event_type when 'click' then 'in' when 'purchase' then 'out' else 'other' end as operation from events""",
    "src_hidden_member": "select member_id from src_member where status = 'V'",
    "src_parking_invoice": """
      select l_linestatus as source_table, l_shipdate + interval '10' hour as car_in_datetime, l_shipdate + interval '12' hour as car_out_datetime, ' pl' || l_suppkey as car_plate,
             case when l_linenumber < 4 then 'M' || (l_suppkey * 3) else 'visitor' end as member_id, 'P' || (l_suppkey % 20) as property_id, cast(l_extendedprice as decimal(18, 2)) as invoice_amount,
             '00INV-' || l_orderkey || 'r' || l_linenumber as invoice_no, l_shipdate + interval '11' hour as redemption_datetime, ' food ' as shop_category, cast(null as string) as shop_name, 'S' || l_partkey as shop_no
      from lineitem where l_returnflag <> 'N'""",
    "src_parking_redemption": """
      select event_type as source_table, ts as car_in_datetime, ts + interval '2' hour as car_out_datetime, ts + interval '1' hour as redemption_datetime, ' x' || user_id as car_plate, 'M' || user_id as member_id,
             case when value < 2 then '' else 'P' || (user_id % 20) end as property_id, cast(floor(value) as int) as redeemed_minute, cast(floor(value) as int) * 2 as redeemed_parking_fee, ' ccc ' as redemption_type from events""",
    "src_vehicle": "select case when c_custkey % 17 = 0 then null else ' ab' || c_custkey end as lpn, case when c_custkey % 19 = 0 then '' else 'M' || c_custkey end as memberId, cast(c_custkey % 3 as int) as validationsts from customer",
    "src_tid_log": "select event_id as rlog_id, 'G' || user_id as t_id from events where event_type = 'view'",
    "src_activity_log": "select event_id as log_id, ' pl' || (user_id % 60) as lpn, ts as r_time from events",
    "src_app_redemption": "select 'G' || c_custkey as transaction_id, case when c_custkey % 9 = 0 then '' else 'M' || c_custkey end as member_id, date '2024-01-25' as redeem_date from customer",
    "src_session": """
      select event_id as rsr_id, case event_type when 'click' then 'Settled' when 'view' then 'Unsettled' else 'Open' end as status, ts as createDttm, case when user_id % 4 > 0 then 'M' || user_id end as externalMemberId,
             ' ev' || user_id as lp, 'in' || user_id as lpin, 'out' || user_id as lpOut, cast(value as decimal(18, 2)) as fee from events""",
    "src_user_event": """
      select event_id as log_id, ts as event_time, case when user_id % 23 = 0 then null else 'm' || user_id end as member_id, 'AB' || user_id as lpn, case event_type when 'click' then 7 when 'view' then 2 else 1 end as type,
             cast(user_id % 7 as int) as carpark_id from events""",
    "src_merchant": "select n_nationkey as carpark_id, cast(n_nationkey + 3 as int) as mall_id from nation where n_nationkey < 6",
    "src_autopay_base": "select 'M' || c_custkey as member_id, 1 as autopayment_activate from customer where c_mktsegment = 'BUILDING'",
    "src_autopay_log": "select ' M' || user_id as member_id, case event_type when 'signup' then '1' when 'error' then '-1' else '0' end as autopayment_activate, ts as created_at from events",
    # Registration.
    "src_reg_member": """
      select member_id, registration_date, case when member_no % 6 = 0 then 'staff' || (member_no % 11) else 'api' end as created_by, phone_prefix,
             case member_no % 10 when 1 then 5004 when 2 then 5005 when 3 then 5000 else cast(member_no % 25 as int) end as from_mall_id,
             case member_no % 10 when 1 then 'oneclick' when 2 then 'bus' when 3 then 'PQ2_gate' else 'mall' || (member_no % 25) end as from_mall_name, member_no from src_member""",
    "src_reg_activity": "select member_id, case when member_no % 4 = 3 then 5 else 6 end as action_type, 'k' || (member_no % 6) as api_key from src_reg_member",
    "src_reg_key": "select 'k' || r_regionkey as api_key, case r_regionkey when 0 then 'Portal' when 1 then 'New Wechat key' when 2 then 'Kiosk' when 3 then 'Other' else 'MiniX' end as name from region",
    "src_reg_placed": "select member_id, 17 as from_mall_id, 'placed' as from_mall_name from src_reg_member where member_no % 50 = 9",
    "src_reg_log": """
      select 'o' || user_id as openid, wallclock('2019-01-01 05:00:00') + interval '1' hour * (user_id % 20000) + interval '1' minute * (event_id % 60) as last_track_time,
             case when event_type = 'error' then 'pages/other' else 'pages/register' end as path,
             case event_type when 'click' then '{"path":"p","query":{"scene":"btl-p' || (user_id % 30) || '"},"phone":"1"}' when 'view' then '{"path":"p","query":{"oa":"key%3Dp' || (user_id % 30) || '"},"memberId":"m' || user_id || '"}'
               when 'purchase' then '{"path":"p","query":{"key":"key=k' || (user_id % 4) || '"},"memberId":"m' || user_id || '"}' else '{"query":{"scene":"MGM-7"},"memberId":"M' || user_id || '"}' end as scene from events""",
    "src_reg_receiver": "select 'M' || user_id as vip_num, 'o' || (user_id + case when event_type = 'view' then 1 else 0 end) as openid, ts as created_date from events",
    "src_reg_link": """
      select member_id, case member_no % 5 when 0 then 'https://h/x/new?inapp=true' when 1 then 'https://h/camp/a?utm_source=zz' when 2 then 'https://h/p?utm_source=s' || (member_no % 30) || '&utm_medium=qr&utm_campaign=c1'
               when 3 then 'https://h/p?utm_mall=p' || (member_no % 30) else 'https://h/p' end as url_params from src_reg_member where member_no % 7 <> 0""",
    "src_reg_fix": "select member_id, 'https://h/p?utm_source=fixed' as url_params from src_reg_member where member_no % 40 = 12",
    "src_reg_user": "select 'Staff' || (s_suppkey % 13) as login_name, cast(s_suppkey % 25 as int) as mall_id, case when s_suppkey % 3 = 0 then 'A' else 'I' end as status, wallclock('2020-01-01') + interval '1' day * s_suppkey as updated_date from supplier",
    "src_path_mall": "select 'p' || n_nationkey as trackingpath, 'P' || (n_nationkey % 20) as mall from nation where n_nationkey < 15",
    "src_source_map": "select 'S' || n_nationkey as source, 'p' || (n_nationkey % 20) as allocate_source from nation where n_nationkey > 3",
    "src_reg_mall": "select property_id, team, case when mall_id % 3 = 0 then 'Mall' else 'office' end as mall_type from src_mall where mall_id < 20",
    # Campaigns.
    "src_cspend": """
      select l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber as receipt_id, 'IV-' || (l_partkey % 40) || 'r' as invoice_no,
             o_orderdate + interval '9' hour + interval '6' second * l_linenumber as receipt_upload_datetime, cast(o_orderdate + interval '1' hour as date) as receipt_upload_date,
             cast(o_orderdate + interval '1' day * cast(floor(l_linenumber / 5) as int) as date) as receipt_transaction_date, cast(l_suppkey % 4 as int) as mall_id, 'M' || o_custkey as member_id, l_partkey % 3 as shop_id,
             case when l_linenumber % 2 = 0 then 'VISA' else 'Cash' end as payment_type, cast(l_extendedprice as decimal(18, 2)) as receipt_amount, case when l_tax < 0.05 then 'counter' else 'app' end as platform,
             'B' || (l_partkey % 3) as lms_standard_brand_name, 'C' || (l_partkey % 3) as lms_standard_trade_category from lineitem join orders on l_orderkey = o_orderkey""",
    "src_tier": """
      select 10 * r_regionkey + 1 as tier_id, r_regionkey as spending_campaign_id, 1 as tier_order, 100 as redeem_amount from region
      union all select 10 * r_regionkey + 2, r_regionkey, 2, 200 from region""",
    "src_tier_reward": "select tier_id, 'V' || tier_id as reward_id, 1 as qty from src_tier where tier_id <> 32",
    "src_campaign": """
      select r_regionkey as spending_campaign_id, 'A' as status, wallclock('1995-01-01 00:00:00') as start_date, case when r_regionkey = 4 then wallclock('1996-01-01 00:00:00') else wallclock('2001-12-31 00:00:00') end as end_date,
             'Campaign ' || r_name as name_lang1, 'coupon' as type, r_regionkey as condition_id from region""",
    "src_owner": "select r_regionkey as spending_campaign_id, 'Team ' || r_name as ownership from region where r_regionkey < 3",
    "src_spend_condition": "select r_regionkey as condition_id, case when r_regionkey = 1 then cast(40000 as decimal(18, 2)) end as min_receipt_amount from region",
    "src_condition_mall": "select n_regionkey as condition_id, cast(n_nationkey % 4 as int) as mall_id from nation where n_regionkey in (1, 2) and n_nationkey % 4 < 3 group by 1, 2",
    "src_condition_payment": "select r_regionkey as condition_id, 'VISA' as payment_method from region where r_regionkey = 2",
    "src_condition_shop": "select r_regionkey as condition_id, cast(1 as bigint) as shop_id from region where r_regionkey in (0, 1) union all select r_regionkey, cast(2 as bigint) from region where r_regionkey = 0",
    "src_conversion": """
      select o_orderkey as id, 'M' || o_custkey as member_id, cast(o_custkey % 5 as int) as spending_campaign_id, 10 * cast(o_custkey % 5 as int) + 1 + cast(o_orderkey % 2 as int) as tier_id,
             o_orderdate + interval '10' hour as redemption_date, cast(o_custkey % 4 as int) as mall_id, o_orderdate + interval '9' hour + interval '1' second * (o_custkey % 60) as created_date
      from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "src_ccoupon": """
      select 'K' || o_orderkey as coupon_redemption_transaction_id, case when o_orderstatus = 'F' then 'used' else 'open' end as redemption_status_detail, o_orderdate + interval '10' hour + interval '1' second * (o_custkey % 5 - 2) as coupon_redeem_datetime,
             case when o_custkey % 3 > 0 then o_orderdate + interval '10' hour + interval '1' day * (o_custkey % 3 - 1) end as coupon_used_datetime, cast(o_custkey % 4 as int) as coupon_redeemed_mall_id, cast(o_orderkey % 4 as int) as coupon_used_in_mall_id,
             o_orderkey % 3 as coupon_used_in_shop_id, cast(50 as decimal(18, 2)) as coupon_value_amount, 'M' || o_custkey as redeem_coupon_member_id,
             'V' || (10 * cast(o_custkey % 5 as int) + 1 + cast(o_orderkey % 2 as int)) as coupon_id, cast(o_custkey % 120 as decimal(18, 2)) as min_spending_amount from orders""",
    "src_ccoupon_map": "select o_orderkey as id, 'K' || o_orderkey as redemption_transaction_id from orders where o_orderstatus <> 'P'",
    # Tenant sales and leases.
    "src_lease": """
      select 'E' || p_partkey as agreement_no, case when p_size % 9 = 0 then '#N/A' when p_size % 9 = 1 then ' ' when p_size % 9 = 2 then 'To Be Confirmed' else p_type end as standard_trade_category,
             case when p_size % 11 = 0 then 'None' else p_brand end as standard_brand_name, p_name || '^s' as trade_name, 'U' || p_size as main_unit_no, 'P' || (p_size % 20) as property_id, 'G^' || (p_size % 3) as standard_group,
             p_size as charge_area, case when p_size % 4 <> 0 then '20010' || (1 + p_size % 6) end as updated_month from part where p_size > 3""",
    "src_tenant_sales": """
      select 'E' || l_partkey as agreement_no, n_name || ' MALL' as mall, cast(year(l_shipdate) * 100 + month(l_shipdate) as int) as month, cast(l_extendedprice * 3 as decimal(18, 2)) as lms_sales
      from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey where l_shipdate >= timestamp '2000-01-01' and l_quantity > 35""",
    "src_sales_mall": "select 'P' || n_nationkey as property_id, case when n_nationkey % 2 = 0 then 'East' else 'West' end as team from nation where n_nationkey < 23",
    "src_fact": """
      select l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber as receipt_id, 'M' || (l_suppkey * 3) as member_id, l_partkey as shop_id, 'P' || s_nationkey as property_id, case when s_nationkey % 2 = 0 then 'East' else 'West' end as team,
             cast(l_shipdate as date) as receipt_transaction_date, l_shipdate + interval '10' hour as receipt_upload_datetime, cast(l_shipdate as date) as receipt_upload_date, cast(l_shipdate + interval '1' day * l_linenumber as date) as approve_or_reject_date,
             cast(l_extendedprice as decimal(18, 2)) as receipt_amount, case when l_tax = 0.01 then 'api' else 'app' end as platform, case when p_size % 9 = 3 then '' else p_type end as lms_standard_trade_category, p_brand as lms_standard_brand_name,
             case when l_returnflag = 'R' then 'Rejected' else 'Approved' end as receipt_status_detail, case when l_suppkey % 10 = 0 then 'Suspended' else 'Active' end as member_status_detail, case when l_tax = 0.02 then 1 else 0 end as abnormal_case,
             'G' || (l_suppkey % 3) as gender, p_size as age, 'A' || (p_size % 5) as age_group, 'R' || (l_suppkey % 4) as residence, 'D' || (l_suppkey % 6) as district, 'S' || l_partkey as shop_name, l_quantity as earned_points,
             'I|' || l_orderkey || ',' || l_linenumber as invoice_no, case when l_linenumber = 7 then null else 'pay' || l_linenumber end as payment_type,
             case l_partkey % 3 when 1 then 'partner ' || (l_orderkey % 2) when 2 then 'direct' end as partner
      from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey""",
    "src_pre_shoot": "select receipt_id from src_fact where receipt_amount > 90000",
    "src_abnormal_shop": "select p_partkey as shop_id from part where p_size < 5",
    "src_joined": "select 'P' || n_nationkey as property_id, 200006 as joined_month from nation where n_nationkey in (2, 5)",
    # Shops.
    "src_shop_raw": """
      select p_partkey as shop_id, case p_size % 4 when 0 then 'A' when 1 then 'I' when 2 then 'V' else 'A' end as status, case when p_size % 2 = 0 then 'V' else 'I' end as visible, p_name || chr(10) as name_lang1,
             'F' || (p_size % 4) as floor, case when p_size % 3 = 0 then 'L' || p_size || ',' else 'L' || p_size end as shop_no, cast(p_size % 27 as int) as mall_id from part""",
    "src_mall_raw": "select n_nationkey as mall_id, case when n_nationkey % 3 = 0 then 'I' else 'A' end as status, n_name || chr(10) || 'x' as name_lang1 from nation",
    "src_lease_map": """
      select p_partkey as shop_id, 'E' || p_partkey as lms_agreement_no, '200105' as updated_month from part where p_size > 8
      union all select p_partkey, 'E' || (p_partkey + 1), '200104' from part where p_size > 5""",
    "src_cms_shop": "select p_partkey as id, p_name as shop_name, cast(p_size % 25 as int) as mall_id, p_size as display_main_cat, case when p_size % 5 = 0 then 0 else 1 end as status from part",
    "src_cms_category": "select n_nationkey as id, n_name as category_name from nation",
    "src_rfm_category": "select n_name as cms_trade_cat, lower(n_name) as rfm_trade_cat from nation where n_nationkey < 20",
    # Stamp programme.
    "src_stamp_card": """
      select s_suppkey as id, 'Card ' || s_suppkey as title_en, 'Banner ' || s_suppkey as banner_desc_en, 'Desc' as stamp_desc_en, cast(s_suppkey % 5 as int) as max_no_of_stamp, cast(s_suppkey % 4 as int) as max_no_of_receipt, 50 as max_earn_stamp,
             wallclock('1996-01-01') as createtime, 'A' as status, case when s_suppkey % 6 = 0 then 0 else 19960101 + cast(s_suppkey % 28 as int) end as datefrom_collect, 20001231 as dateto_collect, 19960201 as datefrom_gift, 20010131 as dateto_gift,
             case when s_suppkey % 3 = 0 then (s_suppkey * 10) || ':2' else (s_suppkey * 10) || ':1|500:2' end as earn_stamp_rule1_str, 'a|@|G' || s_suppkey || ':b|@|' || (s_suppkey * 2) as gift_tier_str, '5:10' as gift_stamp_required_str, '0:1' as gift_requires_approval_str
      from supplier""",
    "src_stamp_inventory": "select 'G' || p_partkey as gift_id, 'T' || p_size as team, 'A' as gift_status, wallclock('1999-05-05') as created_datetime, p_name as name_en, case when p_size % 2 = 0 then date '1999-06-01' end as redemption_date_start, date '2000-06-01' as redemption_date_end, p_size as original_stock_level from part where p_size > 20",
    "src_stamp_record": """
      select l_orderkey * 1000000 + l_partkey * 100 + l_linenumber * 10 + l_suppkey % 10 as id, 'M' || (l_suppkey * 3) as vid, l_suppkey as cardid, case when l_tax = 0.03 then 0 else 1 end as no_of_receipt, l_linenumber - 2 as earn_stamp,
             l_shipdate + interval '5' hour as lastupdate, (l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber) || '::' || (l_orderkey + 7) || '::0' as receipt_id from lineitem where l_returnflag = 'A'""",
    "src_stamp_redemption": """
      select 'M' || o_custkey as vid, o_custkey % 100 as cardid, case when o_custkey % 2 = 0 then 't|@|G' || o_custkey else 't|@|' || o_custkey end as gift_tier_str, cast(o_custkey % 20 as int) as gift_stamp_required, cast(o_custkey % 26 as int) as pickup_mall_id,
             o_orderstatus as redeem_status, case when o_orderpriority = '5-LOW' then '0' else replace(cast(cast(o_orderdate as date) as string), '-', '') end as redeem_date, o_orderdate as recordtime from orders""",
    "src_stamp_shop": "select p_partkey % 50 as cardid, case when p_size % 10 = 0 then 'bad' else (p_size % 25) || '-' || p_partkey end as shopid, p_name as shopname_en from part",
    # Missions.
    "src_mission_record": "select case when user_id % 2 = 0 then 'spending' else 'reward' end as mission_type, cast(user_id % 12 as int) as missionid, 'M' || user_id as vid, cast(floor(value) as int) as redeemed_bonus_points from events",
    "src_mission": "select n_nationkey as id, case when n_nationkey % 3 = 0 then 'spending' when n_nationkey % 3 = 1 then 'reward' else 'other' end as mission_type, n_nationkey * 2 as spending_total_no_receipt, n_nationkey * 3 as reward_total_redeem from nation where n_nationkey < 10",
    "src_mission_completed": "select cast(user_id % 12 as int) as missionid, 'M' || user_id as vid, case when event_type = 'purchase' and value > 40 then 'yes' else 'no' end as is_redeemed from events where user_id % 4 <> 1",
    # Cross-business.
    "src_linkage": """
      select 'h' || c_custkey as hashmobileno, c_custkey as globalcustid, 'M' || c_custkey as member_id, case when c_custkey % 2 = 0 then 'Store Member' else 'none' end as lobmemid_store, case when c_custkey % 3 = 0 then 'TELCO member' end as lobmemid_telco,
             wallclock('2022-01-01') as createdttm from customer""",
    "src_store_profile": "select 'h' || o_custkey as hashmobileno, o_orderdate as regdttm from orders where o_orderstatus = 'F'",
    "src_telco_profile": "select 'h' || o_custkey as hashmobileno, o_orderdate as regdttm from orders where o_orderstatus = 'P' and o_totalprice > 200000",
    "src_attribute": "select c_custkey as id, c_mktsegment as cat, case when c_custkey % 5 = 0 then 'n/a' else '2022-0' || (1 + c_custkey % 9) || '-11 08:00:00' end as createdttm from customer",
    "src_rfm": "select c_custkey as id, cast(c_custkey % 90 as string) as recency, case when c_custkey % 7 = 0 then '' else cast(c_nationkey as string) end as frequency, cast(c_custkey % 100 as string) || '.5' as monetary, '2022-01-15 00:00' as ref_date from customer",
    "src_car_profile": "select 'M' || o_custkey as member_id, ' brand' || (o_custkey % 40) || ' ' as brand, ' ab' || (o_custkey % 200) as car_plate, replace(cast(cast(o_orderdate as date) as string), '-', '') as last_seen from orders",
    "src_calendar": "select cast(cast(l_shipdate as date) as string) as tag, case when l_tax = 0.08 then 12 else 3 end as type, case when l_linenumber = 1 then 'I' else 'A' end as status from lineitem where l_quantity = 50",
    # Content.
    "src_coupon_json": """
      select s_suppkey as coupon_id, case when s_suppkey % 4 <> 0 then '{"' || s_nationkey || '":["' || s_suppkey || '","x"],"9":["' || s_nationkey || '"]}' end as usage_shop_id,
             case when s_suppkey % 5 = 0 then 'bad json' when s_suppkey % 5 = 1 then '[{"bonus_point":"1,' || (100 + s_suppkey % 800) || '","member_level_id":"1"},{"bonus_point":"7"}]' when s_suppkey % 5 < 4 then '[{"bonus_point":"' || s_suppkey || '"}]' end as redeem_bonus_points,
             case when s_suppkey % 3 = 0 then wallclock('0001-01-01') else wallclock('2022-01-01') end as usage_expiry_date, s_name as name_lang1,
             case when s_suppkey % 2 = 0 then '[{"tier":1,"amount":"0","bonus_point":"' || s_suppkey || '"},{"tier":2,"amount":"' || s_nationkey || '","bonus_point":"5"}]' end as redeem_bonus_points_with_cash,
             case when s_suppkey % 10 = 0 then 9999999 else cast(s_nationkey as int) end as reward_brand_id from supplier""",
    "src_gift_json": """
      select p_partkey as gift_id, p_name as name_lang1, case when p_size % 8 = 0 then wallclock('0001-01-01') when p_size % 8 = 1 then null else wallclock('2022-01-01') end as reserve_expiry_date,
             '[{"bonus_point":"' || p_size || '","member_level_id":"' || (p_size % 4) || '"}]' as redeem_bonus_points, case when p_size % 3 = 0 then '{"car_park_redeem_hours":' || (p_size % 5) || '}' end as extra_data,
             case when p_size % 4 = 0 then '[{"tier":1,"amount":"' || p_size || '","bonus_point":"0"},{"tier":2,"amount":"' || (p_size + 1) || '","bonus_point":"0"}]' when p_size % 4 = 1 then '[{"tier":1,"amount":"0","bonus_point":"0"}]' end as redeem_bonus_points_with_cash,
             cast(p_size as int) as reward_brand_id from part""",
    "src_typed_condition": """
      select p_partkey as parent_id, 'T' || (p_size % 3) as type, 'A' as status, 1 as condition_type, '{"frequency_type":"D' || (p_size % 4) || '","value":"' || p_size || '"}' as condition_json from part
      union all select p_partkey, 'T' || (p_size % 3), 'A', 2, '{"weekday":["' || (p_size % 7) || '","' || ((p_size + 1) % 7) || '"]}' from part where p_size % 2 = 0""",
    "src_brand": "select s_suppkey as brand_id, s_name as brand_name, cast(s_nationkey as int) as brand_category_id, case when s_suppkey % 6 = 0 then '[]' else '[{\"mall_id\":' || s_nationkey || ',\"shop_id\":[' || s_suppkey || ',7]},{\"mall_id\":3,\"shop_id\":[9]}]' end as shop_id_list from supplier",
    "src_brand_category": "select n_nationkey as brand_category_id, n_name as name_lang1 from nation where n_nationkey < 20",
    # Feeds.
    "src_food_order": """
      select case when o_orderpriority = '5-LOW' then 'X' || o_orderkey else 'M' || (o_custkey % 25) || 'S' || o_custkey || 'R' || o_orderkey end as invoice_no, o_orderdate as purchase_date, o_orderdate + interval '20' hour as create_date,
             case o_orderstatus when 'F' then 0 when 'O' then 12 else 7 end as status, 'M' || o_custkey as member_no, cast(o_totalprice as decimal(18, 2)) as original_amount, cast(o_totalprice as decimal(18, 2)) - 5 as sales_amount, o_orderdate + interval '30' hour as last_update_date from orders""",
    "src_food_payment": "select invoice_no, case when status = 0 then -1 when status = 12 then 1 else 5 end as payment_status, 'card' as pay_method from src_food_order where status <> 7",
    "src_history_row": "select event_id, user_id, cast(user_id % 9 as int) as action_type, '10.0.0.1' as ip_address from events",
    "src_carpark_member": "select c_custkey as id, 'M' || c_custkey as memid, cast(c_custkey % 4 as int) as status_fa, cast(c_custkey % 3 as int) as status_ps from customer",
    "src_update_record": "select 'M' || user_id as mem_id, cast(user_id % 4 as int) as action, ts as created_at from events",
    "src_autopay_list": "select event_id as id, cast(user_id % 6 as int) as carpark_id, 'M' || user_id as member_id, case when user_id % 10 = 0 then null else 'ab' || user_id end as car_plate, cast(user_id % 5 as int) as payment_type, cast(event_id % 5 as int) as payment_result from events",
    "src_carpark_list": "select n_nationkey as carparkid, n_nationkey * 10 as mallid from nation where n_nationkey < 5",
    "src_partner_mapping": "select o_orderkey as mapping_id, 'p' || (o_custkey % 1600) as phone, o_orderstatus as status from orders",
    "src_phone": "select 'p' || c_custkey as phone, 'M' || c_custkey as member_id from customer",
    "src_reward_tag": "select event_id as id, cast(user_id % 30 as int) as tag_id from events",
    "src_tag": "select n_nationkey as tag_id, n_name as name_lang1 from nation",
    "src_sso": "select event_id as mapping_id, cast(user_id % 8 as int) as app_id, 'acc' || user_id as account_id, case when event_type = 'view' then null when event_type = 'click' then 'h1,h' || user_id || ';' else 'h' || user_id end as data from events",
    "src_application": "select r_regionkey as app_id, r_name as app_name from region",
    "src_earn": "select event_id as id, ts as datetime, case event_type when 'view' then 'N' when 'click' then 'W' when 'error' then 'P' else 'Z' end as valid_to_earn_point from events",
    "src_device": "select event_id, 'M' || user_id as member_id, ts as created_date, ts + interval '30' hour as updated_date from events",
    "src_profile_text": "select 'M' || c_custkey as member_id, case when c_custkey % 9 = 0 then '' else cast(c_nationkey as string) end as visits, case when c_custkey % 7 = 0 then 'x' else cast(c_custkey as string) || '.25' end as spend, '2022/0' || (1 + c_custkey % 9) || '/03' as joined from customer",
    "src_migrated": "select 'M' || c_custkey as member_id, 1 as is_migrated_any, cast(c_custkey % 2 as int) as is_migrated_p1 from customer where c_mktsegment = 'BUILDING'",
    # Activity feed.
    "src_feed_ledger": """
      select event_id as bonus_points_transaction_id, case event_type when 'view' then 'D' when 'signup' then 'A' when 'error' then case when user_id % 2 = 0 then 'E' else 'Z' end else case user_id % 4 when 0 then 'C' when 1 then 'M' when 2 then 'R' else 'T' end end as action,
             cast(user_id % 25 as int) as mall_id, 'A' as status, 'M' || user_id as member_id, cast(floor(value) as bigint) as points, case when value > 20 then 'Used Point Dollar Spending' when value > 10 then 'Other' end as adjust_reason_lang1,
             case when value > 10 then 'Grund ' || (user_id % 3) end as adjust_reason_lang2, 'Raison ' || (user_id % 3) as adjust_reason_lang3,
             case when event_type = 'signup' then 'X' || event_id when event_type = 'click' then 'GR' || event_id when event_type = 'purchase' then case user_id % 3 when 0 then 'CR' || event_id when 1 then 'ER' || event_id end end as redemption_transaction_id,
             case when event_type in ('view', 'click') then '{"extra_offer":[{"name_lang1":"' || case when user_id % 2 = 0 then 'Point Conversion ' else 'Gift ' end || user_id || case when user_id % 3 > 0 then '","name_lang2":"Angebot ' || user_id || '","name_lang3":"Offre' else '' end || '"}]}' end as matched_rules_json, 'T' || event_id as spending_transaction_id,
             ts as created_date, ts + interval '1' hour as updated_date from events""",
    "src_feed_exchange": "select 'X' || event_id as trans_id, 'PD' || event_id as point_dollar_transaction_id, 'S' as status from events where event_type = 'signup' and user_id % 5 <> 0",
    "src_feed_pd": "select 'PD' || event_id as trans_id, 'P' as trans_type, cast(user_id % 25 as int) as mall_id, user_id as shop_id, event_id as amount from events where event_type = 'signup'",
    "src_feed_gift_redemption": """
      select 'GR' || event_id as gift_redemption_transaction_id, user_id as gift_id, 'R' as status, 'B' as redeem_type, cast(user_id % 7 as int) as mall_id, event_id as redeemed_amount, case when user_id % 2 = 0 then ts + interval '1' day end as cancel_datetime,
             'Y' || event_id as payment_transaction_id, ts + interval '2' hour as updated_date from events where event_type = 'click' and user_id % 11 <> 0""",
    "src_feed_gift": "select c_custkey as gift_id, case when c_custkey % 3 = 0 then 'Free Parking ' || c_custkey else 'Mug \"' || c_custkey || '\"' end as name_lang1 from customer",
    "src_feed_coupon_redemption": """
      select 'CR' || event_id as coupon_redemption_transaction_id, user_id as coupon_id, 'U' as status, 'N' as redeem_type, cast(user_id % 7 as int) as mall_id, cast(user_id % 9 as int) as used_mall_id, user_id as used_shop_id, event_id as redeemed_amount,
             ts + interval '30' day as expiry_date, cast(null as timestamp) as cancel_datetime, ts + interval '3' day as used_datetime, 'Y' || event_id as payment_transaction_id, ts - interval '2' hour as updated_date from events where event_type = 'purchase'""",
    "src_feed_coupon": "select c_custkey as coupon_id, 'Coupon ' || c_custkey as name_lang1 from customer",
    "src_feed_event_redemption": "select 'ER' || event_id as event_redemption_transaction_id, user_id as event_id, 'R' as status, 'B' as redeem_type, cast(user_id % 7 as int) as mall_id, 'Show ' || user_id as event_name, ts + interval '9' day as session_end, ts + interval '9' hour as updated_date from events where event_type = 'purchase'",
    "src_feed_event": "select c_custkey as event_id, 'Event ' || c_custkey as name_lang1, 'Anlass "' || c_custkey || '"' as name_lang2, case when c_custkey % 2 = 0 then 'Fete' end as name_lang3 from customer where c_custkey < 100",
    "src_feed_payment": "select 'Y' || event_id as payment_transaction_id, 'REF' || event_id as order_reference_no, 'card' as payment_type, 'P' as status, ts + interval '5' minute as created_date from events where user_id % 3 <> 1",
    # Customer system.
    "src_crm_member": """
      select member_id, member_no, title, first_name_lang1, last_name_lang1, from_mall_id, age, birth_mth, registration_date, update_date, status, country_lang1, 'p' || member_no as phone,
             case when member_no % 4 = 0 then 'N/A' when member_no % 9 = 0 then null else 'D' || district end as district_lang1, case when member_no % 3 = 0 then 'N/A' else 'S' || district end as sub_district_lang1 from src_member""",
    "src_crm_setting": "select member_id, default_language, receive_promotion_msg, receive_promotion_sms, receive_promotion_email, receive_promotion_mail, receive_promotion_call, wallclock('2021-02-01 00:00:00') as updated_date from src_member_setting",
    "src_crm_binding": "select 'p' || o_custkey as phone, 5000 + cast(o_orderkey % 5 as int) as app_id, case when o_orderstatus = 'F' then 'A' else 'I' end as status, o_orderdate + interval '7305' day as updated_date from orders",
    "src_crm_vehicle": "select case when c_custkey % 17 = 0 then null else ' ab' || c_custkey end as lpn, 'm' || c_custkey as memberId, cast(c_custkey % 3 as int) as validationsts from customer where c_custkey % 2 = 0",
    "src_crm_carpark": "select n_nationkey as id, n_nationkey + 40 as mallid from nation where n_nationkey < 5",
    # Directory.
    "src_dir_mall": "select case when n_nationkey < 5 then 2000 + n_nationkey when n_nationkey < 8 then 5000 + n_nationkey when n_nationkey < 10 then 6000 + n_nationkey when n_nationkey < 12 then 7000 + n_nationkey when n_nationkey = 12 then 950 else n_nationkey end as mall_id, n_nationkey as cms_mall_id, n_name as name_lang1, case n_nationkey % 4 when 0 then 'A' when 1 then 'I' when 2 then 'V' else 'Q' end as status from nation",
    "src_dir_site": "select n_nationkey as id, lower(n_name) as mall_name_en, case when n_nationkey % 5 = 4 then null else n_nationkey % 3 end as district, case when n_nationkey % 2 = 0 then 'www.x' || n_nationkey else 'https://y' end as website_url, cast(n_nationkey % 2 as int) as status, case when n_nationkey % 3 = 0 then 'Road ' || n_nationkey end as loc_long_en from nation where n_nationkey < 22",
    "src_dir_carpark": "select s_suppkey as carpark_id, s_name as name, cast(s_nationkey as int) as mallid from supplier",
    "src_dir_carpark_site": "select s_suppkey as id, lower(s_name) as name_en from supplier where s_suppkey % 3 = 0",
    "src_dir_floor": "select p_partkey as id, case when p_size % 3 = 0 then null else wallclock('2020-01-01') end as create_date, case when p_size % 4 = 0 then null else wallclock('2021-01-01') end as last_update_date, 'F' || p_size as floor_name_en, cast(p_size % 25 as int) as mall_id, cast(p_size % 2 as int) as status, cast(p_size % 7 as int) as floor_phase from part",
    "src_dir_phase": "select s_suppkey as phase_id, case when s_suppkey % 2 = 0 then '' else 'tel' end as phone, case when s_suppkey % 3 = 0 then '' else 'Phase ' || s_suppkey end as phase_name_en, cast(s_nationkey as int) as mall, cast(s_suppkey % 4 as int) as status from supplier",
    "src_dir_category": "select p_partkey as id, p_name as category_name_en, case when p_size % 5 = 0 then null else cast(p_partkey % 40 as bigint) end as main_cat, case when p_size % 7 = 0 then 0 else 1 end as status, cast(p_size % 2 as int) as type from part",
    "src_dir_partner": "select s_suppkey as partner_id, s_name as name_lang1 from supplier",
    "src_dir_brand": "select p_partkey as brand_id, cast(p_size as bigint) as brand_category_id, case when p_size % 2 = 0 then 'A' else 'I' end as status from part",
    "src_dir_shop": "select p_partkey as id, p_name as shop_name, cast(p_size % 4 as int) as ticket_type, case when p_size % 5 = 0 then 0 else 1 end as status, cast(p_size % 25 as int) as mall_id, case when p_size % 9 = 0 then '' else p_size || ', ' || (p_size + 11) || ',' || (p_size % 10) || ',1' || p_size end as floor from part",
    "src_dir_partner_shop": "select p_partkey as shop_id, 5001 as partner_id, 'Y' || p_partkey as partner_shop_id from part where p_size % 2 = 0 union all select p_partkey, 5004, 'Z' || p_partkey from part where p_size % 3 = 0",
}
