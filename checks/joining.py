"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from martkit.functions import text
from martkit.operators import joins, latest, matching, ordered, reduction, rules, sets


@check("join01_enrichment_chain", """
    select l_orderkey, l_linenumber, l_partkey, o_orderstatus, c_name, n_name, r_name from lineitem
    left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
    left join region on n_regionkey = r_regionkey""")
def _(t):
    out = joins.enrich(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), [
        (t.orders, {"o_orderkey": "l_orderkey"}, {"o_orderstatus": "o_orderstatus", "o_custkey": "ck"}),
        (t.customer, {"c_custkey": "ck"}, {"c_name": "c_name", "c_nationkey": "nk"}),
        (t.nation, {"n_nationkey": "nk"}, {"n_name": "n_name", "n_regionkey": "rk"}),
        (t.region, {"r_regionkey": "rk"}, {"r_name": "r_name"})])
    return out.drop("ck", "nk", "rk")


@check("join01_hot_keys", "select event_id, c_name from events left join customer on user_id = c_custkey")
def _(t):
    return joins.enrich_hot(t.events.select("event_id", "user_id"), t.customer, {"c_custkey": "user_id"}, {"c_name": "c_name"}).drop("user_id")


@check("join02_inner", "select o_orderkey, c_name from orders join customer on o_custkey = c_custkey where c_acctbal > 5000")
def _(t):
    return t.orders.join(t.customer.filter("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@check("join03_flatten_hierarchy", """
    select category_id, name as top_name from src_category where parent_id is null or parent_id = category_id
    union all
    select c.category_id, p.name from src_category c left join src_category p on c.parent_id = p.category_id
    where c.parent_id is not null and c.parent_id <> c.category_id and p.parent_id is null""")
def _(t):
    return joins.flatten_hierarchy(t.derived("src_category"), "category_id", "parent_id", "name")


@check("join04_composite_key", """
    select r.l_orderkey, r.l_suppkey, r.n_returned, s.n_lines from
      (select l_orderkey, l_suppkey, count(*) as n_returned from lineitem where l_returnflag = 'R' group by 1, 2) r
      join (select l_orderkey, l_suppkey, count(*) as n_lines from lineitem group by 1, 2) s on r.l_orderkey = s.l_orderkey and r.l_suppkey = s.l_suppkey""")
def _(t):
    keys = ["l_orderkey", "l_suppkey"]
    returned = t.lineitem.filter("l_returnflag = 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_returned"))
    return returned.join(t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines")), keys)


@check("join05_folded_key", "select c_custkey, upper(c_name) as shouted from customer")
def _(t):
    noisy = t.customer.select("c_custkey", F.replace(F.upper("c_name"), F.lit("#"), F.lit(" # ")).alias("key"))
    names = t.customer.select(F.col("c_name").alias("name"), F.upper("c_name").alias("shout"))
    return joins.join_folded(noisy, names, "key", "name", {"shout": "shouted"}).select("c_custkey", "shouted")


@check("join06_match_key", """
    select o_orderkey, first_order, n_same from orders a join (
      select o_custkey as c, o_orderdate as d, nullif(o_orderstatus, 'P') as s, min(o_orderkey) as first_order, count(*) as n_same from orders group by 1, 2, 3) b
      on a.o_custkey = c and a.o_orderdate = d and nullif(a.o_orderstatus, 'P') = s""")
def _(t):
    key = text.match_key(F.to_date("o_orderdate"), F.col("o_custkey"), F.nullif("o_orderstatus", F.lit("P")))
    rows = t.orders.select("o_orderkey", key.alias("key"))
    known = rows.groupBy(F.col("key").alias("known_key")).agg(F.min("o_orderkey").alias("first_order"), F.count(F.lit(1)).alias("n_same"))
    return rows.join(known, F.col("key") == F.col("known_key")).select("o_orderkey", "first_order", "n_same")


@check("join07_timestamp_condition_list", """
    select e.event_id, case when g.user_id is not null then 1 else 0 end as contactless from events e
    left join (select distinct user_id, ts from events where event_type = 'click') g on e.user_id = g.user_id and e.ts = g.ts""")
def _(t):
    gate = t.events.filter("event_type = 'click'")
    return joins.flag_exists(t.events.select("event_id", "user_id", "ts"), gate, {"user_id": "user_id", "ts": "ts"}, "contactless").select("event_id", "contactless")


@check("join08_anti_join", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def _(t):
    return joins.anti(t.orders, t.lineitem, {"l_orderkey": "o_orderkey"}).select("o_orderkey")


@check("join08_anti_reduced", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 49)")
def _(t):
    return reduction.anti_reduced(t.orders.select("o_orderkey"), t.lineitem.filter("l_quantity > 49"), {"l_orderkey": "o_orderkey"})


@check("join09_not_in_null_aware", """
    select 'plain' as mode, count(*) as n from orders where o_orderkey not in (select l_orderkey from lineitem)
    union all select 'null on the right', count(*) from orders where o_orderkey not in (select nullif(l_orderkey, 1) from lineitem)
    union all select 'null on the left', count(*) from orders where nullif(o_orderkey, 1) not in (select l_orderkey from lineitem)
    union all select 'empty right', count(*) from orders where nullif(o_orderkey, 1) not in (select l_orderkey from lineitem where l_quantity < 0)""")
def _(t):
    holed = t.orders.withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(1)))
    cases = {
        "plain": (t.orders, t.lineitem),
        "null on the right": (t.orders, t.lineitem.withColumn("l_orderkey", F.nullif("l_orderkey", F.lit(1)))),
        "null on the left": (holed, t.lineitem),
        "empty right": (holed, t.lineitem.filter("l_quantity < 0")),
    }
    return sets.union_all(*[joins.anti_null_aware(a, b, {"l_orderkey": "o_orderkey"}).agg(F.count(F.lit(1)).alias("n")).withColumn("mode", F.lit(m))
                            for m, (a, b) in cases.items()])


@check("join09_not_in_pair", """
    select o_orderkey from orders where o_custkey || '|' || o_orderstatus not in
      (select o_custkey || '|' || o_orderstatus from orders where o_totalprice > 300000)""")
def _(t):
    rich = t.orders.filter("o_totalprice > 300000")
    return joins.anti_null_aware(t.orders, rich, {"o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus"}).select("o_orderkey")


@check("join10_semi_join", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def _(t):
    return joins.semi(t.customer, t.orders.filter("o_totalprice > 400000"), {"o_custkey": "c_custkey"}).select("c_custkey")


@check("join11_range_join_day_count", """
    select o_orderkey, (select count(*) from (select distinct cast(l_shipdate as date) as d from lineitem where l_quantity = 50 and l_tax = 0.08) h
      where h.d between cast(o_orderdate as date) and coalesce(done, date '2001-08-01')) as holidays
    from (select o_orderkey, o_orderdate, case when o_orderstatus <> 'P' then cast(o_orderdate as date) + cast(o_custkey % 40 as int) - 5 end as done from orders) x""")
def _(t):
    df = t.orders.select("o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.date_add(
        F.to_date("o_orderdate"), (F.col("o_custkey") % 40).cast("int") - 5)).alias("done"))
    calendar = t.lineitem.filter("l_quantity = 50 and l_tax = 0.08").select("l_shipdate")
    return matching.count_days_between(df, "o_orderdate", "done", calendar, "l_shipdate", "holidays", "2001-08-01").select("o_orderkey", "holidays")


@check("join12_interval_join", """
    select a.event_id, b.event_id as other_id from events a join events b on a.user_id = b.user_id
      and b.ts between a.ts - interval '1900' second and a.ts + interval '7200' second
    where a.event_type = 'click' and b.event_type = 'purchase'""")
def _(t):
    a = t.events.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    b = t.events.filter("event_type = 'purchase'").select(F.col("event_id").alias("other_id"), F.col("user_id").alias("u2"), F.col("ts").alias("ts2"))
    return matching.interval_join(a, b, {"user_id": "u2"}, "ts", "ts2", 1900, 7200).select("event_id", "other_id")


@check("join13_next_event_pairing", """
    select e.event_id, (select min(o.ts) from events o where o.user_id = e.user_id and o.event_type = 'purchase' and o.ts > e.ts) as out_ts
    from events e where e.event_type = 'click'""")
def _(t):
    return ordered.pair_next(t.events, ["user_id"], "ts", "event_type", "click", "purchase", "out_ts", ordered.day_blocks("ts")).select("event_id", "out_ts")


@check("join14_allocation_waterfall", """
    select l_orderkey, l_linenumber, l_partkey, l_quantity,
           case when pool - coalesce(prior, 0) > l_quantity then l_quantity when pool - coalesce(prior, 0) > 0 then pool - coalesce(prior, 0) else 0 end as allocated
    from (select l.*, cast(o_custkey % 150 as double) as pool,
            (select sum(p.l_quantity) from lineitem p where p.l_orderkey = l.l_orderkey and p.l_linenumber < l.l_linenumber) as prior
          from lineitem l left join orders on o_orderkey = l_orderkey and o_orderstatus <> 'P') x""")
def _(t):
    pools = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", (F.col("o_custkey") % 150).cast("double").alias("pool"))
    rows = joins.enrich(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), [(pools, {"o_orderkey": "l_orderkey"}, {"pool": "pool"})])
    return ordered.allocate(rows, ["l_orderkey"], "l_linenumber", "l_quantity", "pool", "allocated", ordered.id_blocks("l_linenumber", 4)).drop("pool")


@check("join15_flag_gated_join", """
    select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey and c_mktsegment = 'BUILDING'""")
def _(t):
    return joins.enrich_gated(t.customer.select("c_custkey", "c_mktsegment"), t.orders, {"o_custkey": "c_custkey"}, F.col("c_mktsegment") == "BUILDING",
                              {"o_orderkey": "o_orderkey"}).drop("c_mktsegment")


@check("join16_role_playing_dimension", """
    select l_orderkey, l_linenumber, l_partkey, s.n_name as supplier_n_name, c.n_name as customer_n_name from lineitem
    left join supplier on l_suppkey = s_suppkey left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
    left join nation s on s_nationkey = s.n_nationkey left join nation c on c_nationkey = c.n_nationkey""")
def _(t):
    rows = joins.enrich(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), [
        (t.supplier, {"s_suppkey": "l_suppkey"}, {"s_nationkey": "sn"}), (t.orders, {"o_orderkey": "l_orderkey"}, {"o_custkey": "ck"}),
        (t.customer, {"c_custkey": "ck"}, {"c_nationkey": "cn"})])
    return joins.enrich_roles(rows, t.nation, "n_nationkey", {"supplier": "sn", "customer": "cn"}, ["n_name"]).drop("l_suppkey", "sn", "cn", "ck")


@check("join17_pivot_codes", """
    select o_custkey, min(case when o_orderstatus = 'F' then o_orderkey end) as "o_orderkey_F", min(case when o_orderstatus = 'O' then o_orderkey end) as "o_orderkey_O"
    from orders where o_orderstatus in ('F', 'O') group by o_custkey""")
def _(t):
    return joins.pivot_codes(t.orders, ["o_custkey"], "o_orderstatus", "o_orderkey", ["F", "O"])


@check("join18_case_key", """
    select c_custkey, r_name from customer left join region on r_regionkey = case when c_acctbal < 0 then 0 when c_acctbal < 5000 then 1 else 2 end""")
def _(t):
    key = F.when(F.col("c_acctbal") < 0, 0).when(F.col("c_acctbal") < 5000, 1).otherwise(2)
    return joins.enrich(t.customer.select("c_custkey", "c_acctbal"), [(t.region, {"r_regionkey": key}, {"r_name": "r_name"})]).drop("c_acctbal")


RECON = """
    with a as (select strftime(o_orderdate, '%Y%m') as ym, c_nationkey as nation, count(*) as n_orders from orders join customer on o_custkey = c_custkey
               where o_orderdate >= timestamp '1999-01-01' and o_totalprice > 250000 group by 1, 2),
         b as (select strftime(l_shipdate, '%Y%m') as ym, s_nationkey as nation, count(*) as n_lines from lineitem join supplier on l_suppkey = s_suppkey
               where l_quantity > 45 group by 1, 2)
    select a.ym, a.nation, a.n_orders, b.n_lines, case when b.ym is null then 'left' else 'both' end as matched from a left join b on a.ym = b.ym and a.nation = b.nation
    union all
    select b.ym, b.nation, null, b.n_lines, 'right' from b left join a on a.ym = b.ym and a.nation = b.nation where a.ym is null and b.ym in (select ym from a)"""


@check("join19_reconcile", RECON)
def _(t):
    a = t.orders.filter("o_orderdate >= timestamp_ntz'1999-01-01' and o_totalprice > 250000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    a = a.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("ym"), F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.filter("l_quantity > 45").join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    b = b.groupBy(F.date_format("l_shipdate", "yyyyMM").alias("ym"), F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n_lines"))
    return joins.reconcile(a, b, ["ym", "nation"], "ym", ["n_orders"], ["n_lines"])


@check("join20_wildcard_rules", """
    select o_orderkey, rule_id from orders join customer on o_custkey = c_custkey join src_rule r on r.nation = c_nationkey
      and (r.status is null or r.status = o_orderstatus) and (r.priority is null or r.priority = o_orderpriority)
      and (r.min_amount is null or o_totalprice >= r.min_amount)""")
def _(t):
    facts = joins.enrich(t.orders, [(t.customer, {"c_custkey": "o_custkey"}, {"c_nationkey": "nk"})])
    return matching.match_rules(facts, t.derived("src_rule"), {"nk": "nation"}, {"o_orderstatus": "status", "o_orderpriority": "priority"},
                                {"o_totalprice": "min_amount"}, ["rule_id"]).select("o_orderkey", "rule_id")


@check("join20_rule_bitmaps", """
    with f as (select o_orderkey, o_orderstatus, o_orderpriority, cast(month(o_orderdate) as int) as mo, c_mktsegment, c_nationkey from orders left join customer on o_custkey = c_custkey)
    select o_orderkey, s_suppkey as offer from f cross join supplier r
    where (not exists (select 1 from src_offer_status x where x.offer = s_suppkey) or exists (select 1 from src_offer_status x where x.offer = s_suppkey and st = o_orderstatus))
      and (not exists (select 1 from src_offer_priority x where x.offer = s_suppkey) or exists (select 1 from src_offer_priority x where x.offer = s_suppkey and pr = o_orderpriority))
      and (not exists (select 1 from src_offer_month x where x.offer = s_suppkey) or exists (select 1 from src_offer_month x where x.offer = s_suppkey and x.mo = f.mo))
      and (not exists (select 1 from src_offer_segment x where x.offer = s_suppkey) or exists (select 1 from src_offer_segment x where x.offer = s_suppkey and seg = c_mktsegment))
      and (not exists (select 1 from src_offer_nation x where x.offer = s_suppkey) or exists (select 1 from src_offer_nation x where x.offer = s_suppkey and na = c_nationkey))""")
def _(t):
    facts = joins.enrich(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.month("o_orderdate").alias("mo")),
                         [(t.customer, {"c_custkey": "o_custkey"}, {"c_mktsegment": "segment", "c_nationkey": "nation"})])
    columns = {"status": "st", "priority": "pr", "month": "mo", "segment": "seg", "nation": "na"}
    index = rules.rule_index(t.supplier.select(F.col("s_suppkey").alias("offer")), "offer", {n: (t.derived(f"src_offer_{n}"), c) for n, c in columns.items()}, t.stage)
    tests = {"o_orderstatus": "status", "o_orderpriority": "priority", "mo": "month", "segment": "segment", "nation": "nation"}
    return rules.match_rule_index(facts, index, tests).select("o_orderkey", "offer")


@check("join21_latest_by_max", """
    select o_custkey, o_orderkey from orders join (select o_custkey as k, max(date_trunc('month', o_orderdate)) as m from orders group by 1) x
    on o_custkey = k and date_trunc('month', o_orderdate) = m""")
def _(t):
    df = t.orders.select("o_custkey", "o_orderkey", F.trunc("o_orderdate", "month").alias("m"))
    return latest.latest_by_max(df, ["o_custkey"], "m").drop("m")


@check("join22_widen_conditions", """
    select user_id, max(case when event_type = 'view' then json_extract_string(props, '$.k') end) as view_k,
           max(case when event_type = 'click' then json_extract_string(props, '$.k') end) as click_k from events group by user_id""")
def _(t):
    return joins.widen_conditions(t.events, "user_id", "event_type", "props", {"view": ["k"], "click": ["k"]})


@check("join23_expand_rules", """
    select r_regionkey as rule, n_name as mall, s_name as shop from region left join nation on n_regionkey = r_regionkey
    left join (select n_regionkey as rk, s_name from supplier join nation on s_nationkey = n_nationkey where s_acctbal < 0) x on rk = r_regionkey""")
def _(t):
    shops = t.supplier.filter("s_acctbal < 0").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joins.expand_rules(t.region.select(F.col("r_regionkey").alias("rule")), "rule", [
        (t.nation.select(F.col("n_regionkey").alias("rule"), F.col("n_name").alias("mall")), ["mall"]),
        (shops.select(F.col("n_regionkey").alias("rule"), F.col("s_name").alias("shop")), ["shop"])])


@check("join24_gate_by_start", """
    select l_orderkey, l_linenumber, l_partkey from lineitem left join (select s_suppkey, timestamp '1998-01-01' as start from supplier where s_acctbal < 3000) x
    on l_suppkey = s_suppkey where s_suppkey is null or l_shipdate > start""")
def _(t):
    starts = t.supplier.filter("s_acctbal < 3000").select("s_suppkey", F.lit("1998-01-01").cast("timestamp_ntz").alias("start"))
    return joins.gate_by_start(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"), starts, "s_suppkey", "start",
                               "l_suppkey", "l_shipdate").drop("l_suppkey", "l_shipdate")
