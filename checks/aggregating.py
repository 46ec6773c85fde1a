"""Aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from martkit.functions import dates, numbers, text
from martkit.operators import aggregates, distincts, joins, latest, ordered, quality, sets


def money(c):
    return numbers.money(F.col(c))


@check("agg01_sum_count_min_max", """
    select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as sum_price,
           min(l_shipdate) as first_ship, max(l_shipdate) as last_ship, count(*) as n from lineitem group by 1, 2""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.sum(money("l_extendedprice")).cast("double").alias("sum_price"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n"))


@check("agg02_count_distinct", "select o_orderstatus, count(distinct o_custkey) as n_customers, count(distinct o_orderdate) as n_days from orders group by 1")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("n_customers"), F.count_distinct("o_orderdate").alias("n_days"))


@check("agg02_states_of_days", """
    select event_type, cast(count(distinct user_id) as bigint) as users, cast(count(distinct case when ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' then user_id end) as bigint) as users_in_ten_days
    from events where ts < timestamp '2024-01-21' group by 1""")
def _(t):
    events = t.events.select("event_type", "user_id", F.to_date("ts").alias("day")).filter("day < '2024-01-21'")
    users = distincts.dictionary(events, "user_id", t.stage)
    days = t.stage(distincts.states(events, ["day", "event_type"], "user_id", users), "days")
    before = distincts.merge_states(days.filter("day < '2024-01-20'"), ["event_type"])
    total = distincts.advance(before, days.filter("day = '2024-01-20'"), ["event_type"])
    ten = distincts.count_states(days.filter("day >= '2024-01-10' and day < '2024-01-20'"), ["event_type"], "users_in_ten_days")
    return distincts.count_states(total, ["event_type"], "users").join(ten, "event_type", "left").fillna(0, ["users_in_ten_days"])


@check("agg03_conditional_aggregates", """
    select user_id, cast(sum(case when event_type = 'purchase' then cast(value as decimal(18, 2)) else 0 end) as double) as spent,
           count(distinct case when event_type = 'click' then cast(ts as date) end) as click_days, max(case when event_type = 'error' then ts end) as last_error
    from events group by user_id""")
def _(t):
    kind = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        aggregates.sum_when(money("value"), kind == "purchase").cast("double").alias("spent"),
        aggregates.count_distinct_when(F.to_date("ts"), kind == "click").alias("click_days"), F.max(F.when(kind == "error", F.col("ts"))).alias("last_error"))


@check("agg04_group_by_expression", """
    select strftime(o_orderdate, '%Y%m') as ym, case when o_totalprice > 250000 then 'high' else 'low' end as tier, count(*) as n from orders group by 1, 2""")
def _(t):
    return t.orders.groupBy(dates.month_key(F.col("o_orderdate")).alias("ym"), F.when(F.col("o_totalprice") > 250000, "high").otherwise("low").alias("tier")).agg(
        F.count(F.lit(1)).alias("n"))


@check("agg05_currently_active", """
    select user_id, cast(sum(case event_type when 'signup' then 1 when 'error' then -1 else 0 end) as bigint) as balance from events
    group by user_id having sum(case event_type when 'signup' then 1 when 'error' then -1 else 0 end) > 0""")
def _(t):
    signed = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", -1).otherwise(0)
    return aggregates.currently_active(t.events.select("user_id", signed.alias("s")), ["user_id"], "s")


@check("agg06_concat_distinct", """
    select l_orderkey, string_agg(f, ',' order by f) as flags from (select distinct l_orderkey, l_returnflag || l_linestatus as f from lineitem) x group by 1""")
def _(t):
    return aggregates.agg_concat(t.lineitem.select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("f")), ["l_orderkey"], "f", "flags")


@check("agg07_rollup_levels", """
    select p_brand, p_type, cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as amount, count(*) as n,
           case when p_brand is null and p_type is null then 'all' when p_brand is null then 'p_type' else 'p_brand+p_type' end as level
    from lineitem join part on l_partkey = p_partkey group by grouping sets ((p_brand, p_type), (p_type), ())""")
def _(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "p_type", money("l_extendedprice").alias("m"), F.lit(1).alias("one"))
    out = aggregates.rollup_levels(rows, [["p_brand", "p_type"], ["p_type"], []], {"amount": "m", "n": "one"})
    return out.withColumns({"amount": F.col("amount").cast("double"), "n": F.col("n").cast("long")})


@check("agg08_metric_row", """
    select (select count(distinct user_id) from events where event_type = 'click') as clickers, (select count(distinct user_id) from events) as users,
           (select count(*) from orders) as n_orders, date '2024-01-31' as as_of""")
def _(t):
    return aggregates.metric_row({
        "clickers": (t.events.filter("event_type = 'click'"), F.count_distinct("user_id")), "users": (t.events, F.count_distinct("user_id")),
        "n_orders": (t.orders, F.count(F.lit(1)))}, {"as_of": dates.as_date("2024-01-31")})


@check("agg09_distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@check("agg10_dedupe_keep_min_id", "select min(doc_id) as doc_id, lang from documents group by text, lang")
def _(t):
    return latest.dedupe_min(t.documents.select("doc_id", "lang", F.sha2("text", 256).alias("h")), ["h", "lang"], "doc_id").drop("h")


@check("agg11_first_event_per_key", "select user_id, min(ts) as first_ts from events where event_type = 'purchase' group by 1")
def _(t):
    return t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_ts"))


@check("agg12_ever_flag", "select user_id, max(case when event_type = 'purchase' and value > 40 then 1 else 0 end) as ever_big from events group by 1")
def _(t):
    return t.events.groupBy("user_id").agg(aggregates.ever((F.col("event_type") == "purchase") & (F.col("value") > 40)).alias("ever_big"))


FEATURES = " union all ".join(
    f"""select o_custkey, 'Spend_' || o_orderpriority || '_{p}' as feature, cast(cast(sum(cast(o_totalprice as decimal(18, 2))) as decimal(38, 1)) as double) as value
        from orders where cast(o_orderdate as date) between date '{d}' and date '2001-08-01' group by o_custkey, o_orderpriority
        union all select o_custkey, 'Spend_Total_{p}', cast(cast(sum(cast(o_totalprice as decimal(18, 2))) as decimal(38, 1)) as double)
        from orders where cast(o_orderdate as date) between date '{d}' and date '2001-08-01' group by o_custkey"""
    for p, d in (("Ever", "1995-03-12"), ("P3M", "2001-05-01"), ("P12M", "2000-08-01")))


@check("agg13_feature_long", FEATURES)
def _(t):
    out = aggregates.feature_long(t.orders, "o_custkey", "o_orderdate", {"Spend": money("o_totalprice")},
                                  {"Ever": "1995-03-12", "P3M": "2001-05-01", "P12M": "2000-08-01"}, "2001-08-01", place="o_orderpriority")
    return out.withColumn("value", F.col("value").cast("double"))


@check("agg14_decimal_totals", "select l_suppkey, cast(cast(sum(cast(l_extendedprice as decimal(18, 2))) as decimal(38, 1)) as double) as total from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).cast("decimal(38,1)").cast("double").alias("total"))


@check("agg15_concentrated_buyers", """
    with line as (select o_custkey as member, p_type as category, o_orderdate as d, cast(l_extendedprice as decimal(18, 2)) as amount from lineitem
                  join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey where o_orderdate >= timestamp '2000-08-01' and o_orderdate < timestamp '2001-08-01'),
    cat as (select member, category, sum(amount) as cat_amount, count(*) as cat_visits, min(cast(d as date)) as f from line group by 1, 2),
    tot as (select member, sum(cat_amount) as total_amount, cast(sum(cat_visits) as bigint) as total_visits, min(f) as f from cat group by 1),
    need as (select *, greatest(round((2001 - year(f)) * 12 + 7 - month(f) + case when f = last_day(f) then 0 else (31 - day(f)) / 31.0 end), 1) as m from tot)
    select c.member, c.category, cast(cat_amount as double) as cat_amount, cat_visits, cast(total_amount as double) as total_amount, total_visits, cast(m as double) as required_months
    from cat c join need n on c.member = n.member where category <> 'PROMO' and cat_amount >= 0.3 * total_amount and cat_visits >= m * case category when 'SMALL' then 0 else 1 end
      and cat_visits >= 0.3 * total_visits and total_amount >= m * 2000""")
def _(t):
    rows = t.lineitem.join(t.orders.filter("o_orderdate >= timestamp_ntz'2000-08-01' and o_orderdate < timestamp_ntz'2001-08-01'"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("o_custkey").alias("member"), F.col("p_type").alias("category"), F.col("o_orderdate").alias("d"), money("l_extendedprice").alias("amount"))
    out = aggregates.concentrated_buyers(rows, "member", "category", "d", "amount", period_end="2001-07-31", amount_per_month=2000.0,
                                         visits_per_month={"SMALL": 0, "*": 1}, amount_share=0.3, visit_share=0.3, floor_months=1, excluded=["PROMO"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("cat_amount", "total_amount", "required_months")})


@check("agg16_classify_mix", """
    select l_orderkey, case when min(l_discount) = 0 and min(l_tax) = 0 then 'both zero' when sum(l_discount) > 0 and sum(l_tax) > 0 then 'hybrid' when sum(l_discount) = 0 then 'tax'
      else 'discount' end as mix from lineitem group by 1""")
def _(t):
    labels = {"both_zero": "both zero", "a_only": "discount", "b_only": "tax", "hybrid": "hybrid"}
    return aggregates.classify_mix(t.lineitem, ["l_orderkey"], "l_discount", "l_tax", labels)


@check("agg17_alias_keys", """
    select user_id, cast(ts as date) as day, case when event_type in ('click', 'view') then 'browse' else 'act' end as kind, count(*) as n,
           cast(sum(cast(value as decimal(18, 2))) as double) as total from events group by 1, 2, 3""")
def _(t):
    return t.events.groupBy("user_id", F.to_date("ts").alias("day"), F.when(F.col("event_type").isin("click", "view"), "browse").otherwise("act").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).cast("double").alias("total"))


@check("agg18_stock_position", """
    select p_partkey, p_size * 10 as original, coalesce(redeemed_qty, 0) as redeemed_qty, coalesce(used_qty, 0) as used_qty, coalesce(mtd, 0) as mtd_redeemed_qty,
           p_size * 10 - coalesce(redeemed_qty, 0) as available_qty from part left join (
      select l_partkey, count(distinct l_orderkey) as redeemed_qty, count(distinct case when l_linestatus = 'F' then l_orderkey end) as used_qty,
             count(case when l_shipdate >= timestamp '2001-08-01' then 1 end) as mtd
      from (select l_partkey, l_orderkey, l_shipdate, l_linestatus from lineitem where l_linestatus <> 'X') y group by 1) x on l_partkey = p_partkey""")
def _(t):
    moves = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linestatus", "l_shipdate")
    items = t.part.select("p_partkey", (F.col("p_size") * 10).alias("original"))
    return aggregates.stock_position(items, moves.withColumnRenamed("p_partkey", "p_partkey"), "p_partkey", "l_orderkey", "l_linestatus", "l_shipdate", "original",
                                     void=["X"], used=["F"], as_of="2001-08-01")


@check("win01_first_event_ties_kept", """
    select user_id, day, event_id from (select user_id, cast(ts as date) as day, event_id, rank() over (partition by user_id, cast(ts as date) order by date_trunc('hour', ts)) as r
    from events) x where r = 1""")
def _(t):
    df = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", F.date_trunc("hour", "ts").alias("h"))
    return latest.first_ranked(df, ["user_id", "day"], ["h"]).drop("h")


@check("win02_first_on_start_day", """
    select e.user_id, e.event_id from (select e.*, rank() over (partition by e.user_id order by e.ts) as r from events e
      join (select user_id, min(ts) as s from events where event_type = 'signup' group by 1) g on e.user_id = g.user_id and cast(e.ts as date) = cast(s as date)) e where r = 1""")
def _(t):
    starts = t.events.filter("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("start"))
    return latest.first_on_day(t.events, starts, "user_id", "ts", "start").select("user_id", "event_id")


@check("win03_priority_then_recency", """
    select o_custkey, o_orderkey from (select o_custkey, o_orderkey, rank() over (partition by o_custkey order by case when o_orderpriority = '1-URGENT' then 2
      when o_orderpriority = '2-HIGH' then 1 else 0 end desc, o_orderdate desc) as r from orders) x where r = 1""")
def _(t):
    p = F.when(F.col("o_orderpriority") == "1-URGENT", 2).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(0)
    return latest.best_by(t.orders, ["o_custkey"], p, "o_orderdate").select("o_custkey", "o_orderkey")


@check("win04_latest_per_key", """
    select o_custkey, o_orderstatus, o_orderkey from (select *, row_number() over (partition by o_custkey, o_orderstatus order by o_orderdate desc, o_orderkey desc) as r
    from orders) x where r = 1""")
def _(t):
    return latest.latest_per_key(t.orders, ["o_custkey", "o_orderstatus"], "o_orderdate", [F.col("o_orderkey").desc()]).select("o_custkey", "o_orderstatus", "o_orderkey")


@check("win05_top_category", """
    select l_suppkey, p_type, total from (select *, row_number() over (partition by l_suppkey order by total desc, p_type) as r from (
      select l_suppkey, p_type, cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as total from lineitem join part on l_partkey = p_partkey group by 1, 2) y) x where r = 1""")
def _(t):
    totals = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey", "p_type").agg(F.sum(money("l_extendedprice")).cast("double").alias("total"))
    return latest.top_k(totals, ["l_suppkey"], [F.col("total").desc(), "p_type"])


@check("win06_ordinal_in_group", "select o_orderkey, rank() over (partition by o_orderpriority order by o_orderdate) as pos from orders")
def _(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return ordered.ordinal(df, ["o_orderpriority"], "o_orderdate", "pos", ordered.day_blocks("o_orderdate", "month")).select("o_orderkey", "pos")


@check("win08_running_sum", """
    select event_id, cast(sum(cast(value as decimal(18, 2))) over (partition by event_type order by ts) as double) as running from events""")
def _(t):
    df = t.events.select("event_id", "event_type", "ts", money("value").alias("v"))
    return ordered.running_sum(df, ["event_type"], "ts", "v", "running", ordered.day_blocks("ts")).select("event_id", F.col("running").cast("double").alias("running"))


@check("win09_daily_representative", """
    select user_id, day, event_id, cast(total as double) as day_total from (select user_id, cast(ts as date) as day, event_id,
      sum(cast(value as decimal(18, 2))) over (partition by user_id, cast(ts as date)) as total, rank() over (partition by user_id, cast(ts as date) order by ts, event_id) as r
    from events) x where r = 1""")
def _(t):
    df = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", "ts", money("value").alias("v"))
    out = latest.daily_representative(df, ["user_id", "day"], ["ts", "event_id"], "v", "day_total")
    return out.select("user_id", "day", "event_id", F.col("day_total").cast("double").alias("day_total"))


@check("srt01_sorted_output", "select n_name, n_nationkey, c_custkey from nation join customer on c_nationkey = n_nationkey order by n_name, c_custkey")
def _(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n_nationkey", "c_custkey").orderBy("n_name", "c_custkey")


@check("srt02_sorted_inside_files", "select o_orderkey, o_orderstatus from orders")
def _(t):
    from martkit.sources import writers

    path = t.scratch("sorted")
    writers.export_per_value(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", path, ["o_orderkey"])
    return t.spark.read.schema("o_orderkey bigint, o_orderstatus string").csv(path, header=True)


@check("srt03_latest_periods", "select distinct strftime(o_orderdate, '%Y%m') as ym from orders order by ym desc limit 2")
def _(t):
    return sets.latest_periods(t.orders.select(dates.month_key(F.col("o_orderdate")).alias("ym")), "ym", 2)


@check("set01_union_all", "select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier union all select p_partkey, p_name from part")
def _(t):
    shape = lambda df, k, n: df.select(F.col(k).alias("id"), F.col(n).alias("name"))
    return sets.union_all(shape(t.customer, "c_custkey", "c_name"), shape(t.supplier, "s_suppkey", "s_name"), shape(t.part, "p_partkey", "p_name"))


@check("set02_union_distinct", "select c_nationkey as nation from customer union select s_nationkey from supplier")
def _(t):
    return sets.union_distinct(t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation")))


@check("set03_union_distinct_with_anti", """
    select o_custkey, 'open' as kind from orders where o_orderstatus = 'O'
    union select o_custkey, 'only filled' from orders a where o_orderstatus = 'F' and not exists (select 1 from orders b where b.o_custkey = a.o_custkey and b.o_orderstatus = 'O')""")
def _(t):
    opened = t.orders.filter("o_orderstatus = 'O'").select("o_custkey")
    filled = joins.anti(t.orders.filter("o_orderstatus = 'F'").select("o_custkey"), opened, {"o_custkey": "o_custkey"})
    return sets.union_distinct(opened.withColumn("kind", F.lit("open")), filled.withColumn("kind", F.lit("only filled")))


@check("set05_evidence_union", """
    select user_id as member, 'purchase' as source, ts as seen, cast(null as double) as amount from events where event_type = 'purchase'
    union all select o_custkey, 'order', o_orderdate, o_totalprice from orders where o_totalprice > 450000""")
def _(t):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

    schema = StructType([StructField("member", LongType()), StructField("source", StringType()), StructField("seen", TimestampNTZType()), StructField("amount", DoubleType())])
    a = t.events.filter("event_type = 'purchase'").select(F.col("user_id").alias("member"), F.lit("purchase").alias("source"), F.col("ts").alias("seen"))
    b = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("member"), F.lit("order").alias("source"), F.col("o_orderdate").alias("seen"),
                                                        F.col("o_totalprice").alias("amount"))
    return sets.union_evidence([a, b], schema)


@check("set06_period_loop", " union all ".join(
    f"select user_id, '{p}' as period, count(*) as n from events where ts >= timestamp '{d}' group by user_id" for p, d in (("P7D", "2024-01-24"), ("P14D", "2024-01-17"), ("Ever", "2024-01-01"))))
def _(t):
    periods = {"P7D": "2024-01-24", "P14D": "2024-01-17", "Ever": "2024-01-01"}
    out = aggregates.feature_long(t.events, "user_id", "ts", {"n": F.lit(1)}, periods, "2024-01-31", type_="bigint")
    return out.select("user_id", F.regexp_extract("feature", "([^_]+)$", 1).alias("period"), F.col("value").alias("n"))


@check("set08_manual_corrections", """
    select c_custkey, case when c_nationkey = 3 then 'FIXED' else c_mktsegment end as c_mktsegment from customer
    union all select c_custkey + 100000000, 'NEW' from customer where c_nationkey = 4""")
def _(t):
    fixes = t.customer.filter("c_nationkey = 3").select("c_custkey", F.lit("FIXED").alias("c_mktsegment")).unionByName(
        t.customer.filter("c_nationkey = 4").select((F.col("c_custkey") + 100000000).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment")))
    return sets.override_rows(t.customer.select("c_custkey", "c_mktsegment"), fixes, ["c_custkey"])


@check("qa01_period_totals", "select strftime(o_orderdate, '%Y%m') as ym, count(*) as n_rows, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as total from orders group by 1")
def _(t):
    df = t.orders.select(dates.month_key(F.col("o_orderdate")).alias("ym"), money("o_totalprice").alias("m"))
    return quality.period_totals(df, "ym", "m").withColumn("total", F.col("total").cast("double"))


@check("qa02_name_mismatches", "select c_custkey, c_name, upper(c_name) as other_name from customer where c_nationkey < 5")
def _(t):
    other = t.customer.select("c_custkey", F.when(F.col("c_nationkey") < 5, F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"))
    return quality.name_mismatches(t.customer, other, "c_custkey", "c_name")


@check("qa03_unmapped_active", "select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 48)")
def _(t):
    return quality.unmapped_active(t.part.select("p_partkey"), t.lineitem.filter("l_quantity > 48"), {"l_partkey": "p_partkey"})


@check("qa04_amount_alerts", """
    select o_orderkey, o_orderstatus, o_totalprice, case o_orderstatus when 'F' then 270000.0e0 when 'P' then 90000.0e0 else 400000.0e0 end as ceiling from orders
    where o_totalprice > case o_orderstatus when 'F' then 270000 when 'P' then 90000 else 400000 end""")
def _(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return quality.amount_alerts(df, "o_totalprice", {"F": 270000.0, "P": 90000.0}, "o_orderstatus", 400000.0)


@check("qa05_duplicate_keys", "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
