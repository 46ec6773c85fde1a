"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, StructField, StructType

from checks.registry import check
from martkit.functions import codes, dates, numbers, privacy, text
from martkit.operators import filters, joins, projection, rowids, sets

AS_OF = "2001-08-01"


@check("prj01_conform_schema", """
    select cast(l_orderkey as string) as receipt_no, cast(l_quantity as int) as qty, cast(l_shipdate as date) as ship_day,
           cast(l_extendedprice as double) as amount from lineitem""")
def _(t):
    schema = StructType([StructField("receipt_no", StringType()), StructField("qty", IntegerType()), StructField("ship_day", DateType()),
                         StructField("amount", DecimalType(18, 2))])
    out = projection.conform(t.lineitem, schema, {"receipt_no": "l_orderkey", "qty": "l_quantity", "ship_day": "l_shipdate",
                                                  "amount": "l_extendedprice"})
    return out.withColumn("amount", F.col("amount").cast("double"))


@check("prj02_rename_columns", "select p_partkey as part_id, p_name as part_name, p_brand as brand_label from part")
def _(t):
    raw = t.part.select(F.col("p_partkey").alias("Part ID"), F.col("p_name").alias("Part  Name"), F.col("p_brand").alias("b"))
    return projection.rename_columns(projection.rename_columns(raw, {"b": "Brand Label"}), text.underscore_name)


@check("prj03_drop_stale_attributes", "select o_orderkey, o_custkey, o_totalprice, c_name as name from orders join customer on o_custkey = c_custkey")
def _(t):
    stale = t.orders.withColumn("name", F.lit("old"))
    kept = projection.drop_columns(stale, ["name", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    return joins.enrich(kept, [(t.customer, {"c_custkey": "o_custkey"}, {"c_name": "name"})])


@check("prj04_pad_and_union", """
    select c_custkey as id, c_name as name, c_mktsegment as segment, cast(null as int) as nation from customer
    union all select s_suppkey, s_name, cast(null as string), s_nationkey from supplier""")
def _(t):
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("segment", StringType()),
                         StructField("nation", IntegerType())])
    parts = [t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
             t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))]
    return sets.union_evidence(parts, schema).withColumn("id", F.col("id").cast("long"))


@check("prj05_cast_text_export", """
    select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as int) as prio,
           try_cast(nullif(o_orderpriority, '5-LOW') as int) as bad_number,
           case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end as day from orders""")
def _(t):
    raw = t.orders.select(
        "o_orderkey", F.split("o_orderpriority", "-")[0].alias("prio"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("bad_number"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"))
    return projection.cast_columns(raw, {"prio": "int", "bad_number": "int", "day": "date"}, {"day": "dd/MM/yyyy"})


@check("prj06_decode_cases", """
    select o_orderkey, case o_orderstatus when 'F' then 'Filled' when 'O' then 'Open' else 'Unknown' end as with_default,
           case o_orderstatus when 'F' then 'Filled' end as without_default,
           case o_orderstatus when 'P' then 'Pending' else o_orderstatus end as kept from orders""")
def _(t):
    c = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", codes.decode(c, {"F": "Filled", "O": "Open"}, "Unknown").alias("with_default"),
                           codes.decode(c, {"F": "Filled"}).alias("without_default"),
                           codes.decode(c, {"P": "Pending"}, keep_unknown=True).alias("kept"))


@check("prj07_decode_by_join", """
    select o_orderkey, case o_orderpriority when '1-URGENT' then 'u' when '2-HIGH' then 'h' end as level from orders""")
def _(t):
    table = joins.code_table(t.orders, {"1-URGENT": "u", "2-HIGH": "h"}, "code", "label")
    return joins.decode_join(t.orders, table, "o_orderpriority", "code", "label", "level").select("o_orderkey", "level")


BANDS = [(11, 17, "11 - 17"), (18, 24, "18 - 24"), (25, 34, "25 - 34"), (35, 44, "35 - 44"), (45, None, "45+")]


@check("prj08_banding", """
    select p_partkey, p_size, case when p_size between 11 and 17 then '11 - 17' when p_size between 18 and 24 then '18 - 24'
      when p_size between 25 and 34 then '25 - 34' when p_size between 35 and 44 then '35 - 44' when p_size >= 45 then '45+' end as size_band
    from part""")
def _(t):
    return t.part.select("p_partkey", "p_size", codes.band(F.col("p_size"), BANDS).alias("size_band"))


@check("prj09_clean_sentinels", """
    select p_partkey, case when p_size % 5 = 0 or p_size % 5 = 1 then 'UNDEFINABLE' when p_size % 5 = 2 then 'UNDEFINABLE' else p_brand end as brand
    from part""")
def _(t):
    raw = F.when(F.col("p_size") % 5 == 0, F.lit("#N/A")).when(F.col("p_size") % 5 == 1, F.lit(" None ")).when(
        F.col("p_size") % 5 == 2, F.lit(None)).otherwise(F.col("p_brand"))
    return projection.clean_columns(t.part.select("p_partkey", raw.alias("brand")), ["brand"], "UNDEFINABLE")


@check("prj10_override", """
    select p_partkey, case p_type when 'SMALL' then null when 'ECONOMY' then 'E' else p_type end as type_code from part""")
def _(t):
    mapped = codes.decode(F.col("p_type"), {"SMALL": "NULL", "ECONOMY": "E"})
    return t.part.select("p_partkey", codes.override(mapped, F.col("p_type"), null_marker="NULL").alias("type_code"))


@check("prj11_existence_flag", """
    select o_orderkey, case when exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R') then 1 else 0 end as has_return
    from orders""")
def _(t):
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return joins.flag_exists(t.orders.select("o_orderkey"), returned, {"l_orderkey": "o_orderkey"}, "has_return")


@check("prj12_rule_cascade", """
    select page_id, case when url like '%ref=%' then 'referral' when url like 'https://m.%' then 'mobile' when url like '%.org%' then 'organic'
      else 'direct' end as medium from pages""")
def _(t):
    u = F.col("url")
    rules = [(u.contains("ref="), "referral"), (u.startswith("https://m."), "mobile"), (u.contains(".org"), "organic")]
    return t.pages.select("page_id", codes.first_match(rules, "direct").alias("medium"))


@check("prj13_mask_deleted", """
    select c_custkey, case when c_mktsegment = 'MACHINERY' then null else c_name end as c_name,
           case when c_mktsegment = 'MACHINERY' then null else c_acctbal end as c_acctbal from customer""")
def _(t):
    df = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return projection.mask_columns(df, F.col("c_mktsegment") == "MACHINERY", ["c_name", "c_acctbal"]).drop("c_mktsegment")


@check("prj14_hash_when", """
    select c_custkey, case when c_nationkey < 12 then sha256(upper(c_name)) when c_nationkey = 12 then sha256(c_name) else c_name end as token
    from customer""")
def _(t):
    done = F.when(F.col("c_nationkey") == 12, F.sha2("c_name", 256)).otherwise(F.col("c_name"))
    return t.customer.select("c_custkey", privacy.hash_when(done, F.col("c_nationkey") <= 12).alias("token"))


@check("prj15_hash_salted", "select c_custkey, sha256(lower(c_name) || 'unit-salt') as token from customer")
def _(t):
    return t.customer.select("c_custkey", privacy.hash_salted(F.col("c_name"), "unit-salt").alias("token"))


@check("prj16_cap", """
    select l_orderkey, l_linenumber, l_quantity, case when l_tax * 500 < l_quantity then l_tax * 500 when nullif(l_quantity, 7) is null then 0
      else l_quantity end as earned from (select l_orderkey, l_linenumber, nullif(l_quantity, 7) as l_quantity, l_tax from lineitem) x""")
def _(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"), "l_tax")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", numbers.cap(F.col("l_quantity"), F.col("l_tax") * 500, 0.0).alias("earned"))


@check("prj17_floor_zero", "select s_suppkey, case when s_acctbal - 5000 <= 0 then 0 else s_acctbal - 5000 end as top_up from supplier")
def _(t):
    return t.supplier.select("s_suppkey", numbers.floor_zero(F.col("s_acctbal") - 5000).alias("top_up"))


@check("prj18_clamp_year", """
    select o_orderkey, case when year(o_orderdate) < 1996 then timestamp '1996-12-31 23:59:59' else o_orderdate end as clamped,
           case when year(o_orderdate) < 1997 then null else o_orderdate end as nulled from orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", dates.clamp_year(d, 1996, F.lit("1996-12-31 23:59:59").cast("timestamp_ntz")).alias("clamped"),
                           dates.clamp_year(d, 1997).alias("nulled"))


@check("prj19_constants_and_fill", """
    select p_partkey, coalesce(nullif(p_type, 'SMALL'), '') as p_type, 'v1' as version, '9999-12-31' as end_date from part""")
def _(t):
    df = t.part.select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("p_type"))
    return projection.with_constants(projection.fill_empty(df), {"version": "v1", "end_date": "9999-12-31"})


@check("prj20_surrogate_row_id", """
    select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as row_id from orders""")
def _(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    return rowids.add_row_id(df, ["o_orderdate", "o_orderkey"], "row_id", t.stage).select("o_orderkey", "row_id")


@check("prj21_launch_flag", "select o_orderkey, case when o_orderdate < timestamp '1998-03-12' then 1 else 0 end as before_launch from orders")
def _(t):
    return t.orders.select("o_orderkey", codes.flag_before(F.col("o_orderdate"), dates.as_date("1998-03-12")).alias("before_launch"))


@check("prj22_join_address_parts", """
    select c_custkey, case when n_name in ('NATION_3', 'NATION_4') and r_name = 'ASIA' then null when r_name = 'ASIA' then n_name when n_name in ('NATION_3', 'NATION_4') then r_name
      when n_name = 'NATION_5' then null else n_name || ' , ' || r_name end as address
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def _(t):
    df = joins.enrich(t.customer, [(t.nation, {"n_nationkey": "c_nationkey"}, {"n_name": "n_name", "n_regionkey": "rk"}),
                                   (t.region, {"r_regionkey": "rk"}, {"r_name": "r_name"})])
    a = F.when(F.col("n_name").isin("NATION_3", "NATION_4"), "N/A").when(F.col("n_name") != "NATION_5", F.col("n_name"))
    b = F.when(F.col("r_name") == "ASIA", "N/A").otherwise(F.col("r_name"))
    return df.select("c_custkey", text.join_parts(a, b).alias("address"))


@check("prj24_first_present", """
    select p_partkey, case when p_size > 25 then p_name when p_size > 10 then p_brand else p_type end as label from part""")
def _(t):
    a = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.lit(""))
    b = F.when(F.col("p_size") > 10, F.col("p_brand"))
    return t.part.select("p_partkey", text.first_present(a, b, F.col("p_type")).alias("label"))


@check("flt01_standard_exclusions", """
    select o_orderkey from (select o_orderkey, nullif(o_orderstatus, 'P') as s, o_orderpriority as p, o_totalprice as a, o_orderdate as d from orders) x
    where p in ('1-URGENT', '2-HIGH', '5-LOW') and s not in ('F') and a >= 1000 and d >= timestamp '1996-01-01'""")
def _(t):
    df = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"), F.col("o_orderpriority").alias("p"),
                         F.col("o_totalprice").alias("a"), F.col("o_orderdate").alias("d"))
    return filters.standard_exclusions(df, keep={"p": ["1-URGENT", "2-HIGH", "5-LOW"]}, drop={"s": ["F"]},
                                       at_least={"a": 1000.0, "d": dates.as_date("1996-01-01")}).select("o_orderkey")


@check("flt02_last_days", "select o_orderkey from orders where o_orderdate >= timestamp '2001-05-03'")
def _(t):
    return filters.last_days(t.orders, "o_orderdate", 90, AS_OF).select("o_orderkey")


@check("flt03_since_month_start", "select o_orderkey from orders where o_orderdate >= timestamp '2000-08-01'")
def _(t):
    return filters.since_month_start(t.orders, "o_orderdate", 12, AS_OF).select("o_orderkey")


@check("flt04_complete_months", "select o_orderkey from orders where o_orderdate >= timestamp '2000-08-01' and o_orderdate < timestamp '2001-08-01'")
def _(t):
    return filters.complete_months(t.orders, "o_orderdate", 12, AS_OF).select("o_orderkey")


@check("flt05_month_to_date", "select event_id from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-20'")
def _(t):
    return filters.month_to_date(t.events, "ts", "2024-01-20").select("event_id")


@check("flt06_changed_on_day", """
    select event_id from events where cast(ts as date) = date '2024-01-15' or cast(ts + interval '36' hour as date) = date '2024-01-15'""")
def _(t):
    df = t.events.select("event_id", F.col("ts").alias("created"), dates.shift_hours(F.col("ts"), 36).alias("updated"))
    return filters.changed_on(df, "2024-01-15", ["created", "updated"]).select("event_id")


@check("flt07_like_prefix_length", """
    select doc_id from documents where text like '%the%' and source like 'src1%' and length(text) > 300 and starts_with(lang, 'e')""")
def _(t):
    c = F.col("text")
    return t.documents.filter(c.contains("the") & F.col("source").like("src1%") & (F.length(c) > 300) & F.col("lang").startswith("e")).select("doc_id")


@check("flt08_exclude_tuples", """
    select o_orderkey from orders where not (o_orderstatus = 'F' and o_orderpriority = '1-URGENT') and not (o_orderstatus = 'O' and o_orderpriority = '2-HIGH')""")
def _(t):
    return filters.exclude_tuples(t.orders, ["o_orderstatus", "o_orderpriority"], [("F", "1-URGENT"), ("O", "2-HIGH")]).select("o_orderkey")


@check("flt09_exclude_unless_exempt", """
    select o_orderkey from orders left join (select c_custkey from customer where c_acctbal < 1000) x on o_custkey = c_custkey
    where c_custkey is null or o_orderpriority = '1-URGENT'""")
def _(t):
    listed = t.customer.filter("c_acctbal < 1000").withColumnRenamed("c_custkey", "o_custkey")
    return filters.exclude_unless(t.orders, listed, ["o_custkey"], F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


FULL_DELTA = """
    select 'full' as mode, count(*) as n_orders, count(l_orderkey) as n_lines from orders left join lineitem on l_orderkey = o_orderkey
    union all
    select 'delta', count(*), count(l_orderkey) from (select * from orders where o_orderdate >= timestamp '2001-07-02') o
    left join (select * from lineitem where l_shipdate >= timestamp '2001-05-03') l on l_orderkey = o_orderkey"""


@check("flt10_full_or_delta", FULL_DELTA)
def _(t):
    out = []
    for mode in ("full", "delta"):
        o = filters.load_window(t.orders, "o_orderdate", mode, 30, AS_OF)
        lines = filters.load_window(t.lineitem, "l_shipdate", mode, 90, AS_OF)
        out.append(o.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").agg(
            F.count(F.lit(1)).alias("n_orders"), F.count("l_orderkey").alias("n_lines")).withColumn("mode", F.lit(mode)))
    return sets.union_all(*out)


@check("flt11_period_slices", "select year(o_orderdate) as y, count(*) as n from orders group by year(o_orderdate)")
def _(t):
    years = range(1995, 2002)
    parts = [filters.between_dates(t.orders, "o_orderdate", f"{y}-01-01", f"{y}-12-31").agg(F.count(F.lit(1)).alias("n")).withColumn("y", F.lit(y).cast("long")) for y in years]
    return sets.union_all(*parts)


# Row-level functions of the source jobs, as native expressions.

@check("udf_approve_or_reject", "select o_orderkey, case when o_orderstatus in ('F', 'O') then o_orderpriority end as decided_by from orders")
def _(t):
    from martkit.plans import spending
    return t.orders.select("o_orderkey", spending.decided_by(F.col("o_orderstatus"), F.col("o_orderpriority"), ("F", "O")).alias("decided_by"))


@check("udf_adjusted_expiry", """
    select l_orderkey, l_linenumber, l_partkey, case when nullif(l_returnflag, 'A') is distinct from nullif(l_linestatus, 'O') then l_linestatus
      else 'default' end as adjusted from lineitem""")
def _(t):
    from martkit.plans import points
    a, b = F.nullif("l_returnflag", F.lit("A")), F.nullif("l_linestatus", F.lit("O"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             points.adjusted_expiry(a, b, F.col("l_linestatus"), F.lit("default")).alias("adjusted"))


@check("udf_sentinel_number", "select o_orderkey, nullif(o_custkey, 13) as o_custkey from orders")
def _(t):
    return t.orders.select("o_orderkey", codes.null_if_value(F.col("o_custkey"), 13).alias("o_custkey"))
