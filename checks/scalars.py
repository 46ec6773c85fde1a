"""Scalar functions, one query per group."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from martkit.functions import dates, jsontext, numbers, text


@check("fn_case_trim", "select o_orderkey, upper(o_orderpriority) as up, lower(o_orderpriority) as low, trim('  ' || o_orderstatus || ' ') as trimmed from orders")
def _(t):
    return t.orders.select("o_orderkey", F.upper("o_orderpriority").alias("up"), F.lower("o_orderpriority").alias("low"),
                           F.trim(F.concat(F.lit("  "), "o_orderstatus", F.lit(" "))).alias("trimmed"))


@check("fn_concat_nulls", """
    select o_orderkey, nullif(o_orderstatus, 'F') || '-' || o_orderpriority as strict_text,
           concat_ws('-', nullif(o_orderstatus, 'F'), o_orderpriority) as loose_text from orders""")
def _(t):
    s = F.nullif("o_orderstatus", F.lit("F"))
    return t.orders.select("o_orderkey", F.concat(s, F.lit("-"), "o_orderpriority").alias("strict_text"),
                           F.concat_ws("-", s, "o_orderpriority").alias("loose_text"))


@check("fn_substrings", """
    select c_custkey, substr(c_name, 10, 4) as mid, left(c_name, 8) as head, right(c_name, 3) as tail, length(c_name) as n, instr(c_name, '#') as at_mark,
           instr(c_name, '?') as absent from customer""")
def _(t):
    c = F.col("c_name")
    n = lambda x: x.cast("long")
    return t.customer.select("c_custkey", F.substring(c, 10, 4).alias("mid"), F.left(c, F.lit(8)).alias("head"), F.right(c, F.lit(3)).alias("tail"),
                             n(F.length(c)).alias("n"), n(F.instr(c, "#")).alias("at_mark"), n(F.instr(c, "?")).alias("absent"))


@check("fn_replace_translate", """
    select page_id, replace(replace(url, 'https://', ''), 'http://', '') as bare, translate(url, '/?=&', '') as safe,
           regexp_replace(html, '[\\r\\n]+', ' ', 'g') as one_line from pages""")
def _(t):
    u = F.col("url")
    return t.pages.select("page_id", F.replace(F.replace(u, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit("")).alias("bare"),
                          F.translate(u, "/?=&", "").alias("safe"), text.strip_line_breaks(F.col("html"), " ").alias("one_line"))


@check("fn_leading_zeros_alnum", """
    select c_custkey, regexp_replace(substr(c_name, 10), '^0+', '') as no_zeros, regexp_replace(c_name, '[^0-9A-Za-z]', '', 'g') as alnum from customer""")
def _(t):
    return t.customer.select("c_custkey", text.strip_leading_zeros(F.substring("c_name", 10, 20)).alias("no_zeros"),
                             text.alnum_only(F.col("c_name")).alias("alnum"))


@check("fn_split_items", """
    select page_id, split_part(url, '/', 3) as host, nullif(split_part(url, '?', 2), '') as query_part from pages""")
def _(t):
    return t.pages.select("page_id", text.token(F.col("url"), "/", 2).alias("host"), text.token(F.col("url"), "?", 1).alias("query_part"))


@check("fn_substring_index", "select page_id, split_part(url, '.', 1) || '.' || split_part(url, '.', 2) as two_parts, split_part(url, '.', -1) as last_part from pages where url like '%.%.%'")
def _(t):
    u = F.col("url")
    return t.pages.filter(u.like("%.%.%")).select("page_id", F.substring_index(u, ".", 2).alias("two_parts"), F.substring_index(u, ".", -1).alias("last_part"))


@check("fn_like_startswith", """
    select doc_id, text like '%the%' as has_the, starts_with(text, 'T') as starts_t, source like 'src_' as short_source from documents""")
def _(t):
    c = F.col("text")
    return t.documents.select("doc_id", c.contains("the").alias("has_the"), c.startswith("T").alias("starts_t"), F.col("source").like("src_").alias("short_source"))


@check("fn_trailing_and_currency", """
    select p_partkey, p_brand as stripped, p_retailprice as price, cast(null as double) as not_a_price from part""")
def _(t):
    shown = F.concat(F.lit("HK$"), F.format_number(F.col("p_retailprice"), 2))
    return t.part.select("p_partkey", text.strip_trailing(F.concat("p_brand", F.lit(","))).alias("stripped"),
                         text.currency_number(F.replace(shown, F.lit("HK"), F.lit(""))).alias("price"), text.currency_number(F.col("p_name")).alias("not_a_price"))


@check("fn_sha256", "select doc_id, sha256(text) as digest from documents")
def _(t):
    return t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))


@check("fn_parse_dates", """
    select o_orderkey, cast(o_orderdate as date) as d, o_orderdate + interval '15' hour as ts, cast(null as date) as bad from orders""")
def _(t):
    raw = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("a"),
                          F.date_format(dates.shift_hours(F.col("o_orderdate"), 15), "dd/MM/yyyy HH:mm:ss").alias("b"))
    stamp = lambda c, f: F.try_to_timestamp(F.col(c), F.lit(f))
    return raw.select("o_orderkey", stamp("a", "yyyyMMdd").cast("date").alias("d"), stamp("b", "dd/MM/yyyy HH:mm:ss").cast("timestamp_ntz").alias("ts"),
                      stamp("a", "dd/MM/yyyy").cast("date").alias("bad"))


@check("fn_date_format", """
    select o_orderkey, strftime(o_orderdate, '%Y%m') as ym, strftime(o_orderdate, '%Y-%m') as y_m,
           strftime(o_orderdate - interval '16' hour, '%Y-%m-%dT%H:%M:%S') || '.000Z' as iso from orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", dates.month_key(d).alias("ym"), dates.month_key(d, "yyyy-MM").alias("y_m"), dates.iso_millis(d).alias("iso"))


@check("fn_minute_truncation", "select event_id, date_trunc('minute', ts) as at_minute from events")
def _(t):
    return t.events.select("event_id", dates.to_minute(F.col("ts")).alias("at_minute"))


@check("fn_local_date", """
    select event_id, cast(ts - interval '8' hour as date) as minus8, cast(ts + interval '8' hour as date) as plus8, ts + interval '10' second as later from events""")
def _(t):
    ts = F.col("ts")
    return t.events.select("event_id", dates.local_date(ts).alias("minus8"), dates.local_date(ts, -8).alias("plus8"),
                           (ts + F.make_dt_interval(secs=F.lit(10))).alias("later"))


@check("fn_day_arithmetic", """
    select o_orderkey, cast(cast(o_orderdate as date) + 30 as date) as plus30, cast(cast(o_orderdate as date) - 90 as date) as minus90,
           date '2001-08-01' - cast(o_orderdate as date) + 1 as day_no from orders""")
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.date_add(d, 30).alias("plus30"), F.date_sub(d, 90).alias("minus90"),
                           dates.day_number(d, F.lit("2001-08-01").cast("date")).cast("long").alias("day_no"))


@check("fn_month_functions", """
    select o_orderkey, last_day(o_orderdate) as month_end, cast(date_trunc('month', o_orderdate) as date) as month_first, cast(year(o_orderdate) as int) as y,
           cast(month(o_orderdate) as int) as m,
           round((2001 - year(d)) * 12 + 7 - month(d) + case when d = last_day(d) then 0 else (31 - day(d)) / 31.0 end, 4) as months
    from (select *, cast(o_orderdate as date) as d from orders) x""")
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.last_day(d).alias("month_end"), dates.month_start(d).alias("month_first"), F.year(d).alias("y"), F.month(d).alias("m"),
                           F.round(F.months_between(F.lit("2001-07-31").cast("date"), d), 4).alias("months"))


@check("fn_weekdays", """
    select o_orderkey, cast(isodow(o_orderdate) - 1 as int) as monday0, cast(dayofweek(o_orderdate) + 1 as int) as sunday1,
           case when isodow(o_orderdate) <= 5 then 'Weekday' else 'Weekend' end as kind from orders""")
def _(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.weekday(d).alias("monday0"), F.dayofweek(d).alias("sunday1"), dates.weekday_kind(d).alias("kind"))


@check("fn_minutes_between", "select event_id, date_sub('minute', timestamp '2024-01-15 12:00:30', ts) as minutes from events")
def _(t):
    return t.events.select("event_id", dates.minutes_between(F.lit("2024-01-15 12:00:30").cast("timestamp_ntz"), F.col("ts")).alias("minutes"))


@check("fn_math", """
    select l_orderkey, l_linenumber, l_partkey, l_quantity * -1 as flipped, round(l_extendedprice) as rounded,
           cast(cast(l_extendedprice as decimal(38, 1)) as double) as one_decimal from lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") * -1).alias("flipped"), F.round("l_extendedprice").alias("rounded"),
                             F.col("l_extendedprice").cast("decimal(38,1)").cast("double").alias("one_decimal"))


@check("fn_greatest_skips_nulls", """
    select o_orderkey, greatest(o_orderdate, case when o_orderstatus = 'F' then o_orderdate + interval '5' day end) as latest from orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.greatest(d, F.when(F.col("o_orderstatus") == "F", dates.shift_hours(d, 120))).alias("latest"))


@check("fn_conditionals", """
    select p_partkey, coalesce(nullif(p_size, 10), 0) as size0, case when p_size between 10 and 20 then 'mid' when nullif(p_type, 'SMALL') is null then 'none' else 'other' end as kind
    from part""")
def _(t):
    return t.part.select("p_partkey", F.coalesce(F.nullif("p_size", F.lit(10)), F.lit(0)).alias("size0"),
                         F.when(F.col("p_size").between(10, 20), "mid").when(F.nullif("p_type", F.lit("SMALL")).isNull(), "none").otherwise("other").alias("kind"))


@check("fn_arrays", """
    select doc_id, count(*) as n_words, count(distinct w) as n_distinct from (select doc_id, unnest(string_split(text, ' ')) as w from documents) x group by doc_id""")
def _(t):
    words = F.split("text", " ")
    return t.documents.select("doc_id", F.size(words).cast("long").alias("n_words"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))


@check("fn_json", "select event_id, cast(json_extract_string(props, '$.k') as int) as k, json_extract_string(props, '$.absent') as absent from events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"), jsontext.json_path(F.col("props"), "$.absent").alias("absent"))


@check("fn_share", "select s_suppkey, s_acctbal / nullif(case when s_nationkey < 5 then 0 else s_nationkey end, 0) as ratio from supplier")
def _(t):
    return t.supplier.select("s_suppkey", numbers.share(F.col("s_acctbal"), F.when(F.col("s_nationkey") < 5, 0).otherwise(F.col("s_nationkey"))).alias("ratio"))
