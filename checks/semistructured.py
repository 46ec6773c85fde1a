"""JSON and delimited text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from martkit.functions import jsontext, text
from martkit.operators import lists, projection

# Oracle SQL for a word list: documents split on blanks and line breaks.


@check("jsn01_inferred_schema", """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def _(t):
    schema = lists.infer_json_schema(t.events, "props")
    return t.events.select("event_id", F.from_json("props", schema)["k"].alias("k"))


@check("jsn02_explode_array_of_objects", """
    select event_id, 'b' || user_id as base_offer, 'x' || k as name_lang1, cast(k as string) as object_id from (select event_id, user_id, json_extract_string(props, '$.k') as k from events) x
      where user_id % 3 > 0
    union all select event_id, 'b' || user_id, 'y', cast(value as string) from (select event_id, user_id, event_type as value from events) x where user_id % 3 = 2""")
def _(t):
    k = F.get_json_object("props", "$.k")
    one = F.struct(k.alias("object_id"), F.concat(F.lit("x"), k).alias("name_lang1"))
    two = F.struct(F.col("event_type").alias("object_id"), F.lit("y").alias("name_lang1"))
    offers = F.when(F.col("user_id") % 3 == 1, F.array(one)).when(F.col("user_id") % 3 == 2, F.array(one, two)).otherwise(F.array())
    df = t.events.select("event_id", F.to_json(F.struct(F.concat(F.lit("b"), "user_id").alias("base_offer"), offers.alias("extra_offer"))).alias("rules"))
    schema = "base_offer string, extra_offer array<struct<object_id:string,name_lang1:string>>"
    return lists.explode_json(df, "rules", schema, "extra_offer", ["base_offer"], ["object_id", "name_lang1"]).drop("rules")


@check("jsn03_chained_path", "select event_id, json_extract_string(props, '$.k') as k from events")
def _(t):
    df = t.events.select("event_id", F.to_json(F.struct(F.array(F.struct(F.from_json("props", "k int").alias("props"))).alias("a"))).alias("j"))
    return df.select("event_id", jsontext.json_path(F.col("j"), "$.a[0].props.k").alias("k"))


@check("jsn04_tracking_label", """
    select event_id, case event_type when 'click' then 'btl' || user_id when 'view' then cast(event_id as string) else 'OTHERS' end as label from events""")
def _(t):
    scene = (F.when(F.col("event_type") == "click", F.to_json(F.struct(F.concat(F.lit("scene-btl"), "user_id").alias("scene"))))
             .when(F.col("event_type") == "view", F.to_json(F.struct(F.col("event_id").cast("string").alias("key")))).otherwise(F.col("props")))
    patterns = [("scene-", "$.scene", "scene-"), ('"key"', "$.key", "")]
    return t.events.select("event_id", jsontext.tracking_label(scene, patterns).alias("label"))


@check("jsn05_map_of_lists", """
    select user_id, event_id, 'ids' as grp, cast(event_id as string) as item from events union all select user_id, event_id, 'kinds', event_type from events
    union all select user_id, event_id, 'kinds', 'all' from events""")
def _(t):
    text_ = F.to_json(F.create_map(F.lit("ids"), F.array(F.col("event_id").cast("string")), F.lit("kinds"), F.array("event_type", F.lit("all"))))
    df = t.events.select(F.struct("user_id", "event_id").alias("id"), text_.alias("m"))
    return lists.explode_map_of_lists(df, "id", "m", "grp", "item").select("id.user_id", "id.event_id", "grp", "item")


@check("jsn06_wide_columns", """
    select event_id, case when event_type <> 'error' then json_extract_string(props, '$.k') end as k_1, case when event_type not in ('error', 'view') then cast(user_id as string) end as k_2,
           cast(null as string) as k_3 from events""")
def _(t):
    entry = lambda c: F.struct(c.cast("string").alias("k"))
    k = F.from_json("props", "k int")["k"]
    payload = F.when(F.col("event_type") == "error", F.lit("{bad")).when(F.col("event_type") == "view", F.to_json(F.array(entry(k)))).otherwise(
        F.to_json(F.array(entry(k), entry(F.col("user_id")))))
    df = t.events.select("event_id", payload.alias("p"))
    return df.select("event_id", *[c.alias(n) for n, c in jsontext.wide_json(F.col("p"), ["k"], 3).items()])


@check("jsn07_nested_list", """
    select event_id, cast(user_id as string) as mall_id, json_extract_string(props, '$.k') as shop_id from events
    union all select event_id, cast(user_id as string), event_type from events union all select event_id, '0', 'z' from events where event_type = 'view'""")
def _(t):
    k = F.get_json_object("props", "$.k")
    a = F.struct(F.col("user_id").cast("string").alias("mall_id"), F.array(k, F.col("event_type")).alias("shop_id"))
    b = F.struct(F.lit("0").alias("mall_id"), F.array(F.lit("z")).alias("shop_id"))
    df = t.events.select("event_id", F.to_json(F.when(F.col("event_type") == "view", F.array(a, b)).otherwise(F.array(a))).alias("p"))
    return lists.explode_nested(df, "event_id", "p", "mall_id", "shop_id")


@check("jsn08_tiers", """
    select o_orderkey, 1 as tier, 0.0e0 as amount, cast(o_custkey as double) + 1000 as bonus_point, 'full point' as tier_type from orders
    union all select o_orderkey, 2, o_totalprice, 0.0e0, 'full cash' from orders
    union all select o_orderkey, 3, o_totalprice, 50.0e0, 'point + cash' from orders where o_orderstatus = 'F'""")
def _(t):
    def tier(n, amount, points):
        return F.struct(F.lit(n).alias("tier"), amount.cast("string").alias("amount"), points.cast("string").alias("bonus_point"))

    price, commas = F.col("o_totalprice").cast("decimal(18,2)"), F.format_number(F.col("o_custkey") + 1000, 0)
    base = [tier(1, F.lit(0), commas), tier(2, price, F.lit(0))]
    payload = F.when(F.col("o_orderstatus") == "F", F.array(*base, tier(3, price, F.lit(50)))).otherwise(F.array(*base))
    return lists.explode_tiers(t.orders.select("o_orderkey", F.to_json(payload).alias("p")), "o_orderkey", "p")


@check("jsn09_drop_keys", """
    select event_id, case when event_type = 'error' then null else '{"kind":"' || event_type || '"}' end as clean from events""")
def _(t):
    payload = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(
        F.to_json(F.struct(F.col("user_id").cast("string").alias("phone"), F.col("event_type").alias("kind"))))
    return t.events.select("event_id", jsontext.drop_json_keys(payload, ["phone"]).alias("clean"))


@check("jsn10_route_keys", """
    select event_id, case when event_type in ('click', 'view') then cast(user_id as string) end as btl, 'M' || user_id as member from events""")
def _(t):
    scene = F.concat(F.when(F.col("event_type").isin("click", "view"), F.lit("btl-")).otherwise(F.lit("oa-")), "user_id")
    payload = F.to_json(F.struct(F.struct(scene.alias("scene")).alias("query"), F.concat(F.lit("M"), "user_id").alias("memberId")))
    cols = jsontext.route_json_keys(F.col("p"), {"btl": "$.query.scene", "member": "$.memberId"}, {"btl": "btl-"})
    return t.events.select("event_id", payload.alias("p")).select("event_id", *[c.alias(n) for n, c in cols.items()])


@check("jsn11_url_parameter", """
    select page_id, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') as ref, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as page_no from pages""")
def _(t):
    return t.pages.select("page_id", text.url_param(F.col("url"), "ref").alias("ref"), text.url_param(F.col("url"), "page").alias("page_no"))


@check("txt01_delimited_list_to_rows", """
    select doc_id, trim(w) as word from (select doc_id, unnest(string_split(replace(text, '.', ''), ',')) as w from documents) x where trim(w) <> ''""")
def _(t):
    df = t.documents.select("doc_id", F.replace("text", F.lit("."), F.lit("")).alias("text"))
    return lists.explode_list(df, "text", ",", "word").drop("text")


@check("txt02_link_positions", """
    select doc_id, trim(w) as token, cast(p as int) as position from (select doc_id, unnest(string_split(text, ',')) as w, generate_subscripts(string_split(text, ','), 1) as p from documents) x
    where length(trim(w)) >= 2""")
def _(t):
    return lists.link_positions(t.documents, "doc_id", "text", min_len=2)


@check("txt03_rule_text", "select o_orderkey, cast(o_custkey as string) as one_stamp, cast(null as string) as nine_stamps from orders")
def _(t):
    rule = F.concat_ws("|", F.concat(F.lit("500:2")), F.concat(F.col("o_custkey").cast("string"), F.lit(":1")))
    return t.orders.select("o_orderkey", text.stamp_rule_value(rule, "1").alias("one_stamp"), text.stamp_rule_value(rule, "9").alias("nine_stamps"))


@check("txt04_parallel_lists", """
    select o_orderkey, 1 as position, 'a' || o_custkey as gift, o_orderstatus as required from orders
    union all select o_orderkey, 2, o_orderpriority, null from orders""")
def _(t):
    df = t.orders.select("o_orderkey", F.concat(F.lit("a"), "o_custkey", F.lit("::"), "o_orderpriority").alias("gift"), F.col("o_orderstatus").alias("required"))
    return lists.zip_lists(df, ["o_orderkey"], ["gift", "required"], "::")


@check("txt05_route_by_first_char", """
    select o_orderkey, case when o_custkey % 2 = 0 then o_orderstatus || o_custkey end as gift, case when o_custkey % 2 = 1 then cast(o_custkey as string) end as points from orders""")
def _(t):
    tagged = F.concat(F.lit("x|@|"), F.when(F.col("o_custkey") % 2 == 0, F.concat("o_orderstatus", "o_custkey")).otherwise(F.col("o_custkey").cast("string")))
    value = text.token(tagged, "|@|", 1)
    return t.orders.select("o_orderkey", text.route_first_char(value, True).alias("gift"), text.route_first_char(value, False).alias("points"))


@check("txt06_compound_code", """
    select o_orderkey, case when o_orderstatus <> 'P' then cast(o_custkey as int) end as mall, case when o_orderstatus <> 'P' then cast(o_orderkey as int) end as shop from orders""")
def _(t):
    code = F.when(F.col("o_orderstatus") == "P", F.lit("none")).otherwise(F.concat(F.lit("M"), "o_custkey", F.lit("S"), "o_orderkey"))
    pattern = "^M([0-9]+)S([0-9]+)$"
    return t.orders.select("o_orderkey", text.split_code(code, pattern, 1).alias("mall"), text.split_code(code, pattern, 2).alias("shop"))


@check("txt07_reference_normalisers", """
    select doc_id, replace(lower(regexp_replace(text, '[^0-9A-Za-z]', '', 'g')), 'r', '') as a, regexp_replace(regexp_replace(lower(trim(source)), '^0+', ''), 'r$', '') as b from documents""")
def _(t):
    return t.documents.select("doc_id", text.normalise_ref(F.col("text")).alias("a"), text.trimmed_ref(F.col("source")).alias("b"))


@check("txt08_export_safe", "select doc_id, translate(text, ',\"''\r\n', '') as text, lang, source, n_chars from documents")
def _(t):
    return projection.export_safe(t.documents)
