"""Edge rules on tiny hand-made frames: ties, nulls, empty texts, bad JSON, equal times."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martkit.functions import codes, dates, jsontext, numbers, privacy, text
from martkit.operators import aggregates, filters, joins, latest, lists, matching, ordered, sets
from martkit.plans import campaign, stamps
from martkit.sources import writers


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def at(clock: str) -> datetime:
    return datetime.fromisoformat(f"2024-01-01 {clock}")


def gate(spark, *events):
    df = spark.createDataFrame([("p", at(c), op) for c, op in events], "k string, ts timestamp_ntz, op string")
    return ordered.pair_next(df, ["k"], "ts", "op", "in", "out", "out_ts", ordered.day_blocks("ts", "hour"))


def test_rank_keeps_ties_and_row_number_does_not(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 6, "c")], "k int, t int, v string")
    assert rows(latest.first_ranked(df, ["k"], ["t"]), "v") == [("a",), ("b",)]
    assert rows(latest.first_ranked(df, ["k"], ["t", "v"], ties=False), "v") == [("a",)]
    assert rows(latest.latest_by_max(df.filter("t = 5"), ["k"], "t"), "v") == [("a",), ("b",)]


def test_pairing(spark):
    out = gate(spark, ("10:00", "in"), ("10:05", "in"), ("10:30", "out"), ("11:00", "in"))
    assert rows(out, "ts", "out_ts") == sorted([(at("10:00"), at("10:30")), (at("10:05"), at("10:30")), (at("11:00"), None)], key=repr)


def test_pairing_is_strictly_later(spark):
    out = gate(spark, ("10:00", "in"), ("10:00", "out"), ("10:10", "out"))
    assert rows(out, "out_ts") == [(at("10:10"),)]


def test_pairing_across_segments_and_tied_outs(spark):
    out = gate(spark, ("10:59", "in"), ("10:59", "in"), ("12:01", "out"), ("12:01", "out"))
    assert rows(out, "out_ts") == [(at("12:01"),), (at("12:01"),)]


@pytest.mark.parametrize("block", [1, 2, 10])
def test_allocation(spark, block):
    df = spark.createDataFrame([("t", 1, 50, 70), ("t", 2, 30, 70), ("t", 3, 40, 70), ("n", 1, 5, None)], "k string, id int, amount int, pool int")
    out = ordered.allocate(df, ["k"], "id", "amount", "pool", "got", ordered.id_blocks("id", block))
    assert rows(out, "k", "id", "got") == [("n", 1, 0), ("t", 1, 50), ("t", 2, 20), ("t", 3, 0)]


def test_not_in_with_nulls(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,)], "y int")
    holed = spark.createDataFrame([(1,), (None,)], "y int")
    assert rows(joins.anti_null_aware(a, b, {"y": "x"}), "x") == [(2,)]
    assert rows(joins.anti_null_aware(a, holed, {"y": "x"}), "x") == []
    assert rows(joins.anti_null_aware(a, holed.filter("y > 5"), {"y": "x"}), "x") == [(1,), (2,), (None,)]
    assert rows(joins.anti(a, holed, {"y": "x"}), "x") == [(2,), (None,)]


def test_not_in_list_drops_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert rows(filters.standard_exclusions(df, drop={"x": ["a"]}), "x") == [("b",)]


def test_concatenated_key_with_a_null_part(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert rows(df.select(text.match_key(F.col("x"), F.col("y")).alias("k")), "k") == [("a|b",), (None,)]


def test_hierarchy(spark):
    tree = spark.createDataFrame([(1, None, "top"), (2, 2, "self"), (3, 1, "c1"), (4, 2, "c2"), (5, 99, "orphan")], "id int, parent int, name string")
    assert rows(joins.flatten_hierarchy(tree, "id", "parent", "name"), "id", "top_name") == [(1, "top"), (2, "self"), (3, "top"), (5, None)]


def test_overlay_takes_the_changed_row_once(spark):
    history = spark.createDataFrame([(1, date(2024, 1, 10), "a"), (2, date(2024, 1, 25), "old")], "id int, d date, v string")
    delta = spark.createDataFrame([(2, date(2024, 1, 25), "new")], "id int, d date, v string")
    once = sets.overlay(history, delta, "d", "2024-01-20")
    assert rows(once, "id", "v") == [(1, "a"), (2, "new")]
    assert rows(sets.overlay(once, delta, "d", "2024-01-20"), "id", "v") == [(1, "a"), (2, "new")]


def test_upsert_modes_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    staged = spark.createDataFrame([(2, "B"), (3, None)], "k int, v string")
    assert rows(writers.upsert(target, staged, ["k"], ["v"], insert=False), "k", "v") == [(1, "a"), (2, "B")]
    once = writers.upsert(target, staged, ["k"], ["v"])
    assert rows(once, "k", "v") == [(1, "a"), (2, "B"), (3, None)]
    assert rows(writers.upsert(once, staged, ["k"], ["v"]), "k", "v") == rows(once, "k", "v")


def test_banding(spark):
    df = spark.createDataFrame([(10,), (11,), (17,), (18,), (75,)], "x int")
    out = df.select(codes.band(F.col("x"), [(11, 17, "first"), (18, 24, "second"), (75, None, "top")]).alias("b"))
    assert [r[0] for r in out.collect()] == [None, "first", "first", "second", "top"]


def test_local_date_and_clamp(spark):
    df = spark.createDataFrame([(at("07:59"),), (at("08:00"),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(dates.local_date(F.col("ts"))).collect()] == [date(2023, 12, 31), date(2024, 1, 1)]
    old = spark.createDataFrame([(datetime(1, 1, 1),), (datetime(1970, 1, 1),), (None,)], "ts timestamp_ntz")
    out = old.select(dates.clamp_year(F.col("ts"), 1970, F.lit(datetime(1970, 1, 1, 23, 59, 59)).cast("timestamp_ntz")).alias("c"))
    assert [r[0] for r in out.collect()] == [datetime(1970, 1, 1, 23, 59, 59), datetime(1970, 1, 1), None]


def test_month_bounds():
    assert dates.add_months("2024-01-31", 1) == date(2024, 2, 29)
    assert dates.add_months("2024-01-15", -13) == date(2022, 12, 15)
    assert dates.month_days(2023, 12) == 31 and dates.month_days(2024, 2) == 29


def test_segment_floor_and_boundaries(spark):
    day = date(2024, 6, 1)
    data = [("solo", "A", day, 100)]
    data += [("edge", "A", day, 80)] * 7 + [("edge", "B", day, 140 // 3)] * 3  # 560 of 700 is 80 %, 7 of 10 is 70 %
    df = spark.createDataFrame(data, "m string, c string, d date, a int")
    df = df.withColumn("a", F.when(F.col("c") == "B", F.lit(140.0 / 3)).otherwise(F.col("a").cast("double")))
    out = aggregates.concentrated_buyers(df, "m", "c", "d", "a", period_end="2024-06-30", amount_per_month=1.0, floor_months=6)
    assert rows(out, "m", "c", "required_months") == [("edge", "A", 6.0)]


def test_wildcard_rule(spark):
    facts = spark.createDataFrame([(1, 10, "s1", 5.0), (2, 10, None, 4.9)], "id int, camp int, shop string, amt double")
    facts = facts.withColumn("mall", F.lit(7))
    rules = spark.createDataFrame([(10, None, "s1", 5.0, "R")], "c int, mall int, shop string, low double, rule string")
    rules = rules.withColumnsRenamed({"mall": "r_mall", "shop": "r_shop"})
    out = matching.match_rules(facts, rules, {"camp": "c"}, {"mall": "r_mall", "shop": "r_shop"}, {"amt": "low"}, ["rule"])
    assert rows(out, "id", "rule") == [(1, "R")]


def test_interval_bounds(spark):
    base = at("12:00:30")
    a = spark.createDataFrame([("m", base)], "k string, t timestamp_ntz")
    b = spark.createDataFrame([("m", i, at(f"12:00:{30 + i:02d}")) for i in (-19, -20, 10, 11)], "k2 string, i int, t2 timestamp_ntz")
    assert rows(matching.interval_join(a, b, {"k": "k2"}, "t", "t2", 19, 10), "i") == [(-19,), (10,)]


def test_range_count(spark):
    d = date(2024, 1, 1)
    df = spark.createDataFrame([(1, d, d), (2, d, None), (3, date(2024, 1, 5), d)], "id int, a date, b date")
    cal = spark.createDataFrame([(d,), (d,), (date(2024, 1, 3),)], "day date")
    assert rows(matching.count_days_between(df, "a", "b", cal, "day", "n", date(2024, 1, 31)), "id", "n") == [(1, 1), (2, 2), (3, 0)]


def test_hash_policy(spark):
    token = "a" * 64
    df = spark.createDataFrame([("ab1", 1), ("ab1", 0), (token, 1), (None, 1)], "p string, hit int")
    out = [r[0] for r in df.select(privacy.hash_when(F.col("p"), F.col("hit") == 1)).collect()]
    assert len(out[0]) == 64 and out[0] != "ab1" and out[1:] == ["ab1", token, None]


def test_reconcile(spark):
    a = spark.createDataFrame([("202401", "x", 1), ("202401", "both", 2)], "ym string, b string, l int")
    b = spark.createDataFrame([("202401", "both", 3), ("202401", "only", 4), ("202402", "late", 5)], "ym string, b string, r int")
    out = joins.reconcile(a, b, ["ym", "b"], "ym", ["l"], ["r"])
    assert rows(out, "b", "matched") == [("both", "both"), ("only", "right"), ("x", "left")]


def test_numbers(spark):
    df = spark.createDataFrame([(5, 9), (20, 9), (None, 9)], "p int, a int")
    assert [r[0] for r in df.select(numbers.cap(F.col("p"), F.col("a"))).collect()] == [5, 9, 0]
    neg = spark.createDataFrame([(-1,), (3,), (None,)], "x int")
    assert [r[0] for r in neg.select(numbers.floor_zero(F.col("x"))).collect()] == [0, 3, None]


def test_json_samples(spark):
    schema = "base_offer string, extra_offer array<struct<object_id:int,name_lang1:string>>"
    df = spark.createDataFrame([(1, '{"base_offer":"b","extra_offer":[{"object_id":1,"name_lang1":"x"},{"object_id":2}]}'), (2, '{"extra_offer":[]}'), (3, "bad")], "id int, j string")
    assert rows(lists.explode_json(df, "j", schema, "extra_offer", ["base_offer"], ["object_id"]), "id", "object_id") == [(1, 1), (1, 2)]
    assert lists.explode_json(df, "j", schema, "extra_offer", ["base_offer"], ["object_id"], keep_empty=True).count() == 4
    m = spark.createDataFrame([(1, '{"10":["1","2"],"11":["3"]}')], "id int, j string")
    assert rows(lists.explode_map_of_lists(m, "id", "j", "g", "i"), "g", "i") == [("10", "1"), ("10", "2"), ("11", "3")]
    w = spark.createDataFrame([('[{"bonus_point":"1,000"},{"bonus_point":"5"}]',), ("bad",)], "j string")
    out = w.select(*[c.alias(n) for n, c in jsontext.wide_json(F.col("j"), ["bonus_point"], 2).items()]).collect()
    assert [tuple(r) for r in out] == [("1,000", "5"), (None, None)]
    p = spark.createDataFrame([('{"phone":"1","a":"2"}',), ("bad",)], "j string")
    assert [r[0] for r in p.select(jsontext.drop_json_keys(F.col("j"), ["phone"])).collect()] == ['{"a":"2"}', None]


def test_of_a_repeated_json_key_the_last_entry_counts(spark):
    m = spark.createDataFrame([(1, '{"9":["1"],"9":["2","3"],"8":["4"]}')], "id int, j string")
    assert rows(lists.explode_map_of_lists(m, "id", "j", "g", "i"), "g", "i") == [("8", "4"), ("9", "2"), ("9", "3")]
    p = spark.createDataFrame([('{"a":"1","a":"2","phone":"3"}',)], "j string")
    assert p.select(jsontext.drop_json_keys(F.col("j"), ["phone"])).first()[0] == '{"a":"2"}'


def test_json_schema_is_inferred_from_all_rows(spark):
    df = spark.range(1500).select(F.when(F.col("id") < 1200, '{"a":1}').when(F.col("id") < 1201, "{bad").otherwise('{"a":1,"late":[{"x":null}],"odd":"s"}').alias("j"))
    parsed = df.select(F.from_json("j", lists.infer_json_schema(df, "j")).alias("s"))
    assert parsed.select("s.*").columns == ["a", "late", "odd"]
    assert parsed.filter("s.odd = 's'").count() == 299


def test_all_tiers_of_a_list(spark):
    seven = ",".join(f'{{"bonus_point":"{i}"}}' for i in range(1, 8))
    df = spark.createDataFrame([(1, f"[{seven}]"), (2, "bad"), (3, '[{"bonus_point":"5","member_level_id":"2"},{"bonus_point":null}]')], "id int, j string")
    assert lists.longest_array(df, "j") == 7
    long = lists.explode_objects(df, ["id"], "j", ["bonus_point", "member_level_id"])
    assert rows(long.filter("id = 1 and value is not null"), "position", "field", "value") == [(i, "bonus_point", str(i)) for i in range(1, 8)]
    last = jsontext.last_of(F.col("j"), ["bonus_point", "member_level_id"])
    assert [tuple(r) for r in df.orderBy("id").select(*last.values()).collect()] == [("7", None), (None, None), ("5", "2")]


def test_text_samples(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(text.stamp_rule_value(F.lit("300:1|500:2"), "1")) == "300"
    assert get(text.stamp_rule_value(F.lit("250:9"), "1")) == "250"
    assert get(text.split_code(F.lit("M12S345"), "^M([0-9]+)S([0-9]+)$", 2)) == 345
    assert get(text.split_code(F.lit("nothing"), "^M([0-9]+)S([0-9]+)$", 2)) is None
    assert get(text.normalise_ref(F.lit("00INV-9r"))) == "00inv9"
    assert get(text.trimmed_ref(F.lit("00INV-9r"))) == "inv-9"
    url = "https://h/p?utm_source=s&utm_mall=m"
    assert get(text.url_param(F.lit(url), "utm_source")) == "s" and get(text.url_param(F.lit(url), "utm_medium")) is None
    assert get(text.clean_sentinels(F.lit(" #n/a "), default="U")) == "U"
    assert get(text.first_present(F.lit(""), F.lit(None).cast("string"), F.lit("z"))) == "z"
    links = lists.link_positions(spark.createDataFrame([(1, "5, 12,13")], "id int, l string"), "id", "l")
    assert rows(links, "token", "position") == [("12", 2), ("13", 3), ("5", 1)]
    assert text.underscore_name(" Delivery Log  ID") == "delivery_log_id"


def test_stamp_gift_list(spark):
    card = spark.createDataFrame([(1, "a|@|G1:b|@|200", "5:10", "0:1")], "id int, gift_tier_str string, gift_stamp_required_str string, gift_requires_approval_str string")
    assert rows(stamps.gift_list(card), "physical_gift", "points", "stamp_required", "approval_required") == [("", "200", "10", "1"), ("G1", "", "5", "0")]


def test_campaign_precedence(spark):
    cols = "receipt_id int, invoice_no string, member_id string, shop_id int, spending_campaign_id int, tier_id int, redemption_date string, redemption_mall_id int, linked_spend_type string"
    base = ("m", 1, 7, 70, "d", 3)
    data = [(1, "i1", *base, campaign.FIRST), (2, "i1", *base, campaign.FIRST_INDIRECT), (3, "i1", "m", 2, 7, 70, "d", 3, campaign.SECOND_INDIRECT), (5, "i2", *base, campaign.SECOND), (4, "i2", *base, campaign.SECOND)]
    out = campaign.without_repeats(spark.createDataFrame(data, cols))
    assert rows(out, "receipt_id", "spending_filter") == [(1, campaign.VALID), (3, campaign.REPEATED), (4, campaign.VALID)]
