"""Bloom-reduced anti joins and mergeable distinct states: same rows as the plain forms, less work."""

import random

import pytest
from pyspark.sql import functions as F

from martkit.operators import distincts, joins, reduction
from martkit.plans import campaign
from martkit.sources.staging import StagedTables
from tests.test_oracle import plan_of


@pytest.fixture
def stage(spark, tmp_path):
    return StagedTables(spark, str(tmp_path))


def same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_anti_reduced_is_anti(spark):
    df = spark.range(20_000).selectExpr("id % 7000 as a", "case when id % 11 > 0 then concat('k', id % 13) end as b", "id")
    other = spark.range(900).selectExpr("id * 3 as x", "case when id % 5 > 0 then concat('k', id % 13) end as y")
    for limit in (reduction.MAX_KEYS, 10):
        same(reduction.anti_reduced(df, other, {"x": "a", "y": "b"}, limit), joins.anti(df, other, {"x": "a", "y": "b"}))
        same(reduction.anti_reduced(df, other, {"x": "a"}, limit), joins.anti(df, other, {"x": "a"}))
    same(reduction.anti_reduced(df, other.limit(0), {"x": "a"}), df)
    same(reduction.anti_reduced(df.limit(0), other, {"x": "a"}), df.limit(0))
    same(reduction.anti_reduced(df, other.selectExpr("cast(null as bigint) as x"), {"x": "a"}), df)


def test_a_long_history_is_not_shuffled(spark):
    """Ninety days replace rows of ten years: fewer history rows meet the delta than twice its rows."""
    history = spark.range(365_000).selectExpr("id as receipt", "date_add(date '2015-01-01', cast(id div 100 as int)) as day", "id % 977 as amount")
    delta = spark.range(9_000).selectExpr("356000 + id * 2 as receipt", "date_add(date '2024-10-01', cast(id div 100 as int)) as day", "-1L as amount")
    maybe, never = reduction.split_by_filter(history, delta, {"receipt": "receipt"})
    assert maybe.count() + never.count() == 365_000
    assert maybe.count() < 2 * 9_000
    got = reduction.replace_keys(history, delta, ["receipt"])
    same(got, joins.anti(history, delta, {"receipt": "receipt"}).unionByName(delta))
    assert "Exchange" not in plan_of(never).split("Subqueries")[0]  # the filter itself is built beside it


def test_states_of_days_add_up(spark, stage):
    """Yesterday's state and one day of facts give the full recount, for every day and any set of days."""
    rng = random.Random(3)
    rows = [(d, rng.choice(["m1", "m2", "hot", None]), rng.choice([None, *[f"p{k}" for k in range(30 * (d + 1))]])) for d in range(6) for _ in range(400)]
    facts = spark.createDataFrame(rows, "day int, mall string, plate string")
    total = known = None
    for d in range(6):
        today = facts.filter(F.col("day") == d)
        before = {r["plate"]: r["number"] for r in known.collect()} if known else {}
        known = distincts.dictionary(today, "plate", stage, known)
        numbers = {r["plate"]: r["number"] for r in known.collect()}
        assert before.items() <= numbers.items() and sorted(numbers.values()) == list(range(1, len(numbers) + 1))
        state = stage(distincts.states(today, ["day", "mall"], "plate", known), "day")
        total = stage(state.drop("day") if total is None else distincts.advance(total, state, ["mall"]), "total")
        until = facts.filter(F.col("day") <= d)
        want = until.groupBy("mall").agg(F.count_distinct("plate").alias("n"))
        same(distincts.count_states(total, ["mall"], "n"), want.filter("n > 0"))
        assert distincts.count_states(total, [], "n").first()["n"] == until.select(F.count_distinct("plate")).first()[0]
        same(distincts.advance(total, state, ["mall"]).select("mall", "bucket", F.hex("bits")), total.select("mall", "bucket", F.hex("bits")))  # a repeated day


def test_states_over_many_buckets(spark, stage):
    df = spark.range(100_000).selectExpr("id % 2 as g", "concat('v', id % 70000) as v")
    numbers = distincts.dictionary(df, "v", stage)
    parts = distincts.states(df, ["g"], "v", numbers)
    assert parts.count() == 2 * 3
    same(distincts.count_states(parts, ["g"], "n"), df.groupBy("g").agg(F.count_distinct("v").alias("n")))
    empty = distincts.states(df.limit(0), ["g"], "v", numbers)
    assert distincts.count_states(empty, [], "n").first()["n"] == 0 and distincts.count_states(empty, ["g"], "n").count() == 0


def test_semi_reduced_is_semi(spark):
    df = spark.range(20_000).selectExpr("id % 7000 as a", "case when id % 11 > 0 then concat('k', id % 13) end as b", "id")
    other = spark.range(900).selectExpr("id * 3 as x", "case when id % 5 > 0 then concat('k', id % 13) end as y")
    for limit in (reduction.MAX_KEYS, 10):
        same(reduction.semi_reduced(df, other, {"x": "a", "y": "b"}, limit), joins.semi(df, other, {"x": "a", "y": "b"}))


def test_linked_receipts_are_cleaned_in_one_shuffle(spark):
    """Whole linked receipts move once, nulls equal nothing, and a row given twice comes once."""
    cols = "receipt_id int, invoice_no string, member_id string, shop_id int, spending_campaign_id int, tier_id int, redemption_date string, redemption_mall_id int, linked_spend_type string"
    base = ("m", 1, 7, 70, "d", 3)
    data = [(1, "i1", *base, campaign.FIRST), (2, "i1", *base, campaign.FIRST_INDIRECT), (3, None, *base, campaign.FIRST), (4, None, *base, campaign.FIRST_INDIRECT), (5, "i5", *base, campaign.SECOND), (5, "i5", *base, campaign.SECOND)]
    out = campaign.without_repeats(spark.createDataFrame(data, cols))
    assert plan_of(out).count("hashpartitioning(") == 1
    assert sorted((r["receipt_id"], r["spending_filter"]) for r in out.collect()) == [(1, campaign.VALID), (3, campaign.VALID), (4, campaign.VALID), (5, campaign.VALID)]
