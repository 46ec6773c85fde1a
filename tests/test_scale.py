"""What must hold at any size: results do not depend on segments, plans stay parallel, hot keys are split."""

import re
import random
import time

import pytest
from pyspark.sql import functions as F

from checks.registry import Tables
from martkit.operators import filters, joins, latest, ordered, rowids, sets
from martkit.sources import staging
from tests.test_oracle import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of the rows."""
    rng = random.Random(7)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.randrange(500), rng.choice(["in", "out", "x"]), rng.randrange(1, 9)) for i in range(1500)]
    return spark.createDataFrame(data, "k string, t int, op string, a int").withColumn("pool", F.lit(900))


def table(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_running_sum_on_a_hot_key(hot, block):
    got = ordered.running_sum(hot, ["k"], "t", "a", "s", ordered.id_blocks("t", block))
    data = hot.collect()
    want = sorted((r.k, r.t, r.op, r.a, sum(q.a for q in data if q.k == r.k and q.t <= r.t)) for r in data)
    assert table(got, "k", "t", "op", "a", "s") == want


@pytest.mark.parametrize("block", [1, 13, 1000])
def test_pairing_and_ordinal_on_a_hot_key(hot, block):
    data = hot.collect()
    seg = ordered.id_blocks("t", block)
    got = ordered.pair_next(hot, ["k"], "t", "op", "in", "out", "n", seg)
    want = sorted((r.k, r.t, min((q.t for q in data if q.k == r.k and q.op == "out" and q.t > r.t), default=-1)) for r in data if r.op == "in")
    assert table(got.fillna(-1, ["n"]), "k", "t", "n") == want
    ranked = ordered.ordinal(hot, ["k"], "t", "pos", seg)
    assert table(ranked, "k", "t", "pos") == sorted((r.k, r.t, 1 + sum(q.k == r.k and q.t < r.t for q in data)) for r in data)


def test_allocation_never_exceeds_the_pool(hot):
    unique = hot.groupBy("k", "t").agg(F.sum("a").alias("a"), F.first("pool").alias("pool"))
    out = ordered.allocate(unique, ["k"], "t", "a", "pool", "got", ordered.id_blocks("t", 50)).groupBy("k").agg(F.sum("got").alias("got"), F.sum("a").alias("a"))
    assert all(r.got == min(r.a, 900) for r in out.collect())


@pytest.fixture
def plain_joins(spark):
    """No broadcasts and no merged partitions, so that the dealing itself is seen."""
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hopeless_keys_are_dealt_out(spark, plain_joins):
    """Two thirds of the facts have no key or a filler; no task gets more than a quarter of the rows."""
    facts = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("none")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 900)).alias("k"))
    dim = spark.range(900).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    flagged = joins.flag_exists(facts, dim, {"key": "k"}, "hit", fillers=["none"])
    chained = joins.enrich(facts, [(dim, {"key": "k"}, {"v": "v"}), (dim, {"key": "k"}, {"w": "w"})], fillers={"k": ["none"]})
    for out, column in ((flagged, "hit"), (chained, "w")):
        assert largest_share(out) < 0.25
        assert out.columns[:2] == ["id", "k"] and out.count() == 30_000
        assert out.filter(f"{column} > 0").count() == facts.filter("k like 'k%' and k <> 'none'" + (" and k <> 'k0'" if column == "w" else "")).count()
    assert plan_of(chained).count("Exchange") == plan_of(joins.enrich(facts, [(dim, {"key": "k"}, {"v": "v"})])).count("Exchange") + 2  # named twice each: one key, one shuffle of the facts


def test_a_hot_key_that_matches_is_salted(spark, plain_joins):
    facts = spark.range(30_000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"))
    dim = spark.range(900).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("v")).unionByName(spark.range(1).select(F.lit("hot").alias("key"), F.lit(-1).cast("long").alias("v")))
    flagged = joins.flag_exists(facts, dim, {"key": "k"}, "hit", salt=32)
    joined = joins.enrich_salted(facts, dim, {"key": "k"}, {"v": "v"}, 32)
    for out in (flagged, joined):
        assert largest_share(out) < 0.25 and out.count() == 30_000
    assert flagged.filter("hit = 1").count() == joined.filter("v is not null").count() == 30_000


def test_hot_keys_are_found_and_salted(spark, plain_joins):
    """Two keys hold most facts; neither they nor a number of salts is named. Other keys are not copied."""
    facts = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 4 == 0, "warm").when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"))
    dim = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("v")).unionByName(spark.createDataFrame([("hot", -1), ("warm", -2)], "key string, v long"))
    hot = joins.hot_keys(facts, ["k"])
    named = hot.join(facts.select("k", F.xxhash64("k").alias("_hot")).distinct(), "_hot")
    assert {r["k"] for r in named.collect()} == {"hot", "warm"}
    joined, flagged = joins.enrich_hot(facts, dim, {"key": "k"}, {"v": "v"}, hot=hot), joins.flag_exists_hot(facts, dim, {"key": "k"}, "hit", hot=hot)
    want = joins.enrich(facts, [(dim, {"key": "k"}, {"v": "v"})])
    assert joined.exceptAll(want).isEmpty() and want.exceptAll(joined).isEmpty()
    assert flagged.filter("hit = 1").count() == want.filter("v is not null").count() and flagged.count() == 60_000
    assert largest_share(joined) < 0.2 < largest_share(facts.join(dim, facts.k == dim.key, "left"))
    side = joins._salted(facts, dim.withColumnRenamed("key", "_k_key"), {"key": "k"}, None, "_k_", hot)[1]
    copies = {r["_k_key"]: r["count"] for r in side.groupBy("_k_key").count().collect()}
    assert copies["hot"] > copies["warm"] > 1 and max(n for k, n in copies.items() if k.startswith("k")) == 1


def test_no_hot_key_no_salt(spark, plain_joins):
    facts = spark.range(1000).select("id", (F.col("id") % 500).alias("k"))
    assert joins.hot_keys(facts, ["k"]).count() == 0 and joins.hot_keys(facts.limit(0), ["k"]).count() == 0
    dim = spark.range(400).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    assert joins.enrich_hot(facts, dim, {"key": "k"}, {"v": "v"}).filter("v is not null").count() == 800
    assert joins.enrich_hot(facts.limit(0), dim, {"key": "k"}, {"v": "v"}).count() == 0


def test_enrichment_reads_only_what_is_asked_for(spark):
    t = Tables(spark, SF)
    for df in (joins.enrich(t.lineitem, [(t.part, {"p_partkey": "l_partkey"}, {"p_name": "p_name"})]).select("l_orderkey", "p_name"),
               joins.flag_exists(t.lineitem, t.part, {"p_partkey": "l_partkey"}, "hit").select("l_orderkey", "hit")):
        assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan_of(df)
    spread = joins.enrich(t.lineitem, [(t.part, {"p_partkey": "l_partkey"}, {"p_name": "p_name"})], spread_by=["l_shipdate"]).select("l_suppkey", "p_name")
    read = plan_of(spread).split("ReadSchema: struct<", 1)[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == {"l_suppkey", "l_partkey", "l_shipdate"}


def test_long_chains_are_planned_quickly(spark):
    wide = Tables(spark, SF).lineitem.select("*", *[(F.col("l_partkey") % n).alias(f"k{n}") for n in range(2, 22)])
    dims = [(spark.range(50).select(F.col("id").alias("id"), F.concat(F.lit(f"{n}-"), "id").alias("name")), {"id": f"k{n}"}, {"name": f"name{n}"}) for n in range(2, 12)]
    start = time.time()
    plan = plan_of(joins.enrich(wide, dims).withColumn("n", F.concat_ws(",", *[f"name{n}" for n in range(2, 12)])).filter("n <> ''"))
    assert time.time() - start < 20 and plan.count("Join") >= 10


def test_no_task_holds_a_hot_key(hot):
    """The rows of the hot key end up in many window groups."""
    groups = hot.withColumn("seg", ordered.id_blocks("t", 50)).groupBy("k", "seg").count()
    assert groups.agg(F.max("count")).first()[0] < hot.count() / 10


def test_row_ids_are_gap_free(hot, tmp_path):
    unique = hot.withColumn("u", F.monotonically_increasing_id())
    out = rowids.add_row_id(unique, ["t", "u"], "id", staging.StagedTables(hot.sparkSession, str(tmp_path)))
    assert sorted(r.id for r in out.select("id").collect()) == list(range(1, 1501))
    assert out.orderBy("id").select("t").collect() == unique.orderBy("t", "u").select("t").collect()


def test_split_is_disjoint_and_complete(hot):
    df = hot.withColumn("a", F.when(F.col("a") > 2, F.col("a")))
    one, two = sets.split_by(df, F.col("a") > 5)
    assert one.count() + two.count() == df.count()
    assert one.filter("a is null").count() == df.filter("a is null").count()


def test_upserts_and_overrides_do_not_fan_out(hot):
    fixes = hot.select("k").distinct().withColumns({"t": F.lit(1), "op": F.lit("x"), "a": F.lit(1), "pool": F.lit(1)})
    assert sets.override_rows(hot, fixes, ["k"]).count() == fixes.count()


def test_filters_reach_the_scan(spark):
    t = Tables(spark, SF)
    for df in (filters.last_days(t.orders, "o_orderdate", 90, "2001-08-01"), filters.complete_months(t.orders, "o_orderdate", 12, "2001-08-01"), filters.changed_on(t.events, "2024-01-15", ["ts"])):
        plan = plan_of(df)
        assert "PushedFilters: [" in plan and "GreaterThanOrEqual" in plan


def test_columns_are_pruned(spark):
    plan = plan_of(Tables(spark, SF).lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity")))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan


def test_first_row_filters_cut_before_the_shuffle(spark):
    t = Tables(spark, SF)
    for df in (latest.latest_per_key(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]), latest.first_ranked(t.events, ["user_id"], ["ts"])):
        plan = plan_of(df)
        assert plan.count("WindowGroupLimit") >= 2


def test_existence_is_planned_as_semi_and_anti_joins(spark):
    t = Tables(spark, SF)
    assert "LeftAnti" in plan_of(joins.anti(t.orders, t.lineitem, {"l_orderkey": "o_orderkey"}))
    assert "LeftSemi" in plan_of(joins.semi(t.orders, t.lineitem, {"l_orderkey": "o_orderkey"}))


def test_row_level_operators_never_use_one_task(spark, tmp_path):
    """The numbering itself is split by piece; only the pieces' sizes meet in one task."""
    t = Tables(spark, SF)
    seg = ordered.day_blocks("ts")
    for df in (ordered.pair_next(t.events, ["user_id"], "ts", "event_type", "click", "purchase", "o", seg), ordered.running_sum(t.events, ["user_id"], "ts", "value", "s", seg),
               ordered.ordinal(t.events, ["event_type"], "ts", "p", seg)):
        assert "SinglePartition" not in plan_of(df)
    numbered = plan_of(rowids.add_row_id(t.orders, ["o_orderdate", "o_orderkey"], "id", staging.StagedTables(spark, str(tmp_path))))
    assert numbered.count("SinglePartition") == 1


def test_a_trusted_history_is_not_shuffled(spark):
    t = Tables(spark, SF)
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    df = sets.overlay(rows, rows, "d", "2001-05-03", trusted_history=True)
    plan = plan_of(df)
    assert plan.count("Arguments: hashpartitioning") == 1
    assert plan.index("Union") < plan.index("HashAggregate")  # only one branch below the union is aggregated
    assert df.count() == rows.count()


def test_receipts_are_shuffled_once_a_key(spark):
    """Joins of whole receipts on one key, and the removal of repeated rows after them, share a shuffle."""
    import __spark_entry__ as entry

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["mart_spending_full_variant"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert shuffles and not any(s.count("#") > 5 for s in shuffles)  # none for the distinct rows alone
    assert sum(s.startswith("receipt_id") for s in shuffles) <= 3  # before and after food orders are left out, and of the duplicates' keys
    assert sum(s.startswith("spending_transaction_id") and "_at" in s for s in shuffles) <= 2  # those of the allocated points


def test_dimensions_come_to_where_rows_lie(spark):
    """``enrich_at`` gives what ``enrich`` gives, also for null keys, hot places and equal rows, and shuffles whole rows once."""
    data = [(None if i % 11 == 0 else f"t{0 if i % 3 else i % 7}", None if i % 5 == 0 else i % 9, f"r{i % 40}", i // 2 % 50) for i in range(300)]
    facts = spark.createDataFrame(data, "at string, shop long, ref string, payload long")
    shops = spark.createDataFrame([(i, f"s{i}", None if i == 3 else i * 2) for i in range(0, 8)], "id long, name string, area long")
    refs = spark.createDataFrame([(f"r{i}", 1) for i in range(0, 40, 3)], "ref string, hit int")
    dims = [(shops, {"id": "shop"}, {"name": "shop_name", "area": "area"}), (refs, {"ref": "ref"}, {"hit": "hit"})]
    known = facts.filter("at is not null")
    names = [*facts.columns, "shop_name", "area", "hit"]
    key = lambda rows: sorted(rows, key=str)
    want = key(tuple(r) for r in joins.enrich(known, dims).select(*names).collect())
    got = joins.enrich_at(facts, "at", dims)
    assert key(tuple(r) for r in got.filter("at is not null").select(*names).collect()) == want
    lost = got.filter("at is null")
    assert lost.count() == facts.filter("at is null").count() and lost.filter("shop_name is not null or hit is not null").count() == 0


def test_spending_leads_whole_receipts_to_their_transaction_only(spark):
    """The abnormal list, members and shops come to the transaction; a mall is met there, with broadcasts off in a shuffle of its own."""
    import __spark_entry__ as entry

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = entry.queries()["mart_spending"](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    wide = {m[1] for line, child in zip(lines, lines[1:]) if "invoice_no" in child and (m := re.search(r"Exchange hashpartitioning\((\w+)#", line))}
    assert wide and wide <= {"spending_transaction_id", "mall_id"}


def test_redemptions_are_led_to_their_gift_and_their_member_only(spark):
    """Tables on a gift are met with its content; members, shops and the abnormal list where repeated rows are removed."""
    import __spark_entry__ as entry

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["mart_redemption"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not any(s.count("#") > 5 for s in shuffles)  # none for the distinct rows alone
    assert not any(s.startswith(("transaction_id", "gift_used_in_shop_id")) and "_at" in s for s in shuffles)  # whole rows do not go there


def test_full_variant_shuffles_the_wanted_columns_only(spark):
    """Rows are distinct in the columns asked for, so others are not read, and food orders are left out before lines are built."""
    import __spark_entry__ as entry

    plan = entry.queries()["mart_spending_full_variant"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "ocr_id" not in plan and "updated_by" not in plan
    assert plan.index("Join Inner, (spending_transaction_id") < plan.index("Join LeftAnti")


def test_redemption_export_leads_recent_rows_only(spark):
    """What the export leaves out by a redemption's own columns is left out before any row is led to its gift or member."""
    import __spark_entry__ as entry
    from checks import marts_core
    from martkit.plans import feeds

    plan = entry.queries()["mart_export_redemption"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "2000-08-01" in plan[plan.index("Window"):]
    t = Tables(spark, SF)
    keep = lambda rows: feeds.recent_redemptions(rows, as_of="2001-08-01", cancelled=["Cancelled Redemption"])
    early, late = marts_core.redemption_fact(t, keep), keep(marts_core.redemption_fact(t))
    assert early.count() == late.count() > 0 and early.exceptAll(late).isEmpty()


def test_categories_come_to_the_content(spark):
    """A redemption finds its category with its gift or coupon, not in a shuffle of its own, and the fact takes as many tasks as its rows ask for."""
    import __spark_entry__ as entry

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["mart_redemption"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not re.search(r"Exchange hashpartitioning\(_cat#", plan)


def test_tasks_follow_the_rows_they_sort(spark, monkeypatch):
    """Where rows are sorted whole, there are more tasks than the session's shuffle partitions once there are more rows than those hold."""
    import __spark_entry__ as entry

    monkeypatch.setattr(joins, "ROWS_A_TASK", 100)
    facts = spark.range(1500).selectExpr("cast(id % 400 as string) as at", "id % 9 as shop", "id")
    shops = spark.range(8).selectExpr("id as k", "'s' || id as name")
    few, many = (joins.enrich_at(facts, "at", [(shops, {"k": "shop"}, {"name": "name"})], rows=n) for n in (800, 1500))
    assert "REPARTITION_BY_NUM" not in plan_of(few) and "15), REPARTITION_BY_NUM" in plan_of(many)
    assert many.count() == 1500 and many.exceptAll(few).isEmpty()
    plan = entry.queries()["mart_spending"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(spending_transaction_id#\d+, [0-9]+\), REPARTITION_BY_NUM", plan)
