"""Sources, sinks and stateful loads: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from martkit.functions import dates
from martkit.operators import joins, reduction, sets
from martkit.sources import readers, writers
from martkit.streaming import arrivals, pairing

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"


@check("src01_catalog_scan", "select o_orderkey, o_custkey, o_orderstatus from orders")
def _(t):
    return readers.read_table(t.spark, f"{t.sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")


@check("src05_delimited_scan", "select * from customer")
def _(t):
    parts = []
    for sep, part in ((";", t.customer.filter("c_nationkey < 10")), ("|", t.customer.filter("c_nationkey >= 10"))):
        path = t.scratch("csv")
        writers.export_csv(part, path, sep=sep)
        parts.append(readers.read_delimited(t.spark, path, CUSTOMER, sep=sep))
    return sets.union_all(*parts)


@check("src06_json_scan", "select event_id, ts, user_id, event_type, value, props from events")
def _(t):
    root = t.scratch("json")
    day = F.date_format("ts", "yyyyMMdd")
    (t.events.withColumn("day", day).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .partitionBy("day").json(root))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    return readers.read_json(t.spark, f"{root}/day=*/*.json", schema)


@check("src07_union_by_control_table", """
    select distinct event_id, ts, user_id, value, event_type from events where event_type in ('click', 'view')""")
def _(t):
    root = t.scratch("union")
    t.events.drop("props").write.partitionBy("event_type").parquet(root)
    control = t.events.select("event_type").distinct().withColumn(
        "kind", F.when(F.col("event_type").isin("click", "view"), "browse").otherwise("other"))
    return readers.read_union(control, "kind", "browse", "event_type", lambda names: t.spark.read.option("basePath", root).parquet(
        *[f"{root}/event_type={name}" for name in names]))


@check("src08_code_table", """
    select o_orderkey, case o_orderstatus when 'O' then 'Open' when 'F' then 'Filled' end as status_detail from orders""")
def _(t):
    table = joins.code_table(t.orders, {"O": "Open", "F": "Filled"}, "code", "label")
    return joins.decode_join(t.orders, table, "o_orderstatus", "code", "label", "status_detail").select("o_orderkey", "status_detail")


@check("snk01_snapshot", "select s_suppkey, s_name, s_acctbal from supplier")
def _(t):
    path = t.scratch("snapshot")
    writers.write_snapshot(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    return readers.read_table(t.spark, path)


@check("snk02_partitioned_snapshot", ORDERS)
def _(t):
    path = t.scratch("partitioned")
    writers.write_snapshot(t.orders, path, ["o_orderstatus"], spread=4)
    return t.spark.read.parquet(path)


@check("snk03_append_log", """
    select c_custkey, c_acctbal, date '2024-01-01' as snapshot_date from customer
    union all select c_custkey, c_acctbal + 1, date '2024-01-02' from customer""")
def _(t):
    path = t.scratch("log")
    rows = t.customer.select("c_custkey", "c_acctbal")
    later = rows.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    for stamp, df in (("2024-01-01", rows), ("2024-01-02", rows), ("2024-01-02", later)):  # the last day is loaded twice
        writers.append_log(df, path, "snapshot_date", stamp)
    return t.spark.read.parquet(path)


@check("snk04_export_gzip_csv", "select o_orderkey, o_totalprice, o_orderdate from orders")
def _(t):
    path = t.scratch("export")
    writers.export_csv(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), path, sep=";")
    return readers.read_delimited(t.spark, path, "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz", sep=";",
                                  timestamp_format="yyyy-MM-dd HH:mm:ss")


@check("snk05_export_multi_part", "select p_partkey, p_name, p_retailprice from part")
def _(t):
    path = t.scratch("parts")
    writers.export_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), path)
    return readers.read_delimited(t.spark, path, "p_partkey bigint, p_name string, p_retailprice double")


@check("snk06_replace_range", """
    select o_orderkey, o_totalprice, cast(date_trunc('month', o_orderdate) as date) as mon from orders
    where o_orderdate < timestamp '2001-01-01'
    union all
    select o_orderkey, o_totalprice + 1, cast(date_trunc('month', o_orderdate) as date) from orders
    where o_orderdate >= timestamp '2001-01-01' and o_orderdate < timestamp '2001-07-01'""")
def _(t):
    path = t.scratch("replace")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("mon"))
    writers.write_snapshot(rows, path, ["mon"], spread=1)
    fresh = rows.filter("mon >= date'2001-01-01' and mon < date'2001-07-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    writers.replace_range(fresh, path, "mon", "2001-01-01", t.stage)
    return t.spark.read.parquet(path)


@check("snk07_truncate_and_load", "select c_custkey, c_acctbal * 2 as c_acctbal from customer")
def _(t):
    path = t.scratch("reload")
    writers.write_snapshot(t.customer.select("c_custkey", "c_acctbal"), path)
    writers.write_snapshot(t.customer.select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal")), path)
    return t.spark.read.parquet(path)


STAGED = """
    staged as (
      select case when c_nationkey < 5 then c_custkey else c_custkey + 100000000 end as c_custkey,
             c_acctbal + 100 as c_acctbal, case when c_acctbal >= 0 then c_mktsegment end as c_mktsegment
      from customer where c_nationkey < 8)"""


def _staged(t):
    moved = F.when(F.col("c_nationkey") < 5, F.col("c_custkey")).otherwise(F.col("c_custkey") + 100000000)
    return t.customer.filter("c_nationkey < 8").select(
        moved.alias("c_custkey"), (F.col("c_acctbal") + 100).alias("c_acctbal"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"))


@check("snk08_upsert_insert", f"""
    with {STAGED}
    select coalesce(c.c_custkey, s.c_custkey) as c_custkey,
           case when s.c_custkey is not null then s.c_acctbal else c.c_acctbal end as c_acctbal,
           case when s.c_custkey is not null then s.c_mktsegment else c.c_mktsegment end as c_mktsegment,
           case when s.c_custkey is not null then date '2024-01-31' end as retrieved
    from customer c full outer join staged s on c.c_custkey = s.c_custkey""")
def _(t):
    target = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return writers.upsert(target, _staged(t), ["c_custkey"], ["c_acctbal", "c_mktsegment"], "retrieved", "2024-01-31")


@check("snk08_upsert_update_only", f"""
    with {STAGED}
    select c.c_custkey, case when s.c_custkey is not null then s.c_acctbal else c.c_acctbal end as c_acctbal
    from customer c left join staged s on c.c_custkey = s.c_custkey""")
def _(t):
    return writers.upsert(t.customer.select("c_custkey", "c_acctbal"), _staged(t), ["c_custkey"], ["c_acctbal"], insert=False)


@check("snk09_split_two_sinks", """
    select o_orderkey, case when o_orderpriority = '1-URGENT' then 'partner' else 'mall' end as sink
    from (select o_orderkey, nullif(o_orderpriority, '5-LOW') as o_orderpriority from orders) x""")
def _(t):
    one, two = t.scratch("mall"), t.scratch("partner")
    df = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    writers.write_split(df, F.col("p") != "1-URGENT", one, two, t.stage)
    return sets.union_all(*[t.spark.read.parquet(p).select("o_orderkey", F.lit(n).alias("sink")) for p, n in ((one, "mall"), (two, "partner"))])


@check("snk10_file_per_value", "select o_orderkey, o_totalprice, o_orderpriority from orders")
def _(t):
    path = t.scratch("per-value")
    writers.export_per_value(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), "o_orderpriority", path, ["o_orderkey"], spread=2)
    return t.spark.read.schema("o_orderkey bigint, o_totalprice double, o_orderpriority string").csv(path, header=True)


@check("snk11_passthrough_tables", """
    select 'customer' as name, c_custkey as id from customer union all select 'supplier', s_suppkey from supplier
    union all select 'part', p_partkey from part""")
def _(t):
    paths = writers.snapshot_tables({"customer": t.customer, "supplier": t.supplier, "part": t.part}, t.scratch("copies"))
    ids = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    return sets.union_all(*[t.spark.read.parquet(p).select(F.lit(n).alias("name"), F.col(ids[n]).alias("id")) for n, p in paths.items()])


@check("set07_union_of_files", "select c_custkey, c_name from customer union all select s_suppkey, s_name from supplier")
def _(t):
    paths = []
    for df, key, name in ((t.customer, "c_custkey", "c_name"), (t.supplier, "s_suppkey", "s_name")):
        paths.append(t.scratch("files"))
        writers.export_csv(df.select(F.col(key).alias("c_custkey"), F.col(name).alias("c_name")), paths[-1])
    return readers.read_delimited(t.spark, paths, "c_custkey bigint, c_name string")


@check("str01_file_arrival_stream", """
    select event_id, ts, user_id, event_type, value, cast(ts - interval '8' hour as date) as dt from events""")
def _(t):
    src, dst, state = t.scratch("in"), t.scratch("landed"), t.scratch("state")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    rows = t.events.drop("props")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    # Two arrivals: the second run must load only what is new.
    for cond in (F.col("event_type").isin("click", "view"), ~F.col("event_type").isin("click", "view")):
        rows.filter(cond).write.mode("append").option("timestampNTZFormat", fmt).option("header", True).csv(src)
        arrivals.ingest_new_files(t.spark, src, dst, schema, state, ts="ts", offset_hours=8, fmt="csv",
                                  options={"header": "true", "timestampNTZFormat": fmt})
    return t.spark.read.parquet(dst)


@check("str02_gate_pairing_stream", """
    select g.lpn, g.carparkid, g.timestamp, min(o.timestamp) as out_ts from (select distinct * from src_gate_log where operation = 'in') g
    left join src_gate_log o on o.operation = 'out' and o.lpn = g.lpn and o.carparkid = g.carparkid and o.timestamp > g.timestamp and o.timestamp <= g.timestamp + interval '3' day group by 1, 2, 3""")
def _(t):
    src, dst, state = t.scratch("gates"), t.scratch("paired"), t.scratch("open")
    log = t.derived("src_gate_log")
    # Files in any order of time, two a batch; a last event of each kind closes the log.
    log.repartition(5, F.xxhash64("lpn", "timestamp") % 101).write.parquet(src)
    closing = log.agg((F.max("timestamp") + F.expr("interval 200 days")).alias("timestamp")).select(F.lit("end").alias("lpn"), F.lit(0).cast(log.schema["carparkid"].dataType).alias("carparkid"), "timestamp", F.explode(F.array(F.lit("in"), F.lit("out"))).alias("operation"))
    args = dict(keys=["lpn", "carparkid"], ts="timestamp", op="operation", first="in", second="out", name="out_ts", longest="3 days", delay="90 days")
    pairing.pair_new_files(t.spark, src, dst, log.schema, state, max_files=2, **args)
    closing.write.mode("append").parquet(src)
    pairing.pair_new_files(t.spark, src, dst, log.schema, state, **args)
    return t.spark.read.parquet(dst)


@check("set04_replace_keys", """
    select o_orderkey, o_totalprice, o_orderdate from orders where o_orderkey not in (select l_orderkey from lineitem where l_shipdate >= timestamp '1998-06-01')
    union all select l_orderkey, cast(-1 as double), max(l_shipdate) from lineitem where l_shipdate >= timestamp '1998-06-01' group by 1""")
def _(t):
    late = t.lineitem.filter(F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz")).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("o_orderdate"))
    delta = late.select("o_orderkey", F.lit(-1.0).alias("o_totalprice"), "o_orderdate")
    return reduction.replace_keys(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), delta, ["o_orderkey"])


@check("set04_delta_overlay", """
    select distinct * from (
      select o_orderkey, o_totalprice, cast(o_orderdate as date) as day from orders where o_orderdate < timestamp '2001-05-03'
      union all
      select o_orderkey, o_totalprice + 5, cast(o_orderdate as date) from orders where o_orderdate >= timestamp '2001-05-03') x""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    cut = dates.days_before("2001-08-01", 90)
    delta = rows.filter(F.col("day") >= F.lit(dates.days_before("2001-08-01", 120))).withColumn("o_totalprice", F.col("o_totalprice") + 5)
    return sets.overlay(rows, delta, "day", cut)


@check("snk_backup_then_replace", """
    select 'backup' as copy, o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '2001-06-01'
    union all select 'live', o_orderkey, case when o_orderdate >= timestamp '2001-06-01' then o_totalprice * 2 else o_totalprice end from orders""")
def _(t):
    live, backup = t.scratch("live"), t.scratch("backup")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("mon"))
    writers.write_snapshot(rows, live, ["mon"], spread=1)
    fresh = rows.filter("mon >= date'2001-06-01'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    writers.backup_and_replace(fresh, live, backup, "mon", "2001-06-01", t.stage)
    return sets.union_all(*[t.spark.read.parquet(p).select(F.lit(n).alias("copy"), "o_orderkey", "o_totalprice")
                            for n, p in (("live", live), ("backup", backup))])
