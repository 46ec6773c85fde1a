"""Readers, writers and the file stream."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martkit import session
from martkit.sources import readers, staging, writers
from martkit.streaming import arrivals


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hash_predicates_are_disjoint_and_complete():
    got = readers.hash_predicates("receipt_id", 3)
    assert got == ["MOD(CRC32(receipt_id), 3) = 0 OR receipt_id IS NULL", "MOD(CRC32(receipt_id), 3) = 1", "MOD(CRC32(receipt_id), 3) = 2"]


def test_jdbc_options():
    assert readers.jdbc_range_options("u", "t", "id", 1, 100, 20)["numPartitions"] == "20"
    assert readers.jdbc_query_options("u", "SELECT 1")["query"] == "SELECT 1"
    assert "DATE(created)" in readers.changed_since_query("t", ["a"], "updated", "created", "2024-01-01")


def test_replace_range_removes_vanished_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 3))], "id int, d date")
    writers.write_snapshot(df, path, ["d"])
    fresh = spark.createDataFrame([(9, date(2024, 1, 3))], "id int, d date")
    for _ in range(2):
        writers.replace_range(fresh, path, "d", "2024-01-02", staging.StagedTables(spark, str(tmp_path / "stage")))
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (9,)]


def test_replace_range_from_the_target_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 3))], "id int, d date")
    writers.write_snapshot(df, path, ["d"])
    with staging.StagedTables(spark, str(tmp_path / "stage")) as stage:
        writers.replace_range(spark.read.parquet(path).filter("id < 3").withColumn("id", F.col("id") * 10), path, "d", "2024-01-02", stage)
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (20,)]
    assert not os.path.exists(tmp_path / "stage")


def test_replace_range_wants_a_date(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1))], "id int, d date")
    writers.write_snapshot(df, path, ["d"])
    with pytest.raises(ValueError):
        writers.replace_range(df.withColumn("d", F.col("d").cast("timestamp_ntz")), path, "d", "2024-01-01", staging.StagedTables(spark, str(tmp_path / "stage")))
    assert spark.read.parquet(path).count() == 1


def test_append_log_is_idempotent_per_day(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([(1,)], "id int")
    for stamp in ("2024-01-01", "2024-01-02", "2024-01-02"):
        writers.append_log(df, path, "d", stamp)
    assert spark.read.parquet(path).count() == 2


def test_export_formats_and_marker(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 15, 2, 3), None), (2, None, "x")], "id int, ts timestamp_ntz, s string")
    writers.export_csv(df, path, sep="|")
    files = os.listdir(path)
    assert "_SUCCESS" in files and all(f.endswith(".csv.gz") for f in files if f.startswith("part-"))
    back = readers.read_delimited(spark, path, "id int, ts string, s string", sep="|")
    assert rows(back.select("id", "ts")) == [(1, "2024-01-01 15:02:03"), (2, None)]


def test_an_export_keeps_its_parts(spark, tmp_path):
    path = str(tmp_path / "parts")
    writers.export_csv(spark.range(0, 100, 1, 4), path)
    assert sum(f.endswith(".csv.gz") for f in os.listdir(path)) == 4
    assert readers.read_delimited(spark, path, "id bigint").count() == 100


def test_backup_stops_on_a_failed_check(spark, tmp_path):
    live = str(tmp_path / "live")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, d date")
    writers.write_snapshot(df, live, ["d"])
    with pytest.raises(ValueError):
        writers.backup_and_replace(df.filter("id = 2"), live, str(tmp_path / "copy"), "d", "2024-01-02", staging.StagedTables(spark, str(tmp_path / "stage")), check=lambda fresh: False)
    assert spark.read.parquet(live).count() == 2


def test_union_needs_listed_tables(spark):
    control = spark.createDataFrame([("a", "k")], "name string, kind string")
    with pytest.raises(ValueError):
        readers.read_union(control, "kind", "other", "name", lambda n: None)


def test_stage_reads_back_what_it_wrote(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    with staging.StagedTables(spark, str(tmp_path)) as stage:
        assert rows(stage(df, "probe")) == rows(stage(df, "probe")) == rows(df)
    assert not tmp_path.exists()


class Cluster:
    """The part of a session that the scratch folder looks at."""

    def __init__(self, master, **conf):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self._conf = conf

    def get(self, key, default=None):
        return self._conf.get(key, default)


def test_scratch_follows_the_cluster_setting():
    cluster = Cluster("yarn", **{"spark.checkpoint.dir": "/shared/somewhere/"})
    assert session.scratch_path(cluster, "x").startswith("/shared/somewhere/martkit-x-")


def test_scratch_is_never_machine_local_on_a_cluster():
    with pytest.raises(ValueError):
        session.scratch_path(Cluster("yarn"), "x")


def test_stream_loads_each_file_once_and_archives(spark, tmp_path):
    src, dst, state, done = (str(tmp_path / n) for n in ("in", "out", "state", "done"))
    os.makedirs(src)

    def arrive(name, first):
        with open(f"{src}/{name}.csv", "w") as f:
            f.write("id,ts\n" + "".join(f"{i},2024-01-01 07:{i % 60:02d}:00\n" for i in range(first, first + 5)))

    run = lambda: arrivals.ingest_new_files(spark, src, dst, "id int, ts timestamp_ntz", state, ts="ts", offset_hours=8, options={"header": "true"}, archive=done)
    arrive("a", 0)
    run()
    run()
    arrive("b", 5)
    run()
    out = spark.read.parquet(dst)
    assert sorted(r.id for r in out.collect()) == list(range(10))
    assert {str(r.dt) for r in out.select("dt").distinct().collect()} == {"2023-12-31"}


def test_checks_in_flight_stop_a_load(spark, tmp_path):
    """Totals are gathered while the rows are staged: each row is computed once, and a load that looks wrong changes nothing."""
    path, backup = f"{tmp_path}/facts", f"{tmp_path}/backup"
    old = spark.range(40).selectExpr("id", "id * 10 as amount", "date_add(date '2024-01-01', cast(id div 10 as int)) as day")
    writers.write_snapshot(old, path, ["day"])
    computed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    fresh = spark.range(20, 45).selectExpr("id", "id * 11 as amount", "date_add(date '2024-01-01', cast(id div 10 as int)) as day").mapInArrow(seen, "id long, amount long, day date")
    metrics = {"n": F.count(F.lit(1)), "total": F.sum("amount"), "unplaced": F.count_if(F.col("day").isNull())}
    got = {}

    def expect(values, least):
        got.update(values)
        return values["n"] >= least and not values["unplaced"]

    with staging.StagedTables(spark, f"{tmp_path}/stage") as stage:
        with pytest.raises(ValueError, match="nothing was replaced"):
            writers.backup_and_replace(fresh, path, backup, "day", "2024-01-03", stage, metrics=metrics, expect=lambda v: expect(v, 100))
        assert got == {"n": 25, "total": sum(11 * i for i in range(20, 45)), "unplaced": 0} and computed.value == 25
        assert spark.read.parquet(path).agg(F.sum("amount")).first()[0] == 10 * sum(range(40))
        writers.backup_and_replace(fresh, path, backup, "day", "2024-01-03", stage, metrics=metrics, expect=lambda v: expect(v, 20))
        with pytest.raises(ValueError):
            writers.backup_and_replace(fresh, path, backup, "day", "2024-01-03", staging.recompute, metrics=metrics)
    assert computed.value == 50
    assert spark.read.parquet(path).agg(F.sum("amount")).first()[0] == 10 * sum(range(20)) + 11 * sum(range(20, 45))
    assert spark.read.parquet(backup).count() == 20


def test_bucketed_facts_meet_without_exchange(spark, tmp_path):
    from martkit.operators import joins

    receipts = spark.range(5000).selectExpr("id as receipt_id", "id % 70 as member", "id % 13 as amount")
    points = spark.range(0, 5000, 3).selectExpr("id as receipt_id", "id % 7 as points")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        writers.write_bucketed(receipts, "receipts_b", ["receipt_id"], 6, f"{tmp_path}/receipts")
        writers.write_bucketed(points, "points_b", ["receipt_id"], 6, f"{tmp_path}/points")
        facts, side = spark.table("receipts_b"), spark.table("points_b")
        for df in (facts.join(side, "receipt_id", "left"), joins.anti(facts, side, {"receipt_id": "receipt_id"}), facts.join(side.groupBy("receipt_id").agg(F.sum("points").alias("p")), "receipt_id")):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert facts.join(side, "receipt_id", "left").count() == 5000 and joins.anti(facts, side, {"receipt_id": "receipt_id"}).count() == 5000 - points.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("drop table if exists receipts_b")
        spark.sql("drop table if exists points_b")
