"""Streaming pairs against a plain search, over several runs and arrival orders."""

import random
from datetime import datetime, timedelta

from martkit.streaming import pairing

SCHEMA = "plate string, site int, ts timestamp_ntz, op string"
ARGS = {"keys": ["plate", "site"], "ts": "ts", "op": "op", "first": "in", "second": "out", "name": "out_ts", "longest": "6 hours", "delay": "2 days"}


def brute(rows):
    entries = {r[:3] for r in rows if r[3] == "in" and None not in r}
    longest = timedelta(hours=6)
    return sorted(((p, s, t, min((r[2] for r in rows if r[3] == "out" and r[:2] == (p, s) and r[2] is not None and t < r[2] <= t + longest), default=None)) for p, s, t in entries), key=str)


def test_pairs_over_runs(spark, tmp_path):
    rng = random.Random(5)
    start = datetime(2024, 3, 1)
    rows = [(rng.choice(["hot", "hot", *[f"p{k}" for k in range(6)]]), rng.randrange(2), start + timedelta(minutes=rng.randrange(40 * 60)), rng.choice(["in", "out", "other"])) for _ in range(700)]
    rows += rows[:40]  # repeated events
    rows += [(None, 1, start, "in"), ("p1", None, start, "out"), ("p1", 1, None, "in")]
    rng.shuffle(rows)
    src, dst, state = (f"{tmp_path}/{n}" for n in ("src", "dst", "state"))
    for part in range(3):
        spark.createDataFrame(rows[part::3], SCHEMA).coalesce(2).write.mode("append").parquet(src)
        pairing.pair_new_files(spark, src, dst, SCHEMA, state, max_files=1, **ARGS)
    assert spark.read.schema("plate string, site int, ts timestamp_ntz, out_ts timestamp_ntz").parquet(dst).count() < len(brute(rows))  # the last two days are open
    end = start + timedelta(days=30)
    spark.createDataFrame([("end", 0, end, "in"), ("end", 0, end, "out")], SCHEMA).write.mode("append").parquet(src)
    for _ in range(2):  # the second run finds nothing new
        pairing.pair_new_files(spark, src, dst, SCHEMA, state, **ARGS)
    got = sorted((tuple(r) for r in spark.read.parquet(dst).select("plate", "site", "ts", "out_ts").collect()), key=str)
    assert got == brute(rows) and any(r[3] is None for r in got)
