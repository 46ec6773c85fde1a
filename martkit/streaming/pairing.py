"""Entries of a gate paired with their exits as the events arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def pair_events(events: DataFrame, keys: Sequence[str], *, ts: str, op: str, first: str, second: str, name: str, longest: str, delay: str) -> DataFrame:
    """Each ``first`` event with the time of the first strictly later ``second`` event of its key, as a stream.

    An interval join of the stream with itself keeps an entry in state for at most ``longest`` after its time, so
    state does not grow with the log; an entry without an exit by then comes out with null. Events may arrive in
    any order within ``delay``; later ones are dropped by the watermark. A pair is emitted once, when
    no earlier exit can arrive any more. Equal entries are one. Rows with a null key or time pair with nothing
    and are left out.
    """
    at = events.filter(F.col(ts).isNotNull()).withColumn("_t", F.col(ts).cast("timestamp"))
    for k in keys:
        at = at.filter(F.col(k).isNotNull())
    begin = at.filter(F.col(op) == first).select(*keys, "_t").withWatermark("_t", delay)
    end = at.filter(F.col(op) == second).select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_t").alias("_o")).withWatermark("_o", delay)
    meets = (F.col("_o") > F.col("_t")) & (F.col("_o") <= F.col("_t") + F.expr(f"interval {longest}"))
    for k in keys:
        meets = meets & (F.col(k) == F.col(f"_o_{k}"))
    pairs = begin.join(end, meets, "left_outer").groupBy(*keys, "_t").agg(F.min("_o").alias("_o"))
    kind = events.schema[ts].dataType
    return pairs.select(*keys, F.col("_t").cast(kind).alias(ts), F.col("_o").cast(kind).alias(name))


def pair_new_files(spark: SparkSession, src: str, dst: str, schema: StructType | str, checkpoint: str, keys: Sequence[str], *, ts: str, op: str, first: str,
                   second: str, name: str, longest: str, delay: str, fmt: str = "parquet", max_files: int | None = None) -> None:
    """Pair the events of all files that arrived since the last run, append what is settled to ``dst`` and stop.

    The checkpoint holds the files read and the open entries, so a rerun or a lost executor pairs none twice.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pairs = pair_events(reader.load(src), keys, ts=ts, op=op, first=first, second=second, name=name, longest=longest, delay=delay)
    query = pairs.writeStream.format("parquet").option("path", dst).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
