"""Gap-free row numbers over a whole table without one task sorting it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window

from martkit.sources.staging import Stage


def add_row_id(df: DataFrame, order: Sequence[str], name: str, stage: Stage, start: int = 1) -> DataFrame:
    """1-based position of each row in the global order.

    Rows are range-partitioned by the whole ``order``, so the pieces are even whatever the leading column holds, and
    staged with the number of their piece. They are numbered inside the piece and shifted by the sizes of
    the earlier ones. The staged piece number is data, so a recomputed task gives the same ids; ``stage`` must write.
    ``order`` must be total. The shifts are one row per piece.
    """
    pieces = stage(df.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id()), "pieces")
    sizes = pieces.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    shift = sizes.select(F.col("_piece").alias("_p"), F.coalesce(before, F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("_piece").orderBy(*order))
    out = pieces.withColumn("_local", local).join(shift, F.col("_piece") == F.col("_p"))
    return out.withColumn(name, (F.col("_local") + F.col("_shift") + F.lit(start - 1)).cast("long")).drop("_piece", "_p", "_shift", "_local")
