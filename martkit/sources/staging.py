"""Intermediate tables for results that a mart uses several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame, str], DataFrame]


def recompute(df: DataFrame, name: str) -> DataFrame:
    """No intermediate table: every use computes the rows again."""
    return df


class StagedTables:
    """Writes each result once below a folder that all executors share, and continues from the files.

    The lineage ends there, so a lost executor costs a re-read and not the whole chain. The owner
    removes the tables with ``close`` (or a ``with`` block) when nothing reads them any more.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.made = spark, root.rstrip("/"), 0

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}-{name}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> StagedTables:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
