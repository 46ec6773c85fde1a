"""Each arriving file is loaded once, under a partition day, and archived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from martkit.functions.dates import local_date


def ingest_new_files(spark: SparkSession, src: str, dst: str, schema: StructType | str, checkpoint: str, *, ts: str,
                     day: str = "dt", offset_hours: int = 0, fmt: str = "csv", options: dict[str, str] | None = None,
                     archive: str | None = None, transform: Callable[[DataFrame], DataFrame] | None = None,
                     max_files: int | None = None) -> None:
    """Load all files that arrived since the last run and stop.

    The stream's checkpoint remembers the files, so a rerun or a lost executor loads
    none twice. With ``archive`` finished files are moved there by Spark in a later batch.
    ``max_files`` bounds a batch after an outage.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(src)
    if transform is not None:
        rows = transform(rows)
    rows = rows.withColumn(day, local_date(F.col(ts), offset_hours))
    query = (rows.writeStream.format("parquet").partitionBy(day).option("path", dst)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
