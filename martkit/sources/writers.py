"""Sinks: snapshots, append logs, exports and loads that replace a part."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType

from martkit.functions import dates
from martkit.operators import projection
from martkit.operators.sets import split_by
from martkit.sources.staging import Stage, recompute


def write_snapshot(df: DataFrame, path: str, by: Sequence[str] = (), spread: int | None = None) -> None:
    """Overwrite a Parquet folder.

    With ``by`` the folder is partitioned. ``spread`` shuffles the rows so that every
    partition value is written by at most ``spread`` tasks: few files, and a value that
    holds a large part of the rows is not left to one task.
    """
    if by and spread:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
        df = df.repartition(*[F.col(c) for c in by], salt)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_bucketed(df: DataFrame, table: str, by: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Overwrite a table of the catalog whose files are bucketed and sorted by ``by``.

    Joins and aggregations on these columns of tables with as many buckets need no exchange. The rows are dealt
    as the buckets are, so each bucket is one file. A key's rows stay
    together, so bucket facts by their own id. ``path`` keeps the files outside the warehouse.
    """
    writer = df.repartition(buckets, *by).write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_log(df: DataFrame, path: str, by: str, stamp: date | str) -> None:
    """Append a snapshot to a log partitioned by its day.

    The rows get the day ``stamp``, and running the load twice replaces the day
    instead of doubling it.
    """
    stamped = df.withColumn(by, F.lit(dates.as_date(stamp)))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", compression: str = "gzip",
               timestamp_format: str = "yyyy-MM-dd HH:mm:ss", date_format: str = "yyyy-MM-dd", header: bool = True) -> None:
    """Delimited export with fixed formats, always in parallel parts. Spark adds the ``_SUCCESS`` marker itself.

    A receiver of one file joins the parts: gzip members may be joined end to end (write without header then).
    """
    (df.write.mode("overwrite").option("sep", sep).option("header", header).option("compression", compression)
     .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
     .option("dateFormat", date_format).option("emptyValue", "").csv(path))


def export_per_value(df: DataFrame, col: str, path: str, order: Sequence[str] = (), spread: int = 1, sep: str = ",") -> None:
    """One folder per value of ``col``, sorted inside each file; large values may use ``spread`` files."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    out = df.repartition(F.col(col), salt).sortWithinPartitions(col, *order)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True).option("sep", sep).partitionBy(col).csv(path)


def snapshot_tables(tables: Mapping[str, DataFrame], root: str, by: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Raw copies of several tables; returns their paths."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        write_snapshot(df, paths[name], (by or {}).get(name, ()))
    return paths


def replace_range(df: DataFrame, path: str, by: str, first: date | str, stage: Stage) -> None:
    """Replace all days from ``first`` on: days of the new rows are overwritten, other old days removed.

    The rows are computed once, into a staged table, before the target is touched; so they may be computed from
    the target itself. Both later steps can be repeated after a failure. Earlier days are not touched.
    ``by`` must be a date column.
    """
    if not isinstance(df.schema[by].dataType, DateType):
        raise ValueError(f"{by} must be a date column, not {df.schema[by].dataType.simpleString()}")
    first = dates.as_date(first)
    fresh = stage(df.filter(F.col(by) >= F.lit(first)), "fresh")
    keep = {str(r[0]) for r in fresh.select(by).distinct().collect()}  # one entry per calendar day
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    for name, folder in _partition_folders(df.sparkSession, path, by):
        if name != "__HIVE_DEFAULT_PARTITION__" and date.fromisoformat(name) >= first and name not in keep:
            _delete(df.sparkSession, folder)


def _partition_folders(spark: SparkSession, path: str, by: str) -> list[tuple[str, str]]:
    """(day, folder) of a day-partitioned dataset: at most one entry per calendar day."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(root):
        leaf = status.getPath().getName()
        if leaf.startswith(f"{by}="):
            out.append((leaf[len(by) + 1:], status.getPath().toString()))
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str], cols: Sequence[str], stamp_col: str | None = None,
           as_of: date | str | None = None, insert: bool = True) -> DataFrame:
    """The target after the staged rows are applied.

    Staged values win, nulls included. ``staging`` must hold one row per key
    (``latest_per_key`` makes it so). Update-only mode ignores new keys. Applying
    the same staging twice changes nothing more.
    """
    staged = staging.select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_hit"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_s_{k}"))
    out = target.join(staged, cond, "full_outer" if insert else "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changes: dict[str, Column] = {k: F.coalesce(F.col(k), F.col(f"_s_{k}")) for k in keys}
    changes |= {c: F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)) for c in cols}
    if stamp_col:
        old = F.col(stamp_col) if stamp_col in target.columns else F.lit(None).cast("date")
        changes[stamp_col] = F.when(hit, F.lit(dates.as_date(as_of))).otherwise(old)
    return out.withColumns(changes).drop("_hit", *[f"_s_{k}" for k in keys], *[f"_n_{c}" for c in cols])


def write_split(df: DataFrame, cond: Column, first: str, second: str, stage: Stage, by: Sequence[str] = (), null_to_first: bool = True) -> None:
    """One result to two folders; it is computed once, into a staged table."""
    a, b = split_by(stage(df, "split"), cond, null_to_first)
    write_snapshot(a, first, by)
    write_snapshot(b, second, by)


def backup_and_replace(df: DataFrame, path: str, backup: str, by: str, first: date | str, stage: Stage,
                       check: Callable[[DataFrame], bool] | None = None, metrics: Mapping[str, Column] | None = None,
                       expect: Callable[[dict], bool] | None = None) -> None:
    """Copy the days about to change, then replace them from ``first`` on. The new rows are computed once.

    ``metrics`` are aggregates gathered while the new rows are staged, without a scan of their own; ``expect`` is
    handed their values and says whether the load goes on. ``check`` looks at the staged rows instead. Either
    stops the load before the target is touched; ``stage`` must write.
    """
    spark = df.sparkSession
    if metrics and stage is recompute:
        raise ValueError("metrics are gathered by a stage that writes")
    seen = Observation() if metrics else None
    df = stage(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if metrics else df, "new")
    if seen is not None and expect is not None and not expect(seen.get):
        raise ValueError(f"the new rows are not as expected: {seen.get}; nothing was replaced")
    old = spark.read.parquet(path).filter(F.col(by) >= F.lit(dates.as_date(first)))
    write_snapshot(old, backup, [by])
    if check is not None and not check(df):
        raise ValueError("the new rows failed the check; nothing was replaced")
    replace_range(df, path, by, first, stage)


def export_ready(df: DataFrame, renames: Mapping[str, str] | None = None, sep: str = ",") -> DataFrame:
    """Rename and make text delimiter-safe in one step."""
    return projection.export_safe(projection.rename_columns(df, renames or {}), sep)
