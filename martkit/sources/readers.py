"""Scans. Schemas are declared; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(name)
    return spark.table(name)


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, sep: str = ",",
                   header: bool = True, timestamp_format: str | None = None) -> DataFrame:
    """Delimited text, plain or gzip; several paths are one scan."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """JSON lines by path or glob, for instance with a date in the file name."""
    return spark.read.schema(schema).json(list(paths) if not isinstance(paths, str) else paths)


def read_union(control: DataFrame, kind_col: str, kind: str, name_col: str, load: Callable[[list[str]], DataFrame],
               distinct: bool = True) -> DataFrame:
    """Union of the tables a control table lists for one kind.

    The names are metadata that the plan needs, so they are collected; ``load`` gets all of them and makes
    one scan over many paths. Duplicates are removed once.
    """
    names = sorted(r[0] for r in control.filter(F.col(kind_col) == kind).select(name_col).distinct().collect())
    if not names:
        raise ValueError(f"no tables of kind {kind!r}")
    out = load(names)
    return out.distinct() if distinct else out


def hash_predicates(key: str, n: int, dialect: str = "mysql") -> list[str]:
    """``n`` disjoint and complete predicates over a hash of the key, nulls in the first."""
    hashed = {"mysql": f"MOD(CRC32({key}), {n})", "postgresql": f"MOD(ABS(HASHTEXT({key}::text)::bigint), {n})"}[dialect]
    return [f"{hashed} = {i}" + (f" OR {key} IS NULL" if i == 0 else "") for i in range(n)]


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, key: str, n: int, *, dialect: str = "mysql",
                          properties: Mapping[str, str] | None = None) -> DataFrame:
    """Parallel scan: one task per hash class of the key."""
    return spark.read.jdbc(url, table, predicates=hash_predicates(key, n, dialect), properties=dict(properties or {}))


def jdbc_range_options(url: str, table: str, column: str, low: int, high: int, n: int) -> dict[str, str]:
    """Options of a scan split by ranges of a numeric key."""
    return {"url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(n)}


def jdbc_query_options(url: str, query: str, fetch: int = 10_000) -> dict[str, str]:
    """Options of a scan that leaves a whole query to the database."""
    return {"url": url, "query": query, "fetchsize": str(fetch)}


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_query_options(url, query), **dict(properties or {})).load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def changed_since_query(table: str, columns: Sequence[str], updated: str, created: str, day: str) -> str:
    """Query text for the rows changed on one day, run by the source database."""
    return (f"SELECT {', '.join(columns)} FROM {table} WHERE (DATE({updated}) = DATE '{day}') OR (DATE({created}) = DATE '{day}')")
