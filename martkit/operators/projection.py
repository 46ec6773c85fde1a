"""Projections to a target shape."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from martkit.functions import text


def conform(df: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Select, rename and cast to ``schema``. ``renames`` maps target to source names."""
    renames = renames or {}
    return df.select([F.col(renames.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def rename_columns(df: DataFrame, names: Mapping[str, str] | Callable[[str], str]) -> DataFrame:
    """Rename by a mapping, or every column by a function such as ``text.underscore_name``."""
    if callable(names):
        return df.toDF(*[names(c) for c in df.columns])
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def pad_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order; those the frame lacks become typed nulls."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def cast_columns(df: DataFrame, types: Mapping[str, str], formats: Mapping[str, str] | None = None) -> DataFrame:
    """Cast text exports. Values that do not parse become null instead of failing the job."""
    formats = formats or {}
    out: dict[str, Column] = {}
    for name, type_ in types.items():
        col = F.col(name)
        if name in formats:
            parsed = F.try_to_timestamp(F.nullif(col, F.lit("")), F.lit(formats[name]))
            out[name] = parsed.cast("timestamp_ntz" if type_ == "timestamp" else type_)
        else:
            out[name] = col.try_cast(type_)
    return df.withColumns(out)


def clean_columns(df: DataFrame, names: Sequence[str], default=None, sentinels: Sequence[str] = text.SENTINELS) -> DataFrame:
    return df.withColumns({n: text.clean_sentinels(F.col(n), sentinels, default) for n in names})


def mask_columns(df: DataFrame, cond: Column, names: Sequence[str], replacement=None) -> DataFrame:
    """Blank out several attributes where the condition holds."""
    return df.withColumns({n: F.when(cond, F.lit(replacement)).otherwise(F.col(n)) for n in names})


def fill_empty(df: DataFrame, names: Sequence[str] | None = None, value: str = "") -> DataFrame:
    return df.na.fill(value, subset=list(names) if names else None)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def export_safe(df: DataFrame, sep: str = ",") -> DataFrame:
    """Make every text column safe for an unquoted delimited file."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({n: text.export_safe(F.col(n), sep) for n in names})
