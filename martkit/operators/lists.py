"""Delimited text and JSON to rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import jsontext


def explode_list(df: DataFrame, col: str, sep: str, name: str, remove: str = "", drop_values: Sequence[str] = ("",)) -> DataFrame:
    """One row per token; listed values are dropped."""
    source = F.translate(F.col(col), remove, "") if remove else F.col(col)
    out = df.withColumn(name, F.explode(F.split(source, re.escape(sep)))).withColumn(name, F.trim(name))
    return out.filter(~F.col(name).isin(list(drop_values))) if drop_values else out


def link_positions(df: DataFrame, key: str, col: str, sep: str = ",", min_len: int = 1) -> DataFrame:
    """(key, token, 1-based position). Positions past the end give no rows."""
    return (df.select(F.col(key), F.posexplode(F.split(F.col(col), re.escape(sep))).alias("_pos", "token"))
            .withColumn("token", F.trim("token")).filter(F.length("token") >= min_len)
            .select(key, "token", (F.col("_pos") + 1).alias("position")))


def zip_lists(df: DataFrame, keys: Sequence[str], cols: Sequence[str], sep: str) -> DataFrame:
    """Parallel lists side by side, one row per position; a shorter list gives nulls."""
    parts = [F.split(F.col(c), re.escape(sep)).alias(c) for c in cols]
    zipped = df.select(*keys, *parts).select(*keys, F.posexplode(F.arrays_zip(*cols)).alias("_pos", "_z"))
    return zipped.select(*keys, (F.col("_pos") + 1).alias("position"), *[F.col(f"_z.{c}").alias(c) for c in cols])


def explode_json(df: DataFrame, col: str, schema: str, array: str, scalars: Sequence[str], fields: Sequence[str],
                 keep_empty: bool = False) -> DataFrame:
    """Scalar fields plus one row per object of an array; without the array a record vanishes."""
    parsed = df.withColumn("_j", F.from_json(F.col(col), schema))
    explode = F.explode_outer if keep_empty else F.explode
    rows = parsed.withColumn("_e", explode(F.col(f"_j.{array}")))
    return rows.withColumns({**{s: F.col(f"_j.{s}") for s in scalars}, **{f: F.col(f"_e.{f}") for f in fields}}).drop("_j", "_e")


def explode_map_of_lists(df: DataFrame, key: str, col: str, group: str, item: str) -> DataFrame:
    """``{"10": ["1", "2"]}`` to rows (key, group, item); of a repeated key the last entry counts."""
    parsed = jsontext.last_entries(F.from_json(F.col(col), "map<string,array<string>>"))
    rows = df.select(F.col(key), F.explode(parsed).alias(group, "_items"))
    return rows.select(key, group, F.explode("_items").alias(item))


def explode_nested(df: DataFrame, key: str, col: str, outer: str, inner: str) -> DataFrame:
    """Objects with an inner list to rows (key, outer, inner)."""
    schema = f"array<struct<{outer}:string,{inner}:array<string>>>"
    rows = df.select(F.col(key), F.explode(F.from_json(F.col(col), schema)).alias("_o"))
    return rows.select(key, F.col(f"_o.{outer}").alias(outer), F.explode(F.col(f"_o.{inner}")).alias(inner))


def explode_tiers(df: DataFrame, key: str, col: str, labels: tuple[str, str, str] = ("full point", "full cash", "point + cash")) -> DataFrame:
    """Point-or-cash tiers as rows with a label for how each is paid."""
    schema = "array<struct<tier:int,amount:string,bonus_point:string>>"
    rows = df.select(F.col(key), F.explode(F.from_json(F.col(col), schema)).alias("_t"))
    number = lambda c: F.translate(F.col(c), ",", "").try_cast("double")
    out = rows.select(key, F.col("_t.tier").alias("tier"), number("_t.amount").alias("amount"), number("_t.bonus_point").alias("bonus_point"))
    free, pointless = F.floor("amount") == 0, F.floor("bonus_point") == 0
    label = F.when(free & ~pointless, labels[0]).when(~free & pointless, labels[1]).when(~free & ~pointless, labels[2]).otherwise("")
    return out.withColumn("tier_type", label)


def explode_objects(df: DataFrame, keys: Sequence[str], col: str, fields: Sequence[str]) -> DataFrame:
    """Every field of every object of a JSON array: (keys, 1-based position, field, value). Bad JSON gives no rows."""
    schema = "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>"
    rows = df.select(*keys, F.posexplode(F.from_json(F.col(col), schema)).alias("_pos", "_o"))
    entry = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_o.{f}").alias("value")) for f in fields])).alias("_f")
    return rows.select(*keys, (F.col("_pos") + 1).alias("position"), entry).select(*keys, "position", "_f.field", "_f.value")


def object_fields(df: DataFrame, *cols: Column) -> list[str]:
    """Names of all fields in JSON arrays of objects, sorted; an action whose result is a schema, not rows."""
    objects = F.flatten(F.array(*[F.coalesce(F.from_json(c, "array<map<string,string>>"), F.array().cast("array<map<string,string>>")) for c in cols]))
    keys = df.select(F.explode(objects).alias("o")).select(F.explode(F.map_keys("o")).alias("k")).distinct()
    return sorted(r["k"] for r in keys.collect())


def longest_array(df: DataFrame, *cols: str | Column) -> int:
    """Most items that any JSON array in these columns has (0 if there is none); an action."""
    sizes = [F.max(F.coalesce(F.json_array_length(c), F.lit(0))) for c in cols]
    return df.agg(F.greatest(*sizes, F.lit(0), F.lit(0))).first()[0] or 0


def infer_json_schema(df: DataFrame, col: str) -> str:
    """Schema text of a JSON column over all its rows, in one aggregation; an action, meant for exploring.

    Malformed texts are skipped; fields of conflicting types are strings. Jobs pin the text this prints:
    a schema inferred at run time changes with the data.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col)))).first()[0]
    typed = re.sub(r"(?<=: )(VOID|VARIANT)\b|(?<=ARRAY<)(VOID|VARIANT)\b", "STRING", found).replace("OBJECT<", "STRUCT<")
    return typed.lower() if typed in ("VOID", "VARIANT") else typed
