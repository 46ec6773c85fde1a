"""Expressions over JSON text. Schemas are declared, not inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def json_path(col: Column, path: str) -> Column:
    """A scalar by path; malformed text gives null."""
    return F.get_json_object(col, path)


def last_entries(parsed: Column) -> Column:
    """A map from JSON with the last entry of each repeated key."""
    entries = F.map_entries(parsed)
    later = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: ~later(e, i)))


def drop_json_keys(col: Column, keys: Sequence[str]) -> Column:
    """Remove top-level keys; text that is no JSON object gives null, and of a repeated key the last entry stays."""
    parsed = last_entries(F.from_json(col, "map<string,string>"))
    return F.to_json(F.map_filter(parsed, lambda k, v: ~k.isin(list(keys))))


def route_json_keys(col: Column, paths: Mapping[str, str], prefixes: Mapping[str, str] | None = None) -> dict[str, Column]:
    """One column per name and path. A prefix keeps only values that start with it and removes it."""
    out: dict[str, Column] = {}
    for name, path in paths.items():
        value = F.get_json_object(col, path)
        prefix = (prefixes or {}).get(name)
        if prefix:
            value = F.when(F.startswith(value, F.lit(prefix)), F.substring(value, F.lit(len(prefix) + 1), F.length(value)))
        out[name] = value
    return out


def tracking_label(col: Column, patterns: Sequence[tuple[str, str, str]], default: str = "OTHERS") -> Column:
    """First pattern contained in the text chooses the path; a prefix is cut from the value."""
    out = None
    for needle, path, prefix in patterns:
        value = F.get_json_object(col, path)
        if prefix:
            value = F.replace(value, F.lit(prefix), F.lit(""))
        test = F.contains(col, F.lit(needle))
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.coalesce(out.otherwise(F.lit(default)), F.lit(default))


def wide_json(col: Column, fields: Sequence[str], n: int) -> dict[str, Column]:
    """``field_1 .. field_n`` from an array of objects; bad JSON gives nulls.

    ``n`` should be the longest array's size (``lists.longest_array``); ``lists.explode_objects`` is the form without it.
    """
    parsed = F.from_json(col, "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>")
    return {f"{f}_{i + 1}": F.get(parsed, F.lit(i))[f] for i in range(n) for f in fields}


def widest(cols: Sequence[Column], fields: Sequence[str], n: int) -> dict[str, Column]:
    """``field_1 .. field_n`` from several arrays of objects; where two arrays give a place, the later one counts."""
    parsed = [F.from_json(c, "array<map<string,string>>") for c in cols]
    return {f"{f}_{i + 1}": F.coalesce(*[F.element_at(F.get(p, F.lit(i)), F.lit(f)) for p in reversed(parsed)]) for f in fields for i in range(n)}


def last_of(col: Column, fields: Sequence[str]) -> dict[str, Column]:
    """Each field's value in the last object of an array that has it."""
    parsed = F.from_json(col, "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>")

    def last(field: str) -> Column:
        given = F.filter(F.transform(parsed, lambda o: o[field]), lambda v: v.isNotNull())
        return F.try_element_at(given, F.lit(-1))

    return {f: last(f) for f in fields}
