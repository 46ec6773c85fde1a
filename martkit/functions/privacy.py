"""Pseudonyms. Salts and policies are arguments, never literals in the code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_LENGTH = 64


def hash_when(col: Column, cond: Column) -> Column:
    """SHA-256 of the upper-case value where ``cond`` holds; a value that already is a hash stays."""
    todo = cond & col.isNotNull() & (F.length(col) != HASH_LENGTH)
    return F.when(todo, F.sha2(F.upper(col), 256)).otherwise(col)


def hash_salted(col: Column, salt: str) -> Column:
    """SHA-256 of the lower-case value followed by a secret salt."""
    return F.sha2(F.concat(F.lower(col), F.lit(salt)), 256)
