"""Semi and anti joins and upserts that shuffle only the rows that may be hit.

The keys of the small side are hashed into the bits of a Bloom filter: one array of 64-bit words, built by
OR-ing bits in an aggregation and handed to every task as the value of a scalar subquery. A row of the large
side with an unset bit has no match for certain and passes straight through; only the rest meets the keys in
a join, which decides exactly. The filter is sized by the number of keys and has a stated limit; beyond it the
plain join is planned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martkit.operators.joins import anti, semi

BITS_PER_KEY = 16
PROBES = 4
MAX_KEYS = 2_000_000  # the filter then has 4 MB


def _places(keys: Sequence[Column], bits: int) -> list[Column]:
    """The filter's bits of a key: multiples of one hash added to another."""
    first, second = F.xxhash64(*keys), F.xxhash64(*keys, F.lit(1)).bitwiseOR(F.lit(1))
    return [F.pmod(F.shiftright(first, 8) + F.shiftright(second, 8) * F.lit(i), F.lit(bits)) for i in range(PROBES)]


def key_filter(keys: DataFrame, bits: int) -> DataFrame:
    """One row with the ``words`` of the filter over all rows of ``keys``; rows with a null key match nothing and are left out."""
    known = keys.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys.columns]))
    at = known.select(F.explode(F.array(*_places([F.col(c) for c in keys.columns], bits))).alias("_at"))
    words = at.groupBy(F.expr("_at div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 as int))")).alias("_bits"))
    slots = keys.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("_word"), "left")
    row = F.struct("id", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))
    return slots.agg(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["_bits"]).alias("words"))  # bits / 64 longs, bounded by MAX_KEYS


def split_by_filter(df: DataFrame, keys: DataFrame, on: Mapping[str, str], max_keys: int = MAX_KEYS) -> tuple[DataFrame, DataFrame | None]:
    """(rows that may match, rows that surely don't). With more keys than the limit all rows may match.

    The number of keys is estimated by a sketch in a pass over their columns; they are cast to the types of ``df``.
    """
    side = keys.select(*[F.col(k).cast(df.schema[v].dataType).alias(k) for k, v in on.items()])
    n = side.agg(F.approx_count_distinct(F.struct(*on))).first()[0]
    if n > max_keys:
        return df, None
    bits = 1 << max(10, (BITS_PER_KEY * n).bit_length())
    words = "_words"
    while words in df.columns:
        words += "_"
    df = df.withColumn(words, key_filter(side, bits).scalar())
    tests = [F.element_at(words, (F.expr("1") + F.shiftright(p, 6)).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0
             for p in _places([F.col(v) for v in on.values()], bits)]
    known = [F.col(v).isNotNull() for v in on.values()]
    hit = reduce(lambda a, b: a & b, known + tests)
    return df.filter(hit).drop(words), df.filter(~hit).drop(words)


def anti_reduced(df: DataFrame, other: DataFrame, on: Mapping[str, str], max_keys: int = MAX_KEYS) -> DataFrame:
    """Rows of a large ``df`` without a match in a small ``other``; rows with a null key are kept.

    ``on`` maps columns of ``other`` to columns of ``df``. The same rows as ``anti``, in any
    order: rows that cannot match are read in a branch of their own, without a shuffle.
    """
    maybe, never = split_by_filter(df, other, on, max_keys)
    rest = anti(maybe, other, on)
    return rest if never is None else never.unionByName(rest)


def semi_reduced(df: DataFrame, other: DataFrame, on: Mapping[str, str], max_keys: int = MAX_KEYS) -> DataFrame:
    """Rows of a large ``df`` with a match in a small ``other``, as ``semi``: rows that cannot match are not shuffled."""
    return semi(split_by_filter(df, other, on, max_keys)[0], other, on)


def replace_keys(history: DataFrame, delta: DataFrame, key: Sequence[str], max_keys: int = MAX_KEYS) -> DataFrame:
    """History rows whose key the delta does not hold, and all rows of the delta.

    Only history rows that may be replaced are shuffled: the rest of a long history passes straight through.
    """
    return anti_reduced(history, delta, {k: k for k in key}, max_keys).unionByName(delta)
