"""Equi-joins and their variants.

No operator here forces a broadcast: Spark compares the size estimate with
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans with the real size.
AQE splits a skewed partition of a single sort-merge join only, not of chains on one key or of joins
below an aggregation on it. So rows that cannot match, with a null key or a listed filler, are
dealt out by a hash of the few columns named in ``spread_by`` (by default the first column, which is
the row's own id in facts, and the key columns, which the join reads anyway). Hot keys that do match are
salted: with a number of copies the caller names (``salt``), or found by a sketch of the key (``hot_keys``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.functions import text

ROWS_A_TASK = 250_000  # whole rows that a task sorts at once, some hundred MB of them


def all_of(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def code_table(df: DataFrame, mapping: Mapping, key: str, value: str) -> DataFrame:
    """An inline code list as a relation on ``df``'s session, held in the plan itself."""
    rows = [F.struct(F.lit(k).alias(key), F.lit(v).alias(value)) for k, v in mapping.items()]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _spread(df: DataFrame, keys: Sequence[str | Column], spread_by: Sequence[str] | None) -> Column:
    """A 64-bit hash, never 0, that deals rows out. It reads ``spread_by``, or the first column and the plain key columns."""
    if spread_by is None:
        plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
        spread_by = list(dict.fromkeys(plain[:1] + [k for k in keys if isinstance(k, str)]))
    return F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]).bitwiseOR(F.lit(1))


def _place(keys: Sequence[Column], fillers: Sequence, spread: Column) -> Column:
    """0 for rows whose keys may match, else the hash."""
    hopeless = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    for k in keys if fillers else []:
        hopeless = hopeless | F.coalesce(k.isin(list(fillers)), F.lit(False))
    return F.when(hopeless, spread).otherwise(F.lit(0).cast("long"))


def _at_zero(*keys: str) -> Column:
    """Always 0, but a column of the row: a constant would be taken out of the join's key."""
    return F.pmod(F.xxhash64(*keys), F.lit(1).cast("long"))


def enrich(df: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str | Column], Mapping[str, str]]],
           fillers: Mapping[str, Sequence] | None = None, spread_by: Sequence[str] | None = None, own_id: str | None = None) -> DataFrame:
    """Left-join a chain of dimensions.

    Each entry is ``(dim, {dim key: fact column or expression}, {dim column: output name})``.
    A dimension must be unique on its key, otherwise facts fan out as in SQL. ``fillers`` names values of fact
    columns that stand for "none" and are in no dimension; like null keys they don't meet in one task.
    ``own_id`` is the facts' own id or a key they were joined on before: it is never a filler, so joins on it alone need no
    place, and all of them and a later ``distinct`` share one shuffle.
    """
    given = [v for _, keys, _ in dims for v in keys.values() if isinstance(v, str) and v in df.columns]
    spread, hashed = F.col("_spread"), _spread(df, given, spread_by)  # once for the whole chain
    df = df.withColumn("_spread", hashed)
    places: dict[tuple, str] = {}
    for i, (dim, keys, columns) in enumerate(dims):
        facts = [F.col(v) if isinstance(v, str) else v for v in keys.values()]
        side = dim.select([F.col(k).alias(f"_k{i}_{k}") for k in keys] + [F.col(c).alias(n) for c, n in columns.items()])
        if own_id is not None and list(keys.values()) == [own_id]:
            df = df.join(side, F.col(own_id) == F.col(f"_k{i}_{next(iter(keys))}"), "left").drop(f"_k{i}_{next(iter(keys))}")
            continue
        side = side.withColumn(f"_k{i}_at", _at_zero(*[f"_k{i}_{k}" for k in keys]))
        named = tuple(v if isinstance(v, str) else i for v in keys.values())
        if named not in places:  # joins on one key share the column and so the shuffle
            places[named] = f"_at{i}"
            listed = [x for v in keys.values() if isinstance(v, str) for x in (fillers or {}).get(v, ())]
            df = df.withColumn(f"_at{i}", _place(facts, listed, spread))
        conds = [fact == F.col(f"_k{i}_{k}") for k, fact in zip(keys, facts, strict=True)] + [F.col(places[named]) == F.col(f"_k{i}_at")]
        df = df.join(side, all_of(conds), "left").drop(*[f"_k{i}_{k}" for k in keys], f"_k{i}_at")
    return df.drop(*places.values(), "_spread")


def _led_to(df: DataFrame, key: str, rows: int | None) -> DataFrame:
    """Whole rows shuffled to ``key``: over the session's shuffle partitions, or over more if ``rows`` of them ask for it."""
    tasks = -(-(rows or 0) // ROWS_A_TASK)
    few = tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(key) if few else df.repartition(tasks, key)


def enrich_at(df: DataFrame, at: str, dims: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]], rows: int | None = None) -> DataFrame:
    """Left-join dimensions, each unique on its key, while whole rows are shuffled once, to ``at``, and lie there afterwards.

    Only the distinct pairs of ``at`` and a key travel to a dimension, and what they find goes to ``at`` beside the rows, to
    be read in a window of ``at`` and the key: for joins on more columns than rows lie by, Spark would shuffle
    them again. Rows without ``at`` or a key find nothing. Entries are as in ``enrich``, with plain fact columns as keys.
    ``rows`` says about how many rows ``df`` has: the rows of a task are sorted for each window, so a task gets no more than
    fit into its memory, and nothing is spilled.
    """
    parts, reads = [df.withColumn("_own", F.lit(True))], []
    for i, (dim, keys, columns) in enumerate(dims):
        on = list(dict.fromkeys([at, *keys.values()]))
        pairs = df.select(*on).filter(all_of([F.col(c).isNotNull() for c in on])).repartition(*keys.values()).distinct()
        side = dim.select(*[F.col(k).alias(f"_d_{v}") for k, v in keys.items()], F.struct(*[F.col(c).alias(n) for c, n in columns.items()]).alias(f"_found{i}"))
        found = pairs.join(side, all_of([F.col(v) == F.col(f"_d_{v}") for v in keys.values()]))
        parts.append(found.select(*on, f"_found{i}", F.lit(False).alias("_own")))
        reads.append((f"_found{i}", on))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    out = _led_to(out, at, rows)
    for name, on in reads:
        out = out.withColumn(name, F.max(name).over(Window.partitionBy(*on)))
    return out.filter("_own").select(*df.columns, *[F.col(f"_found{i}.{n}").alias(n) for i, (_, _, columns) in enumerate(dims) for n in columns.values()])


def hot_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Hashes of the keys that hold more rows than a fair task: ``_hot`` and the number of salts each needs.

    One pass with a frequent-items sketch of the key's hash, merged from all map tasks; no row is shuffled. It
    tracks enough items that none above half a task's share is missed. At most ``2 * tasks`` rows, so the
    result may be broadcast. ``tasks`` is the session's number of shuffle partitions unless named.
    """
    tasks = min(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 60_000)  # the sketch tracks a million items at most
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    tracked = max(64, 16 * tasks)
    sketch = df.filter(known).select(F.xxhash64(*keys).alias("_h")).agg(
        F.count("*").alias("_n"), F.expr(f"approx_top_k(_h, {2 * tasks}, {tracked})").alias("_top"))
    share = F.col("_n") / F.lit(2 * tasks)  # half of what a task holds if rows are dealt evenly
    found = sketch.select("_n", F.explode("_top").alias("_item")).filter(F.col("_item.count") > share)
    rows = found.select(F.col("_item.item").alias("_hot"), F.ceil(F.col("_item.count") / share).cast("long").alias("_salts")).collect()
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], "_hot long, _salts long")


def _salted(df: DataFrame, side: DataFrame, keys: Mapping[str, str], spread_by: Sequence[str] | None, prefix: str,
            hot: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Facts with their place in ``_at``, and the keyed side with as many copies of a hot key as it has salts."""
    hot = F.broadcast(hot_keys(df, list(keys.values())) if hot is None else hot)  # bounded by the number of tasks
    df = df.withColumn("_at", _spread(df, list(keys.values()), spread_by)).withColumn("_h", F.xxhash64(*keys.values()))
    hopeless = reduce(lambda a, b: a | b, [F.col(v).isNull() for v in keys.values()])
    place = F.when(hopeless, F.col("_at")).when(F.col("_salts").isNotNull(), -F.pmod(F.col("_at"), F.col("_salts"))).otherwise(F.lit(0).cast("long"))
    df = df.join(hot, F.col("_h") == F.col("_hot"), "left").withColumn("_at", place).drop("_h", "_hot", "_salts")
    side = side.withColumn("_h", F.xxhash64(*[f"{prefix}{k}" for k in keys])).join(hot, F.col("_h") == F.col("_hot"), "left")
    copies = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts"), F.lit(1)) - 1), lambda i: -i)
    return df, side.withColumn(f"{prefix}at", F.explode(copies)).drop("_h", "_hot", "_salts")


def enrich_hot(df: DataFrame, dim: DataFrame, keys: Mapping[str, str], columns: Mapping[str, str],
               spread_by: Sequence[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``enrich`` with one dimension for facts whose keys may be hot: no value and no number of salts is named.

    Keys that ``hot_keys`` finds are salted by their size and only their dimension rows are copied; all
    others join as they are, and rows with a null key are dealt out. The sketch is a pass of its
    own over the key columns; a caller that has one hands it over in ``hot``.
    """
    side = dim.select([F.col(k).alias(f"_k_{k}") for k in keys] + [F.col(c).alias(n) for c, n in columns.items()])
    df, side = _salted(df, side, keys, spread_by, "_k_", hot)
    conds = [F.col(v) == F.col(f"_k_{k}") for k, v in keys.items()] + [F.col("_at") == F.col("_k_at")]
    return df.join(side, all_of(conds), "left").drop(*[f"_k_{k}" for k in keys], "_k_at", "_at")


def flag_exists_hot(df: DataFrame, keys_df: DataFrame, on: Mapping[str, str], name: str,
                    spread_by: Sequence[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``flag_exists`` for facts whose keys may be hot, found as in ``enrich_hot``."""
    side = keys_df.select([F.col(k).alias(f"_e_{k}") for k in on]).distinct().withColumn("_hit", F.lit(1))
    df, side = _salted(df, side, on, spread_by, "_e_", hot)
    out = df.join(side, all_of([F.col(v) == F.col(f"_e_{k}") for k, v in on.items()] + [F.col("_at") == F.col("_e_at")]), "left")
    return out.withColumn(name, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit", "_at", "_e_at", *[f"_e_{k}" for k in on])


def enrich_salted(df: DataFrame, dim: DataFrame, keys: Mapping[str, str], columns: Mapping[str, str], salt: int,
                  spread_by: Sequence[str] | None = None) -> DataFrame:
    """``enrich`` with one dimension for facts with hot keys that match: the dimension is copied ``salt`` times."""
    side = dim.select([F.col(k).alias(f"_k_{k}") for k in keys] + [F.col(c).alias(n) for c, n in columns.items()])
    side = side.withColumn("_k_at", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    df = df.withColumn("_at", F.pmod(_spread(df, list(keys.values()), spread_by), F.lit(salt)).cast("int"))
    conds = [F.col(v) == F.col(f"_k_{k}") for k, v in keys.items()] + [F.col("_at") == F.col("_k_at")]
    return df.join(side, all_of(conds), "left").drop(*[f"_k_{k}" for k in keys], "_k_at", "_at")


def enrich_roles(df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """One dimension in several roles: ``roles`` maps an output prefix to the fact's key column."""
    return enrich(df, [(dim, {key: fact}, {c: f"{role}_{c}" for c in columns}) for role, fact in roles.items()])


def enrich_gated(df: DataFrame, dim: DataFrame, keys: Mapping[str, str], when: Column, columns: Mapping[str, str],
                 spread_by: Sequence[str] | None = None) -> DataFrame:
    """Left join whose extra one-sided condition belongs to the match, not to a filter."""
    side = dim.select([F.col(k).alias(f"_g_{k}") for k in keys] + [F.col(c).alias(n) for c, n in columns.items()])
    side = side.withColumn("_g_at", _at_zero(*[f"_g_{k}" for k in keys]))
    df = df.withColumn("_at", _place([F.col(v) for v in keys.values()], (), _spread(df, list(keys.values()), spread_by)))
    conds = [F.col(v) == F.col(f"_g_{k}") for k, v in keys.items()] + [F.col("_at") == F.col("_g_at"), when]
    return df.join(side, all_of(conds), "left").drop(*[f"_g_{k}" for k in keys], "_g_at", "_at")


def decode_join(df: DataFrame, codes: DataFrame, col: str, key: str, value: str, name: str) -> DataFrame:
    """Label by a code table; unknown codes give null."""
    return enrich(df, [(codes, {key: col}, {value: name})])


def flag_exists(df: DataFrame, keys_df: DataFrame, on: Mapping[str, str], name: str, fillers: Sequence = (), salt: int = 1,
                spread_by: Sequence[str] | None = None, own_id: str | None = None) -> DataFrame:
    """0/1 flag for a match. The keys are made distinct first, so nothing fans out.

    Rows with a null key or a value in ``fillers`` match nothing and are dealt over all tasks. With ``salt`` the
    distinct keys are copied so many times, and the rows of a hot key that does match are spread as well. ``own_id`` is as in ``enrich``.
    """
    if own_id is not None and list(on.values()) == [own_id]:
        found = keys_df.select(next(iter(on))).distinct().withColumn("_hit", F.lit(1))
        out = enrich(df, [(found, dict(on), {"_hit": name})], own_id=own_id)
        return out.withColumn(name, F.coalesce(F.col(name), F.lit(0)))
    side = keys_df.select([F.col(k).alias(f"_e_{k}") for k in on]).distinct().withColumn("_hit", F.lit(1))
    if fillers:
        side = side.filter(~reduce(lambda a, b: a | b, [F.col(f"_e_{k}").isin(list(fillers)) for k in on]))
    out = df.withColumn("_spread", _spread(df, list(on.values()), spread_by))
    place = _place([F.col(v) for v in on.values()], fillers, F.col("_spread"))
    if salt > 1:  # salts are 0 and below, places of rows that cannot match are hashes
        out = out.withColumn("_at", F.when(place == 0, -F.pmod(F.col("_spread"), F.lit(salt))).otherwise(place))
        side = side.withColumn("_e_at", F.explode(F.sequence(F.lit(1 - salt).cast("long"), F.lit(0).cast("long"))))
    else:
        out = out.withColumn("_at", place)
        side = side.withColumn("_e_at", _at_zero(*[f"_e_{k}" for k in on]))
    out = out.drop("_spread")
    out = out.join(side, all_of([F.col(v) == F.col(f"_e_{k}") for k, v in on.items()] + [F.col("_at") == F.col("_e_at")]), "left")
    return out.withColumn(name, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit", "_at", "_e_at", *[f"_e_{k}" for k in on])


def semi(df: DataFrame, other: DataFrame, on: Mapping[str, str | Column]) -> DataFrame:
    """Rows with a match; ``on`` maps columns of ``other`` to columns of ``df``."""
    return _existence(df, other, on, "left_semi")


def anti(df: DataFrame, other: DataFrame, on: Mapping[str, str | Column]) -> DataFrame:
    """Rows without a match; rows with a null key are kept."""
    return _existence(df, other, on, "left_anti")


def _existence(df: DataFrame, other: DataFrame, on: Mapping[str, str | Column], how: str) -> DataFrame:
    side = other.select([F.col(k).alias(f"_s_{k}") for k in on])
    conds = [(F.col(v) if isinstance(v, str) else v) == F.col(f"_s_{k}") for k, v in on.items()]
    return df.join(side, all_of(conds), how)


def anti_null_aware(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """``NOT IN`` semantics on one column or on a concatenated key.

    A null key on the right empties the result, and a null key on the left is
    dropped unless the right is empty. Spark would broadcast the right side
    whatever its size; here it is a plain anti join plus two one-row
    existence subqueries, so the right side may be large.
    """
    key = F.lit(True)
    for k in on:
        key = key & F.col(k).isNotNull()
    has_null = other.filter(~key).exists()
    has_any = other.exists()
    left_known = all_of([F.col(v).isNotNull() for v in on.values()])
    return anti(df.filter(~has_null & (left_known | ~has_any)), other, on)


def join_folded(df: DataFrame, dim: DataFrame, left: str, right: str, columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """Equi-join on keys that ignore case and blanks."""
    side = dim.select(text.fold_key(F.col(right)).alias("_fold"), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(side, text.fold_key(F.col(left)) == F.col("_fold"), how).drop("_fold")


def flatten_hierarchy(df: DataFrame, key: str, parent: str, name: str) -> DataFrame:
    """(key, top name) of a two-level tree.

    Tops have no parent or themselves as parent. A child of a parentless top gets
    its name; an orphan gets null; a child whose parent has any parent is left out.
    """
    top = F.col(parent).isNull() | (F.col(parent) == F.col(key))
    tops = df.filter(top).select(F.col(key), F.col(name).alias("top_name"))
    parents = df.select(F.col(key).alias("_p"), F.col(parent).alias("_pp"), F.col(name).alias("top_name"))
    children = (
        df.filter(~top).select(F.col(key), F.col(parent))
        .join(parents, F.col(parent) == F.col("_p"), "left")
        .filter(F.col("_pp").isNull())
        .select(key, "top_name")
    )
    return tops.unionByName(children)


def pivot_codes(df: DataFrame, keys: Sequence[str], code: str, value: str, codes: Sequence) -> DataFrame:
    """One column per listed code in a single aggregation (the smallest value if a code repeats)."""
    return df.filter(F.col(code).isin(list(codes))).groupBy(*keys).agg(*[
        F.min(F.when(F.col(code) == F.lit(c), F.col(value))).alias(f"{value}_{c}") for c in codes
    ])


def reconcile(left: DataFrame, right: DataFrame, on: Sequence[str], period: str, left_values: Sequence[str],
              right_values: Sequence[str]) -> DataFrame:
    """Left rows with their match, plus unmatched right rows of periods the left knows.

    Both sides are expected at the grain of ``on`` (aggregate first), so no key is hot.
    ``matched`` is ``both``, ``left`` or ``right``.
    """
    known = left.select(F.col(period)).distinct()
    rhs = right.join(known, period, "left_semi")
    lhs = left.select(*on, *left_values, F.lit(1).alias("_l"))
    rhs = rhs.select(*on, *right_values, F.lit(1).alias("_r"))
    out = lhs.join(rhs, list(on), "full_outer")
    state = F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both")
    return out.withColumn("matched", state).drop("_l", "_r")


def gate_by_start(df: DataFrame, starts: DataFrame, key: str, start: str, on: str, period: str) -> DataFrame:
    """Keep rows of keys without a start period, or whose period is later than it."""
    side = starts.select(F.col(key).alias("_gk"), F.col(start).alias("_gs"))
    return df.join(side, F.col(on) == F.col("_gk"), "left").filter(
        F.col("_gk").isNull() | (F.col(period) > F.col("_gs"))).drop("_gk", "_gs")


def expand_rules(conditions: DataFrame, key: str, children: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Every combination of a rule's child lists; an empty list leaves null, meaning "any"."""
    for child, columns in children:
        conditions = conditions.join(child.select(key, *columns), key, "left")
    return conditions


def widen_conditions(df: DataFrame, key: str, kind: str, payload: str, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """Typed JSON conditions to one wide row per key, in one aggregation.

    ``fields`` maps each kind to the JSON fields wanted from it.
    """
    out = []
    for k, names in fields.items():
        for name in names:
            value = F.get_json_object(F.col(payload), f"$.{name}")
            out.append(F.max(F.when(F.col(kind) == F.lit(k), value)).alias(f"{k}_{name}"))
    return df.groupBy(key).agg(*out)
