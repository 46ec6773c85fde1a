"""Near-duplicate documents by b-bit MinHash.

Each distinct set of word shingles gets ``ROWS`` minima for each band, as many
bands as the limit of similarity asks for. Bands of whole minima give candidates; only the low bits of the minima are kept and packed,
and a candidate's similarity is estimated by counting equal packed cells,
corrected for cells that agree by chance. Candidates within four standard
errors of the limit are confirmed on the full sets.

Copies share one set and are one node. Pairs within a band's bucket are never
listed: first every member is tested against one centre, and confirmed
components are formed. Then members of different components are compared with
each other, in blocks of bounded size: once per bucket on the packed bits, which
joins components that may be linked to clusters, and once per cluster on the full
sets. A block gives only the links that join components, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import Workspace, blobs, map_batches, map_stream, space_words
from martkit.llm.graph import components, extended

SHINGLE, PERCENT = 3, 85
ROWS, BITS = 6, 4
MISSED = 2e-6  # most pairs at the limit that may have no common band
BLOCK = 512
WORDS_KEPT = 60_000
_CELLS = 64 // BITS
_LOW = np.uint64(sum(1 << BITS * i for i in range(_CELLS)))


def bands_for(percent: int) -> int:
    """Fewest bands with which a pair at the limit is missed no oftener than ``MISSED``."""
    return 1 if percent >= 100 else math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** ROWS))


BANDS = bands_for(PERCENT)


@cache
def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and masks of n hash functions."""
    rng = np.random.default_rng(20)
    factors = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(1, 1 << 63, n, dtype=np.uint64)


def _longs(bands: int) -> int:
    return -(-bands * ROWS // _CELLS)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


class WordHashes:
    """64-bit hashes of words, the frequent ones remembered."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


_WORDS = WordHashes()


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words has none."""
    words = _WORDS.of(space_words(text))
    if not len(words):
        return words
    n = min(size, len(words))
    run = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        run = _mix(run * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return np.unique(run)


def minima(shingles: np.ndarray, bands: int = BANDS) -> np.ndarray:
    factors, masks = _hashes(bands * ROWS)
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        part = (shingles[None, i : i + 512] ^ masks[:, None]) * factors[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.arange(len(signature) // ROWS, dtype=np.uint64)
    for column in signature.reshape(-1, ROWS).T:
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def packed(signature: np.ndarray) -> np.ndarray:
    """The low bits of the minima, side by side in 64-bit words."""
    longs = _longs(len(signature) // ROWS)
    low = np.zeros(longs * _CELLS, np.uint64)
    low[: len(signature)] = signature & np.uint64((1 << BITS) - 1)
    shifts = np.arange(_CELLS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(longs, _CELLS) << shifts, axis=1)


def estimate(a: np.ndarray, b: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """Similarity from packed bits: the share of equal cells, corrected for chance."""
    odd = a ^ b
    for shift in (1, 2)[: BITS.bit_length() - 1]:
        odd = odd | odd >> np.uint64(shift)
    unequal = np.bitwise_count(odd & _LOW).sum(axis=-1)
    chance = 1 / (1 << BITS)
    return (1 - unequal / (bands * ROWS) - chance) / (1 - chance)


def floor_estimate(percent: int = PERCENT) -> float:
    """Least estimate that is still confirmed: four standard errors below the limit."""
    chance = 1 / (1 << BITS)
    equal = chance + (1 - chance) * percent / 100
    return percent / 100 - 4 * (equal * (1 - equal) / (bands_for(percent) * ROWS)) ** 0.5 / (1 - chance)


def sign(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, key of the set (h1, h2), band keys and packed bits of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, first, second, keys, bits = [], [], [], [], []
        for text in blobs(batch.column(1)):
            shingles = shingle_set(text, size)
            counts.append(len(shingles))
            digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
            first.append(digest[0])
            second.append(digest[1])
            signature = minima(shingles, bands)
            keys.append(band_keys(signature) if len(shingles) else [])
            bits.append(packed(signature).tobytes())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip((counts, first, second, keys, bits), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_shingles", "h1", "h2", "keys", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_shingles long, h1 long, h2 long, keys array<long>, bits binary")


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size).tobytes() for t in blobs(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"node {kind}, shingles binary")


def _matrix(column: pa.Array, bands: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, _longs(bands))


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and packed bits allow the similarity."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    rows = pairs.join(a, "a").join(b, "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b", "bits_a", "bits_b")
    floor, bands = floor_estimate(percent), bands_for(percent)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = estimate(_matrix(batch.column(2), bands), _matrix(batch.column(3), bands), bands) >= floor
        return batch.select(["a", "b"]).filter(pa.array(near))

    kind = pairs.schema["a"].dataType.simpleString()
    return map_batches(rows, run, f"a {kind}, b {kind}")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share so large a part of their union."""
    both = np.sort(np.concatenate((x, y)))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        linked = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in both]
        return batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b"), run, f"a {kind}, b {kind}")


def _dealt(members: DataFrame, by: str) -> DataFrame:
    """Members of each group dealt as pairs of blocks, so that every pair of different components meets in one of them.

    ``members`` has the group, node and component. Members of the group's largest component only meet the
    others, not each other. Adds the blocks x and y, and on which side of the pair the row stands.
    """
    sizes = members.groupBy(by, "component").agg(F.count("*").alias("n_part"))
    groups = sizes.groupBy(by).agg(F.sum("n_part").alias("n_all"), F.max(F.struct("n_part", "component")).alias("top"), F.count("*").alias("n_parts")).where("n_parts > 1")
    rows = members.join(groups, by).withColumns({
        "big": F.col("component") == F.col("top.component"),
        "r": F.ceil((F.col("n_all") - F.col("top.n_part")) / F.lit(BLOCK)).cast("int"),
        "b": F.ceil(F.col("top.n_part") / F.lit(BLOCK)).cast("int"),
    })
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("big"), F.col("b")).otherwise(F.col("r"))).cast("int"))
    meets = F.expr("""
        case when big then transform(sequence(0, r - 1), i -> named_struct('x', i, 'y', r + own, 'second', true))
        else concat(transform(sequence(0, r - 1), j -> named_struct('x', least(own, j), 'y', greatest(own, j), 'second', own > j)),
                    transform(sequence(0, b - 1), j -> named_struct('x', own, 'y', r + j, 'second', false))) end""")
    rows = rows.withColumn("_meets", F.explode(meets)).select(*members.columns, "_meets.x", "_meets.y", "_meets.second")
    return rows.repartition(by, "x", "y").sortWithinPartitions(by, "x", "y")


def _linked(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links that join components within a pair of blocks: as few as join all that can be joined.

    With a column of full sets, links are confirmed on them; without, packed bits decide.
    """
    node, n, second = (group.column(c).to_numpy() for c in ("node", "n", "second"))
    label = np.unique(group.column("component").to_numpy(), return_inverse=True)[1]
    bands, floor = bands_for(percent), floor_estimate(percent)
    bits = _matrix(group.column("bits"), bands)
    sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()] if "shingles" in group.column_names else None
    whole = group.column("x")[0].as_py() == group.column("y")[0].as_py()
    out: list[tuple[int, int]] = []
    for i in range(len(node) - 1):
        rest = slice(i + 1, None)
        wanted = (label[rest] != label[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
        if not whole:
            wanted &= second[rest] != second[i]
        at = np.flatnonzero(wanted) + i + 1
        if not len(at):
            continue
        near = estimate(bits[at], bits[i], bands)
        at = at[near >= floor][np.argsort(-near[near >= floor], kind="stable")]  # the likeliest first
        while len(at):
            j, at = int(at[0]), at[1:]
            if sets is None or similar(sets[i], sets[j], percent):
                out.append((min(node[i], node[j]), max(node[i], node[j])))
                label[label == label[j]] = label[i]
                at = at[label[at] != label[i]]
    if out:
        a, b = np.array(out).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _links_across(members: DataFrame, by: str, percent: int) -> DataFrame:
    """Links between different components of each group. ``members`` has the group, node, component, n, bits and perhaps shingles."""
    kind = members.schema["node"].dataType.simpleString()
    dealt = _dealt(members, by)
    ids = [dealt.columns.index(c) for c in (by, "x", "y")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in ids]
            edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in keys], axis=0)) + 1
            bounds = [0, *edges.tolist(), batch.num_rows]
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                key = tuple(c[lo] for c in keys)
                if key != last and held:
                    yield from _linked(pa.Table.from_batches(held).combine_chunks(), percent)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = key
        if held:
            yield from _linked(pa.Table.from_batches(held).combine_chunks(), percent)

    return map_stream(dealt, run, f"a {kind}, b {kind}").distinct()


def near_copies(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept of every row.

    Null texts and texts without words have no shingles and are linked with nothing. A row without
    id is linked with nothing and has neither component nor kept (false). Rows that repeat an id are
    one document. No rows: no result.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "nearcopies")
    signed = work.put(sign(docs, size, bands_for(percent)))
    classes = work.put(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    )
    nodes = classes.select("node", "n", "bits")
    keyed = classes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n_members"), F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = work.put(keyed.join(shared, "key"))
    met = members.select(F.col("node").alias("doc_id")).distinct()
    sets = work.put(_full_sets(docs.select("doc_id", "text").join(met, "doc_id", "left_semi"), size))

    def test(pairs: DataFrame) -> DataFrame:
        return work.put(_confirmed(pairs, sets, percent))

    # Every member against one centre of each of its buckets; then against another one where components still differ.
    centre = members.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    parts = components(test(_likely(centre, nodes, percent)), work)
    placed = members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    tops = placed.where("node = high").select("key", F.col("component").alias("high_component")).distinct()
    centre = placed.where("node <> high").join(tops, "key").where("component <> high_component").select(F.col("node").alias("a"), F.col("high").alias("b")).distinct()
    parts = extended(parts, test(_likely(centre, nodes, percent)), work)
    # What is left: members of one bucket in different components. The packed bits say which components may be linked at all;
    # what they join is a cluster, and its members are brought together once, with their sets.
    placed = members.select("key", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    maybe = work.put(_links_across(placed.join(nodes, "node"), "key", percent))
    if not maybe.isEmpty():
        clusters = extended(parts, maybe, work).withColumnRenamed("component", "cluster")
        clusters = clusters.unionByName(clusters.select(F.col("cluster").alias("node"), "cluster").distinct())  # their smallest nodes too
        rest = clusters.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        parts = extended(parts, work.put(_links_across(rest.join(nodes, "node").join(sets, "node"), "cluster", percent)), work)
    named = classes.select("h1", "h2", "node").join(parts, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("component"))
    known = signed.select("doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    result = work.put(known.select("doc_id", "n_shingles", component.alias("component_id")))
    work.drop(signed, classes, members, sets, maybe)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
