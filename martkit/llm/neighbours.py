"""Approximate nearest neighbours through a hierarchical k-means tree.

The tree is fitted on a bounded sample (``FIT_ROWS`` vectors by a hash of the
id) and its size-bounded centres are broadcast; every row is then put into the
leaf it descends to. A query walks the tree best bin first: a priority queue of
nodes by centre distance. How many leaves are visited is widened until
queries of the sample reach the target recall against brute force. Leaves
are dealt out in blocks of bounded size, so that a leaf with a third of all
rows is searched by many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.frames import map_batches

FIT_ROWS = 20_000
BRANCHES = 8
LEAF_ROWS = 64  # of the sample
TARGET_RECALL = 0.98
CALIBRATION_QUERIES = 256
BLOCK_ROWS = 4096
QUERY_ROWS = 16_384  # about so many queries meet a block of stored rows at once
K = 10


class Tree:
    """Centres of the inner nodes' children; a node without children is a leaf."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 7):
        self.centres: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.n_leaves = 0
        rng = np.random.default_rng(seed)
        self._grow(sample, branches, leaf_rows, rng)

    def _grow(self, rows: np.ndarray, branches: int, leaf_rows: int, rng: np.random.Generator) -> int:
        node = len(self.centres)
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        parts = _kmeans(rows, branches, rng) if len(rows) > leaf_rows else None
        if parts is None:
            self.leaf[node], self.n_leaves = self.n_leaves, self.n_leaves + 1
        else:
            centres, owner = parts
            self.centres[node] = centres
            self.children[node] = [self._grow(rows[owner == i], branches, leaf_rows, rng) for i in range(len(centres))]
        return node

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child at every level."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            if not len(which):
                continue
            if self.leaf[node] >= 0:
                out[which] = self.leaf[node]
                continue
            near = np.argmin(squared(rows[which], self.centres[node]), axis=1)
            todo += [(child, which[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            else:
                near = squared(query[None, :], self.centres[node])[0].tolist()
                for child, distance in zip(self.children[node], near, strict=True):
                    heapq.heappush(queue, (distance, child))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0.0)


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray] | None:
    """Centres and owners; None if the rows can't be parted."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        owner = np.argmin(squared(rows, centres), axis=1)
        used = np.unique(owner)
        centres = np.stack([rows[owner == i].mean(0) for i in used])
    owner = np.argmin(squared(rows, centres), axis=1)
    used, owner = np.unique(owner, return_inverse=True)
    return (centres[used], owner) if len(used) > 1 else None


def calibrate(tree: Tree, sample: np.ndarray, k: int, target: float, queries: int) -> int:
    """Leaves to visit so that sample queries find the target share of their true neighbours in the sample."""
    if len(sample) <= k + 1 or tree.n_leaves == 1:
        return 1
    leaves, distinct = tree.assign(sample), np.unique(sample, axis=0, return_index=True)[1]
    distinct.sort()  # a vector that many rows hold is one query
    asked = distinct[np.linspace(0, len(distinct) - 1, min(queries, len(distinct))).astype(int)]
    needed = []
    for i in asked:
        distance = ((sample - sample[i]) ** 2).sum(1)
        distance[i] = np.inf
        cut = np.partition(distance, k - 1)[k - 1]
        inside = np.bincount(leaves[distance < cut], minlength=tree.n_leaves)
        ties = np.bincount(leaves[distance == cut], minlength=tree.n_leaves)  # any of these will do
        room = k - int(inside.sum())
        found, got = [], 0.0
        tied = 0
        for leaf in tree.visit(sample[i]):
            tied = min(room, tied + int(ties[leaf]))
            got += int(inside[leaf])
            found.append((got + tied) / k)
            if found[-1] >= 1:
                break
        needed.append(found)
    visits = 1
    while np.mean([f[min(visits, len(f)) - 1] for f in needed]) < target and visits < tree.n_leaves:
        visits += 1
    return visits


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and double vector of the rows that take part: no null, zero or non-finite vector, no null id."""
    values = F.col("vector")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & values.isNotNull() & (F.size(values) > 0) & whole & F.exists(values, lambda x: x != 0.0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def search(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = K, fit_rows: int = FIT_ROWS, target: float = TARGET_RECALL,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k nearest found of every row whose id is divisible by ``every``.

    Result: query_id, rank (from 1), vec_id, score (Euclidean distance in double precision), nearest
    first, ties to the smaller id. A query's own id is no candidate. Rows with null, zero or
    non-finite vectors or a null id take no part; vectors of another length than most of the sample's
    neither. Rows repeated with one id are one candidate each. No rows: no result.
    """
    spark, rows = vectors.sparkSession, usable(vectors, key, vector)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).toArrow()
    sizes = np.array([len(v) for v in sample.column("vector").to_pylist()] if sample.num_rows else [1])
    width = int(np.bincount(sizes).argmax())
    kept = sample.filter(pa.array(sizes == width)) if sample.num_rows else sample
    points = matrix(kept.column("vector").combine_chunks()) if kept.num_rows else np.zeros((1, width))
    tree = Tree(points)
    visits = calibrate(tree, points, k, target, CALIBRATION_QUERIES)
    shared = spark.sparkContext.broadcast(tree)
    rows = rows.where(F.size("vector") == width)

    def put(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaves = shared.value.assign(matrix(batch.column(1)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int64())], ["vec_id", "vector", "leaf"])

    placed = map_batches(rows, put, "vec_id long, vector array<double>, leaf long")
    counts = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # at most the leaves of the tree
    blocks = {leaf: -(-n // BLOCK_ROWS) for leaf, n in counts.items()}
    plan = spark.sparkContext.broadcast((counts, blocks))
    parts = -(-rows.where(F.col("vec_id") % every == 0).count() // query_rows) or 1

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (counts, blocks) = shared.value, plan.value
        for batch in batches:
            which, leaves, salts = [], [], []
            for i, query in enumerate(matrix(batch.column(1))):
                met = 0
                for seen, leaf in enumerate(tree.visit(query)):
                    if seen >= visits and met > k:
                        break
                    met += counts.get(leaf, 0)
                    for salt in range(blocks.get(leaf, 0)):
                        which.append(i)
                        leaves.append(leaf)
                        salts.append(salt)
            taken = batch.take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaves, pa.int64()), pa.array(salts, pa.int64())], ["query_id", "query", "leaf", "salt"])

    asked = rows.where(F.col("vec_id") % every == 0).mapInArrow(walk, "query_id long, query array<double>, leaf long, salt long")
    size = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]) if blocks else F.create_map(F.lit(0), F.lit(1))
    stored = placed.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.coalesce(size[F.col("leaf")], F.lit(1)).cast("long")))
    # Both sides of a group are bounded: stored rows by their blocks, queries by parts, to each of which a block goes.
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
    stored = stored.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    meet = ("leaf", "salt", "part")
    near = asked.groupBy(*meet).cogroup(stored.groupBy(*meet)).applyInArrow(_block(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block(k: int):
    def run(queries: pa.Table, stored: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if queries.num_rows and stored.num_rows:
            points, ids = matrix(stored.column("vector").combine_chunks()), stored.column("vec_id").to_numpy()
            asked = queries.column("query_id").to_pylist()
            for query_id, query in zip(asked, matrix(queries.column("query").combine_chunks()), strict=True):
                distance = np.sqrt(((points - query) ** 2).sum(1))
                distance[ids == query_id] = np.inf
                if len(distance) > k:
                    cut = np.partition(distance, k - 1)[k - 1]
                    near = np.flatnonzero((distance <= cut) & (distance < np.inf))
                else:
                    near = np.flatnonzero(distance < np.inf)
                near = near[np.lexsort((ids[near], distance[near]))][:k]
                out[0] += [query_id] * len(near)
                out[1] += ids[near].tolist()
                out[2] += distance[near].tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run
