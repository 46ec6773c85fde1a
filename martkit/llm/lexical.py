"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through an integer normaliser m. Documents of equal m
are a stratum; in it the postings of a term are grouped by the term's frequency tf, and the impact
of a posting depends on tf alone, so it is computed once for each tf of a stratum. The largest tf
of each term bounds the scores of a whole stratum. A search first orders strata by these
bounds and scores the best few of each query, which gives a floor for its k-th score; then it
visits all strata, skips a query where the bound is below its floor, and raises floors as it goes.

Strata are cut into blocks of bounded size, so one that holds a third of all documents is many
blocks in many tasks. The index holds the terms of the query set; queries are taken in portions of
bounded size, which are what is broadcast. Nothing else grows on the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from martkit.llm.frames import ALNUM, Workspace, blobs, map_batches

K = 20
SHORTEN, SLOPE, UNIT, SATURATION = 75, 25, 1_000_000_000, 12  # m = SHORTEN + SLOPE * n / mean n; impact = UNIT * tf div (1000 * tf + SATURATION * m)
QUERY_TERMS = 200_000  # distinct terms of queries, summed over queries, that are searched for at once
BLOCK_DOCS, BLOCK_POSTINGS = 2048, 500_000
TASK_POSTINGS = 4_000_000
SEEDS = 4  # blocks of a query that are scored for its first floor
PORTION = 1 << 20  # bytes of a text that are cut into words at once
_INDEX = "block long, m long, docs array<long>, heads array<int>, peaks array<int>, terms array<int>, tfs array<int>, starts array<int>, places array<int>"
_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 6]
_NAMES = ["block", "m", "docs", "heads", "peaks", "terms", "tfs", "starts", "places"]


def portions(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, those of very long texts in several lists."""
    begin = 0
    flat = text.translate(ALNUM)
    while begin < len(flat):
        end = flat.find(b" ", begin + PORTION) if len(flat) - begin > PORTION else -1
        end = len(flat) if end < 0 else end
        yield flat[begin:end].split()
        begin = end


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return UNIT * tf // (1000 * tf + SATURATION * m)


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, term and count: the terms of every item, those of rows with one id together."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [sum((Counter(p) for p in portions(t)), Counter()) for t in blobs(batch.column(1))]
        pairs = [[{"term": w, "count": c} for w, c in some.items()] for some in counts]
        kind = pa.list_(pa.struct([("term", pa.binary()), ("count", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(pairs, kind)], ["item_id", "pairs"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = map_batches(items.select("item_id", "text"), run, f"item_id {kind}, pairs array<struct<term: binary, count: long>>")
    return rows.select("item_id", F.inline("pairs")).groupBy("item_id", "term").agg(F.sum("count").alias("count"))


@dataclass
class Queries:
    """A bounded portion of the query set as flat arrays: the terms of query q are starts[q] to starts[q + 1]."""

    ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def of(cls, rows: list) -> Queries:
        by_item: dict = {}
        for r in rows:
            by_item.setdefault(r["item_id"], []).append((bytes(r["term"]), r["count"]))
        ids = sorted(by_item, key=lambda i: (i is not None, i))
        vocabulary = {t: i for i, t in enumerate(sorted({t for pairs in by_item.values() for t, _ in pairs}))}
        flat = [(vocabulary[t], c) for i in ids for t, c in sorted(by_item[i])]
        starts = np.cumsum([0, *(len(by_item[i]) for i in ids)])
        terms, counts = (np.array(x, np.int64) for x in zip(*flat, strict=True)) if flat else (np.zeros(0, np.int64),) * 2
        return cls(ids, vocabulary, starts, terms, counts)

    def bounds(self, m: int, heads: np.ndarray, peaks: np.ndarray) -> np.ndarray:
        """The most any document of a block can score, for every query."""
        best = np.zeros(len(self.weights), np.int64)
        best[heads] = self.weights[heads] * impacts(peaks, m)
        return np.add.reduceat(self.counts * best[self.terms], self.starts[:-1])


def count_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (all terms of the text) and the wanted terms with their frequencies. ``vocabulary`` is a broadcast dict."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = vocabulary.value.get
        lengths, terms, tfs = [], [], []
        for text in blobs(batch.column(1)):
            n, found = 0, Counter()
            for words in portions(text):
                n += len(words)
                found.update(map(number, words))
            found.pop(None, None)
            lengths.append(n)
            terms.append(list(found))
            tfs.append(list(found.values()))
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        arrays = [pa.array(x, k) for x, k in zip((lengths, terms, tfs), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def _block(number: int, m: int, docs: list[int], terms: list[np.ndarray], tfs: list[np.ndarray]) -> list:
    """An index row: places of documents grouped by term and, within it, by falling tf."""
    order = np.argsort(docs, kind="stable")
    ids = np.array(docs, np.int64)[order]
    sizes = [len(terms[i]) for i in order]
    term, tf = np.concatenate([terms[i] for i in order]), np.concatenate([tfs[i] for i in order])
    place = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    by = np.lexsort((place, -tf.astype(np.int64), term))
    term, tf, place = term[by], tf[by], place[by]
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
    group_terms, group_tfs = term[first], tf[first]
    head = np.flatnonzero(np.r_[True, group_terms[1:] != group_terms[:-1]])
    return [number, m, ids, group_terms[head], group_tfs[head], group_terms, group_tfs, np.r_[first, len(term)].astype(np.int32), place]


def build_index(counted: DataFrame, n_docs: int, n_terms: int, postings: int, work: Workspace) -> DataFrame:
    """Blocks of the strata, written to the shared folder.

    Rows are range-partitioned by m and a hash of the document, so each task streams whole runs of equal m
    and cuts them into blocks. Documents without id or without a wanted term are in no block.
    """
    spark = counted.sparkSession
    m = F.expr(f"{SHORTEN} + cast((cast({SLOPE} as decimal(38, 0)) * n * cast({n_docs} as decimal(20, 0))) div cast({n_terms} as decimal(20, 0)) as bigint)")
    rows = counted.where("size(terms) > 0 and doc_id is not null").select(m.alias("m"), F.col("doc_id").cast("long").alias("doc_id"), "terms", "tfs").withColumn("h", F.xxhash64("doc_id"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // TASK_POSTINGS))
    dealt = rows.repartitionByRange(n, "m", "h").sortWithinPartitions("m", "h", "doc_id").select("m", "doc_id", "terms", "tfs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        last = size = 0
        for batch in batches:
            values = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            for now, doc, terms, tfs in zip(*values, strict=True):
                if held and (now != last or len(held) == BLOCK_DOCS or size > BLOCK_POSTINGS):
                    yield _rows([_block(number, last, *map(list, zip(*held, strict=True)))])
                    number, held, size = number + 1, [], 0
                held.append((doc, terms, tfs))
                last, size = int(now), size + len(terms)
        if held:
            yield _rows([_block(number, last, *map(list, zip(*held, strict=True)))])

    return work.put(dealt.mapInArrow(run, _INDEX))


def _rows(blocks: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*blocks, strict=True), _TYPES, strict=True)], _NAMES)


def _lists(batch: pa.RecordBatch, names: Iterable[str]) -> Iterator[dict]:
    columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
    for i in range(batch.num_rows):
        yield {n: c[i].values.to_numpy() if pa.types.is_list(c.type) else c[i].as_py() for n, c in columns.items()}


def _seeds(index: DataFrame, shared) -> DataFrame:
    """query and block: the blocks with the highest bounds of every query."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value[0]
        best = np.zeros((len(queries.ids), SEEDS), np.int64)
        where = np.zeros_like(best)
        for batch in batches:
            for row in _lists(batch, ("block", "m", "heads", "peaks")):
                bound = queries.bounds(row["m"], row["heads"], row["peaks"])
                low = best.argmin(axis=1)
                better = np.flatnonzero(bound > best[np.arange(len(best)), low])
                best[better, low[better]], where[better, low[better]] = bound[better], row["block"]
        q, s = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, where[q, s], best[q, s])], ["query", "block", "bound"])

    found = index.select("block", "m", "heads", "peaks").mapInArrow(run, "query long, block long, bound long")
    order = Window.partitionBy("query").orderBy(F.col("bound").desc(), "block")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SEEDS).select("query", "block")


def score_block(row: dict, queries: Queries, wanted: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """query, documents and scores: the k best documents of a block at or above each wanted query's floor."""
    tfs, which = np.unique(row["tfs"], return_inverse=True)
    impact = impacts(tfs, row["m"])[which]  # once for each tf of the stratum
    starts, sizes = row["starts"], np.diff(row["starts"])
    first = np.searchsorted(row["terms"], row["heads"])
    ends = np.r_[first[1:], len(row["terms"])]
    head_of = np.full(len(queries.weights), -1, np.int64)
    head_of[row["heads"]] = np.arange(len(row["heads"]))
    gains: dict[int, np.ndarray] = {}
    for q in wanted.tolist():
        total = np.zeros(len(row["docs"]), np.int64)
        for at in range(queries.starts[q], queries.starts[q + 1]):
            term = queries.terms[at]
            h = head_of[term]
            if h < 0 or not queries.weights[term]:
                continue
            a, b = first[h], ends[h]
            if h not in gains:
                gains[h] = queries.weights[term] * np.repeat(impact[a:b], sizes[a:b])
            total[row["places"][starts[a] : starts[b]]] += queries.counts[at] * gains[h]
        good = np.flatnonzero(total >= max(1, floors[q]))
        if len(good) > k:
            good = good[np.argsort(-total[good], kind="stable")[:k]]  # documents stand by id, so ties go to the smaller
        if len(good):
            yield q, row["docs"][good], total[good]


def _scored(index: DataFrame, shared, id_type: pa.DataType, id_name: str, k: int) -> DataFrame:
    """item_id, doc_id and score of the documents that may be among an item's k best."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, seeded, floors = shared.value
        floors = floors.copy()
        best = np.zeros((len(floors), k), np.int64)
        for batch in batches:
            found: list[tuple] = []
            bounded = []
            for row in _lists(batch, _NAMES):
                bounded.append((queries.bounds(row["m"], row["heads"], row["peaks"]), row))
            bounded.sort(key=lambda x: -int(x[0].max()))  # strata with high bounds raise the floors for the rest
            for bound, row in bounded:
                wanted = np.flatnonzero((bound > 0) & (bound >= floors)) if seeded is None else np.array(seeded.get(row["block"], ()), np.int64)
                for q, docs, scores in score_block(row, queries, wanted, floors, k):
                    found.append((q, docs, scores))
                    best[q] = np.sort(np.r_[best[q], scores])[-k:]
                    floors[q] = max(floors[q], best[q][0])
            items = [queries.ids[q] for q, docs, _ in found for _ in docs]
            numbers = np.concatenate([np.zeros(0, np.int64), *(np.full(len(d), q) for q, d, _ in found)])
            docs = np.concatenate([np.zeros(0, np.int64), *(d for _, d, _ in found)])
            scores = np.concatenate([np.zeros(0, np.int64), *(s for _, _, s in found)])
            yield pa.RecordBatch.from_arrays([pa.array(items, id_type), pa.array(numbers), pa.array(docs), pa.array(scores)], ["item_id", "query", "doc_id", "score"])

    return index.mapInArrow(run, f"item_id {id_name}, query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, query_limit: int = QUERY_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score: the k best documents with a score above 0 of every item.

    Null and empty texts have no terms: such documents are in no list and do not count as documents, such
    items have no rows. Rows of one item_id, null among them, are one item whose terms are put together.
    Repeated documents are ranked each; rows without doc_id count in all statistics but cannot be
    named, so they take no place. Other columns are not looked at. No rows on either side: no result.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lexical")
    kind = items.schema["item_id"].dataType
    asked = work.put(query_terms(items))
    n_chunks = -(-asked.count() // query_limit)
    parts = []
    for i in range(n_chunks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(n_chunks)) == i).collect()
        if rows:
            parts.append(_search(docs, Queries.of(rows), to_arrow_type(kind), kind.simpleString(), k, work))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, queries: Queries, id_type: pa.DataType, id_name: str, k: int, work: Workspace) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    counted = work.put(count_terms(docs, context.broadcast(queries.vocabulary)))
    total = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    df = np.zeros(len(queries.vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the vocabulary of the queries
        df[r["term"]] = r["count"]
    queries.weights = np.array([weight(total[0], int(x)) for x in df], np.int64)
    if not total[2]:
        return spark.createDataFrame([], f"item_id {id_name}, query long, doc_id long, score long")
    index = build_index(counted, *total, work)
    work.drop(counted)
    none = np.zeros(len(queries.ids), np.int64)
    seeded: dict[int, list[int]] = {}
    for r in _seeds(index, context.broadcast((queries, None, none))).collect():  # SEEDS rows a query
        seeded.setdefault(r["block"], []).append(r["query"])
    first = _scored(index.where(F.col("block").isin(list(seeded))), context.broadcast((queries, seeded, none)), id_type, id_name, k)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
    kth = first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select("query", "score").collect()
    floors = none.copy()
    for r in kth:
        floors[r["query"]] = r["score"]
    return work.put(_scored(index, context.broadcast((queries, None, floors)), id_type, id_name, k))
