"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all benchmark items (a number of consecutive normalised words)
are the patterns of one automaton. A document is normalised to its words with
single spaces between them and scanned once; each hit's end is mapped back to
word numbers and, through the words' offsets, to the original text.

The automaton is broadcast, so its windows are bounded: a benchmark whose windows take
more than ``chunk_bytes`` is split into several automata, each collected and run over the
documents in turn, and the spans of one document are united.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import Workspace, alnum_words, blobs, map_batches

WINDOW = 10
CHUNK_BYTES = 64_000_000  # of windows in one automaton
SPANS = "array<struct<first:bigint,last:bigint>>"


def patterns_of(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> dict[bytes, list[int]]:
    """Every window with the numbers of the items that hold it."""
    found: dict[bytes, list[int]] = {}
    for number, (_, text) in enumerate(items):
        words = alnum_words(text)
        if not words:
            continue
        for i in range(max(1, len(words) - window + 1)):
            owners = found.setdefault(b" ".join(words[i : i + window]), [])
            if not owners or owners[-1] != number:
                owners.append(number)
    return found


class Machine:
    """The automaton over some items; built once in each worker from the plain patterns."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.names, self.patterns, self._built = [name for name, _ in items], patterns_of(items, window), None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_built": None}

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._built is None:
            self._built = ahocorasick.Automaton()
            for pattern, owners in self.patterns.items():
                # Spaces on both sides make a pattern match whole words only.
                self._built.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, owners))
            self._built.make_automaton()
        return self._built

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words [first, end), and the ids of the items found."""
        if not words or not self.patterns:
            return [], set()
        hits = list(self.automaton.iter(f" {b' '.join(words).decode('latin-1')} "))
        if not hits:
            return [], set()
        ends = list(accumulate(len(w) + 1 for w in words))  # offset of the space after each word
        spans = []
        for end, (n, _) in hits:
            last = bisect_left(ends, end) + 1
            spans.append((last - n, last))
        return united(spans), {self.names[i] for _, (_, owners) in hits for i in owners if self.names[i] is not None}


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint spans."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def benchmark_chunks(benchmark: DataFrame, window: int, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[list[tuple[str | None, bytes]], bool]]:
    """Items as (id, text) in lists whose windows stay within the bound, and whether the list is the last.

    A word starts a window of so many words, so windows take about ``window`` times the bytes of a text. Rows are dealt by
    a hash of id and text: an item of many texts is spread, a single longer text stands alone. One list is
    on the driver at a time.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum((F.octet_length("text") + 16) * window)).first()[0] or 0
    n = -(-size // chunk_bytes) or 1
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield sorted({(r["item_id"], r["text"].encode()) for r in part.collect()}, key=lambda x: (x[0] or "", x[1])), i == n - 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Words of each document that stand in a window of a benchmark item.

    Result per document: doc_id, n_words, spans (word ranges [first, end)),
    n_hit, items (ids found). Null and empty texts have no words. Items
    without words match nothing; items with one id are one item whose
    windows are united. Items without id count as any other for spans and
    n_hit, but cannot be named in items. An empty benchmark leaves every document clean.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text", F.lit(None).cast(SPANS).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for items, last in benchmark_chunks(benchmark, window, chunk_bytes):
        shared = spark.sparkContext.broadcast(Machine(items, window))
        found = map_batches(found, _scanner(shared, last), f"doc_id {kind}, {'n_words long' if last else 'text string'}, spans {SPANS}, items array<string>")
        if not last:  # one automaton in memory at a time
            found = Workspace(spark, "leaks").put(found)
    return found.withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first)"))


def _scanner(shared, last: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = shared.value
        counts, spans, items = [], [], []
        before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
        for text, (old_spans, old_items) in zip(blobs(batch.column("text")), before, strict=True):
            words = alnum_words(text)
            counts.append(len(words))
            hit, names = machine.scan(words)
            if old_spans:
                hit, names = united(hit + [(s["first"], s["last"]) for s in old_spans]), names | set(old_items)
            spans.append([{"first": a, "last": b} for a, b in hit])
            items.append(sorted(names))
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        second = pa.array(counts, pa.int64()) if last else batch.column("text")
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), second, pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
            ["doc_id", "n_words" if last else "text", "spans", "items"],
        )

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows, with all their columns, whose text holds no window of any item."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at, kept = docs.columns.index("text"), docs
    for items, last in benchmark_chunks(benchmark, window, chunk_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Machine(items, window))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            return batch.filter(pa.array([not shared.value.scan(alnum_words(t))[0] for t in blobs(batch.column(at))], pa.bool_()))

        kept = map_batches(kept, run, schema)
        if not last:  # one automaton in memory at a time
            kept = Workspace(docs.sparkSession, "clean").put(kept)
    return kept
