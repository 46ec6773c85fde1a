"""Best-fit packing of token sequences.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens;
pieces are dealt over tasks and packed there by bounded-space best fit. A
task holds a fixed number of open sequences, found through a bitset keyed by
free space: the piece goes to the open sequence with the least space that
still holds it. When a new sequence must be opened and none is left, the
fullest one closes first. Pieces come longest first and over so many tasks that this is not
needed: what runs is best fit over a sorted stream.

Ids come from the library's byte pairs (``bpe``), which gives what the tokenizers library gives.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.bpe import byte_pairs, in_portions
from martkit.llm.frames import Workspace, map_batches, map_stream

CAPACITY = 2048
OPEN_SEQUENCES = 16_384
LOAD = 0.4  # share of a task's open sequences that its tokens fill at most on average
END = bytes(4)  # id 0 after each document


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of a document of n tokens: full pieces after a first one that may be shorter."""
    return [0, *range(n % capacity or capacity, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (and the ids themselves)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = byte_pairs(tokenizer_file)
        numbers, pieces, begins, lengths, sums, chunks = [], [], [], [], [], []
        at = 0
        for some in in_portions([t or "" for t in batch.column(1).to_pylist()]):
            for data in pairs.encode(some):
                data += END
                starts = cut_points(len(data) // 4, capacity)
                ends = [*starts[1:], len(data) // 4]
                numbers += [at] * len(starts)
                pieces += range(len(starts))
                begins += starts
                lengths += map(int.__sub__, ends, starts)
                cut = [data] if len(starts) == 1 else [data[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)]
                sums += map(zlib.crc32, cut)
                if keep_ids:
                    chunks += cut
                at += 1
        columns = [batch.column(0).take(pa.array(numbers, pa.int64())), pa.array(pieces, pa.int32()), *(pa.array(c, pa.int64()) for c in (begins, lengths, sums))]
        if keep_ids:
            columns.append(pa.array(chunks, pa.binary()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return map_batches(docs.select("doc_id", "text"), run, schema)


class Packer:
    """Bounded-space online best fit."""

    def __init__(self, capacity: int, open_sequences: int):
        self.capacity, self.most = capacity, open_sequences
        self.bits = 0  # bit s: some open sequence has s tokens free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Number of the sequence for a piece, and its place there."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.capacity, self.made
            self.made += 1
        if free > length:
            self.bins[free - length].append(number)
            self.bits |= 1 << free - length
            self.n_open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_sequences: int = OPEN_SEQUENCES) -> DataFrame:
    """Add sequence_id and offset to pieces of at most ``capacity`` tokens.

    Pieces are staged and dealt over tasks by a hash of document and piece, so each task gets
    an even share whatever the ids are, and arrive longest first; a repeated task sees the same
    order and gives the same numbers. Best fit leaves at most one sequence half empty, so tokens
    for ``LOAD`` of the open sequences never need twice as many: no sequence closes early, however
    many pieces there are. Equal rows are separate pieces. No piece: no sequence.
    """
    spark = pieces.sparkSession
    pieces = Workspace(spark, "packing").put(pieces)
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // int(max(1, capacity * open_sequences * LOAD))))
    order = [F.col("length").desc(), "doc_id", "piece", "start", "ids_crc32"]
    dealt = pieces.repartition(n, "doc_id", "piece").sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, task = Packer(capacity, open_sequences), TaskContext.get().partitionId() << 40
        for batch in batches:
            places = [packer.place(n) for n in batch.column(batch.schema.get_field_index("length")).to_pylist()]
            sequences = pa.array([task + a for a, _ in places], pa.int64())
            offsets = pa.array([b for _, b in places], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sequences, offsets], [*batch.schema.names, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    return map_stream(dealt, run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, open_sequences: int = OPEN_SEQUENCES, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents.

    Null and empty texts are the single end token. Rows that repeat a doc_id are packed each.
    """
    return pack(token_pieces(docs, tokenizer_file, capacity, keep_ids), capacity, open_sequences)
