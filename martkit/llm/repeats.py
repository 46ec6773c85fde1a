"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes over it also starts earlier in the
corpus (smaller id, or same document and earlier start).

Corpus order can't be searched in one place, so every string is led to the
places it could meet its copies:

1. Anchors. Every ``LENGTH`` bytes hold an anchor, a short gram whose hash is
   the least in them; equal strings hold it at the same place. An anchor
   stands for all strings around it, its context. Anchors are sorted by the
   hashes of gram and context.
2. Of equal contexts all but the first go. Grams in one context only are done.
3. The first occurrences of differing contexts of one gram are cut from the
   texts and meet in shards of bounded size. There a suffix array is built by
   induced sorting, and strings with a common prefix of ``LENGTH`` bytes are
   found from the permuted common prefixes; all but the first of them go.

A gram with very many contexts (a common line, the edges of a common passage)
is not led to one shard. Each string holds more than half of its bytes besides
the gram on one side, so its contexts go once by a key that is longer to the
left and once by one longer to the right. What is still too large for a shard
is parted again in the same way, until a key is a whole string. A part is shorter
than its context, so parts of differing contexts are often equal; of those only the first
goes on, so that a hot gram costs its distinct parts in each round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import Workspace, blobs, map_batches, map_stream
from martkit.llm.suffixes import common_prefixes, suffix_array
from martkit.operators.joins import hot_keys
from martkit.operators.reduction import split_by_filter

LENGTH = 100
GRAM = 24
REACH = LENGTH - GRAM  # bytes that a string can have on one side of its gram
WIDE = REACH + LENGTH
CHUNK_BYTES = 1 << 17
SHARD_BYTES = 600_000
MANY_CONTEXTS = 2_000  # contexts of one gram beyond which they are parted at once
END = 255  # a byte that no UTF-8 text holds

_RNG = np.random.default_rng(40)
_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 4 + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        out[size : 2 * size] = out[: min(size, n - size)] * step
        size *= 2
    return out


class _Hashes:
    """Hashes of substrings of a byte string, from one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if n > len(_POWERS[0]):
            _POWERS[:] = [_powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 1 << 64), 2 * n)]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_VALUES[data] * _POWERS[0][: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        back = _POWERS[1][: len(self.sums)]
        return _mix((self.sums[end] - self.sums[start]) * back[start])


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts lying one after the other up to ``ends``.

    Gives, for each, its place, number of the text, reach to the right and the hashes of gram and context.
    """
    n = len(data)
    sizes = np.diff(ends, prepend=0)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = _Hashes(data)
    grams = hashes.of(slice(0, n - GRAM + 1), slice(GRAM, n + 1)) | np.uint64(1)
    least = _slide(grams, REACH + 1, np.minimum)  # of each string of LENGTH bytes
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):  # strings across texts don't count
        least[max(0, end - min(size, LENGTH - 1)) : end] = 0
    edge = np.zeros(REACH, np.uint64)
    chosen = np.flatnonzero(_slide(np.concatenate((edge, least, edge)), REACH + 1, np.maximum) == grams)
    text = np.searchsorted(ends, chosen, "right")
    right = np.minimum(ends[text] - chosen, LENGTH)
    left = np.minimum(chosen - (ends - sizes)[text], REACH)
    context = hashes.of(chosen - left, chosen + right)
    context = _mix(context + (left * 1000 + right).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return chosen, text, right, grams[chosen], context


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of one document joined; input sorted by document and start."""
    if not len(doc):
        return doc, start, end
    # Documents lie apart on one line, so that a running maximum never reaches into the next.
    number = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    width = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * width)
    first = np.concatenate(([True], start[1:] + number[1:] * width > reach[:-1]))
    last = np.concatenate((first[1:], [True]))
    return doc[first], start[first], reach[last] - number[last] * width


SPAN = "doc_id long, start long, end long"


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """Rows (gram, context, doc_id, start, right) of anchors, and with null context spans [start, right) that go.

    Contexts repeated within one batch are settled at once, so a hot one leaves each task once a batch.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        texts = blobs(batch.column(1))
        parts: list[tuple] = []
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK_BYTES):
                size += len(texts[hi])
                hi += 1
            ends = np.cumsum([len(t) for t in texts[lo:hi]])
            place, text, right, gram, context = anchors(np.frombuffer(b"".join(texts[lo:hi]), np.uint8), ends)
            own = np.concatenate(([0], ends[:-1]))[text] if len(text) else place
            parts.append((gram, context, ids[lo:hi][text], place - own, right))
            lo = hi
        gram, context, doc, start, right = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 5
        order = np.lexsort((start, doc, context, gram))
        gram, context, doc, start, right = gram[order], context[order], doc[order], start[order], right[order]
        again = np.zeros(len(gram), bool)
        # The same id twice is one document: the same place is not a repeat.
        again[1:] = (gram[1:] == gram[:-1]) & (context[1:] == context[:-1]) & ((doc[1:] != doc[:-1]) | (start[1:] != start[:-1]))
        d, s, e = doc[again], np.maximum(start[again] - REACH, 0), start[again] + right[again]
        order = np.lexsort((s, d))
        d, s, e = _merged(d[order], s[order], e[order])
        keep = ~again
        n = len(d)
        columns = [
            pa.array(np.concatenate((gram[keep].view(np.int64), _mix(d.astype(np.uint64)).view(np.int64)))),
            pa.array(np.concatenate((context[keep].view(np.int64), np.zeros(n, np.int64))), mask=np.arange(keep.sum() + n) >= keep.sum()),
            pa.array(np.concatenate((doc[keep], d)).astype(np.int64)),
            pa.array(np.concatenate((start[keep], s)).astype(np.int32)),
            pa.array(np.concatenate((right[keep], e)).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["gram", "context", "doc_id", "start", "right"])

    texts = docs.where("doc_id is not null and octet_length(text) >= 100").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(texts, run, "gram long, context long, doc_id long, start int, right int")


def _settle(rows: DataFrame) -> DataFrame:
    """One pass over staged anchors sorted by gram, context and place.

    Gives spans that go (null gram) and, for grams with several contexts, the first place of each. Grams that a
    sketch finds in more rows than a fair task are dealt by gram and context: equal contexts still meet,
    and as such a gram's contexts no longer all do, it counts as one with several.
    """
    hot = F.broadcast(hot_keys(rows.where("context is not null"), ["gram"]))  # at most two rows a task
    parted = rows.join(hot, F.xxhash64("gram") == F.col("_hot"), "left")
    parted = parted.withColumn("piece", F.when(F.col("_salts").isNotNull(), F.pmod("context", "_salts"))).drop("_hot", "_salts")
    dealt = parted.repartition("gram", "piece").sortWithinPartitions("gram", "piece", "context", "doc_id", "start")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # gram, context of the last anchor
        pending: tuple | None = None  # the only context so far of the last gram
        for batch in batches:
            spans = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            table = batch.filter(pa.array(~spans))
            split = table.column(5).is_valid().to_numpy(zero_copy_only=False)
            gram, context, doc, start, right = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in table.columns[:5])
            gone = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.filter(pa.array(spans)).columns[2:5]]
            if len(gram):
                same_gram = np.concatenate(([last is not None and gram[0] == last[0]], gram[1:] == gram[:-1]))
                again = same_gram & np.concatenate(([last is not None and context[0] == last[1]], context[1:] == context[:-1]))
                # A document given twice meets itself at the same place.
                itself = np.concatenate(([last is not None and (doc[0], start[0]) == last[2:]], (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])))
                goes = again & ~itself
                gone = [np.concatenate(p) for p in zip(gone, (doc[goes], np.maximum(start[goes] - REACH, 0), start[goes] + right[goes]), strict=True)]
                new = np.flatnonzero(~again)
                g, d, s, r, later = gram[new], doc[new], start[new], right[new], same_gram[new]
                cut = split[new]
                if pending is not None:
                    g, d, s, r = (np.concatenate(([p], c)) for p, c in zip(pending, (g, d, s, r), strict=True))
                    later, cut = np.concatenate(([False], later)), np.concatenate(([False], cut))
                followed = np.concatenate((later[1:], [False])) if len(later) else later
                shared = later | followed | cut
                # The last context stays open while it is the only one of its gram.
                pending = (g[-1], d[-1], s[-1], r[-1]) if len(g) and not shared[-1] else None
                if len(g) and not shared[-1]:
                    shared[-1] = False
                last = (gram[-1], context[-1], doc[-1], start[-1])
                g, d, s, r = g[shared], d[shared], s[shared], r[shared]
            else:
                g = d = s = r = np.zeros(0, np.int64)
            n = len(g)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((g, np.zeros(len(gone[0]), np.int64))), mask=np.arange(n + len(gone[0])) >= n),
                    pa.array(np.concatenate((d, gone[0]))),
                    pa.array(np.concatenate((s, gone[1]))),
                    pa.array(np.concatenate((r, gone[2]))),
                ],
                ["gram", "doc_id", "start", "end"],
            )

    return map_stream(dealt, run, f"gram long, {SPAN}")


MEETING = "key long, doc_id long, start long, part binary, at int, left int, right int"
_MEETING = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]


def _halves(text: bytes, at: int, left: int, right: int) -> Iterator[tuple[int, int, int, int, int]]:
    """The strings around the gram at ``at`` with at least so many bytes on its sides, by two longer keys.

    Gives key, begin and end of the part that holds the strings, and the new least numbers of bytes.
    """
    slack = REACH - left - right
    more = (slack + 1) // 2
    for l, r in ((left + more, right), (left, right + slack - more + 1)):
        begin, end = max(0, at - (REACH - r)), min(len(text), at + GRAM + REACH - l)
        if at >= l and at + GRAM + r <= len(text) and end - begin >= LENGTH:
            digest = hashlib.blake2b(text[at - l : at + GRAM + r], digest_size=8, salt=bytes((l, r))).digest()
            yield int.from_bytes(digest, "little", signed=True), begin, end, l, r


def _meeting(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_MEETING)]
    return pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "start", "part", "at", "left", "right"])


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Contexts with their bytes and the key of the shard where they meet others.

    ``wanted`` has doc_id and places (gram, start, many); anchors of a gram with many contexts are parted.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, text, places in zip(batch.column(0).to_pylist(), blobs(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            for place in places:
                at = place["start"]
                if place["many"]:
                    rows += [(key, doc, lo, text[lo:hi], at - lo, left, right) for key, lo, hi, left, right in _halves(text, at, 0, 0)]
                else:
                    lo, hi = max(0, at - REACH), min(len(text), at + LENGTH)
                    rows.append((place["gram"], doc, lo, text[lo:hi], at - lo, 0, 0))
        return _meeting(rows)

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")
    return map_batches(texts.select("doc_id", "text", "places"), run, MEETING)


def _part(large: DataFrame) -> DataFrame:
    """Contexts of groups too large for a shard, each by two longer keys."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, start, part, at, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows += [(key, doc, start + lo, part[lo:hi], at - lo, l, r) for key, lo, hi, l, r in _halves(part, at, left, right)]
        return _meeting(rows)

    return map_batches(large.select("doc_id", "start", "part", "at", "left", "right"), run, MEETING)


def repeated_in_shard(doc: np.ndarray, start: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (doc, start, end) of the parts' strings of LENGTH bytes that also start earlier in another part."""
    order = np.lexsort((start, doc))
    doc, start, parts = doc[order], start[order], [parts[i] for i in order]
    text = np.frombuffer(bytes([END]).join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    array = suffix_array(text)
    prefix = common_prefixes(text, array, begins, -(-(WIDE + LENGTH) // 8) * 8)
    strings = np.zeros(len(text) + 1, np.int64)
    whole = sizes >= LENGTH
    strings[begins[whole]] += 1
    strings[(begins + sizes - LENGTH + 1)[whole]] -= 1
    strings = np.cumsum(strings[:-1]) > 0
    valid = strings[array]
    group = np.cumsum(prefix[array] < LENGTH)[valid]
    at = array[valid]
    part = np.searchsorted(begins, at, "right") - 1
    rank = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    place = (rank[part] << 40) + start[part] + at - begins[part]
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
    least = np.repeat(np.minimum.reduceat(place, edge), np.diff(np.append(edge, len(place)))) if len(edge) else place
    flags = np.zeros(len(text) + 1, bool)
    flags[at[place != least]] = True
    first = np.flatnonzero(flags & ~np.concatenate(([False], flags[:-1])))
    after = np.flatnonzero(~flags & np.concatenate(([False], flags[:-1])))
    part = np.searchsorted(begins, first, "right") - 1
    return doc[part], start[part] + first - begins[part], start[part] + after - begins[part] + LENGTH - 1


def _meet(cut: DataFrame, shard_bytes: int) -> DataFrame:
    """Spans that go, and of groups too large for a shard their parts or, where the key is a whole string, its hash.

    Of equal parts of a group only the first is compared or led on: the others go whole.
    """
    dealt = cut.repartition("key").sortWithinPartitions("key", "left", "right", "at", "part", "doc_id", "start")
    kinds = {"h1": pa.int64(), "h2": pa.int64(), "doc_id": pa.int64(), "start": pa.int64(), "end": pa.int64(), "part": pa.binary(), "at": pa.int32(), "left": pa.int32(), "right": pa.int32()}

    def result(n: int, **columns: pa.Array | list | np.ndarray) -> pa.RecordBatch:
        arrays = [pa.nulls(n, kind) if name not in columns else columns[name] if isinstance(columns[name], pa.Array) else pa.array(columns[name], kind) for name, kind in kinds.items()]
        return pa.RecordBatch.from_arrays(arrays, list(kinds))

    def followers(batch: pa.RecordBatch, before: pa.RecordBatch | None) -> tuple[np.ndarray, np.ndarray]:
        """Whether each row has the part of the row before it, and whether it is that very place, of a document given twice."""
        rows = batch if before is None else pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
        n = rows.num_rows

        def same(*names: str) -> np.ndarray:
            equal = [pc.equal(rows.column(c).slice(1), rows.column(c).slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in names]
            return np.concatenate(([False] * (before is None), reduce(np.logical_and, equal))).astype(bool)

        return same("key", "left", "right", "at", "part"), same("doc_id", "start")

    def flush(keys: list[np.ndarray], held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        key = np.concatenate(keys)
        alone = np.concatenate(([True], key[1:] != key[:-1])) & np.concatenate((key[1:] != key[:-1], [True]))
        which = np.flatnonzero(~alone)
        if len(which) > 1:
            parts = rows.column("part").to_pylist()
            doc, start, end = repeated_in_shard(rows.column("doc_id").to_numpy()[which], rows.column("start").to_numpy()[which], [parts[i] for i in which])
            yield result(len(doc), doc_id=doc, start=start, end=end)

    def lead_on(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        left, right = batch.column("left").to_numpy(), batch.column("right").to_numpy()
        full = pa.array(left + right == REACH)
        strings, rest = batch.filter(full), batch.filter(pa.array(left + right != REACH))
        if rest.num_rows:
            yield result(rest.num_rows, **{name: rest.column(name) for name in ("doc_id", "start", "part", "at", "left", "right")})
        if strings.num_rows:
            digests = [hashlib.blake2b(p, digest_size=16).digest() for p in strings.column("part").to_pylist()]
            h1, h2 = ([int.from_bytes(d[i : i + 8], "little", signed=True) for d in digests] for i in (0, 8))
            yield result(strings.num_rows, h1=h1, h2=h2, doc_id=strings.column("doc_id"), start=strings.column("start"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        keys: list[np.ndarray] = []
        size, large = 0, None  # bytes held; key of a group that is led on
        group = 0  # bytes held of the last key
        before: pa.RecordBatch | None = None  # the last row
        for batch in batches:
            if not batch.num_rows:
                continue
            again, itself = followers(batch, before)
            before = batch.slice(batch.num_rows - 1)
            gone = batch.filter(pa.array(again & ~itself))
            if gone.num_rows:
                start = gone.column("start").to_numpy()
                yield result(gone.num_rows, doc_id=gone.column("doc_id"), start=start, end=start + pc.binary_length(gone.column("part")).to_numpy())
            batch = batch.filter(pa.array(~again))
            key = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            lengths = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column("part")).to_numpy() + 1)))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                rows, n, this = batch.slice(lo, hi - lo), int(lengths[hi] - lengths[lo]), int(key[lo])
                if this == large:
                    yield from lead_on(rows)
                    continue
                if keys and int(keys[-1][-1]) == this:
                    group += n
                else:
                    group = n
                    if held and size + n > shard_bytes:
                        yield from flush(keys, held)
                        held, keys, size = [], [], 0
                held.append(rows)
                keys.append(key[lo:hi])
                size += n
                if group > shard_bytes:
                    first = next(i for i, k in enumerate(keys) if int(k[0]) == this)
                    for part in held[first:]:
                        yield from lead_on(part)
                    if first:
                        yield from flush(keys[:first], held[:first])
                    held, keys, size, large = [], [], 0, this
        if held:
            yield from flush(keys, held)

    return map_stream(dealt, run, f"h1 long, h2 long, {SPAN}, part binary, at int, left int, right int")


def repeated_spans(docs: DataFrame, work: Workspace, shard_bytes: int = SHARD_BYTES, many_contexts: int = MANY_CONTEXTS) -> DataFrame:
    """doc_id and spans (sorted, disjoint) of the bytes that go, for documents that have any."""
    anchored = work.put(_anchor_rows(docs))
    settled = work.put(_settle(anchored))
    work.drop(anchored)
    wanted = settled.where("gram is not null")
    many = wanted.groupBy("gram").agg(F.count("*").alias("n")).where(f"n > {many_contexts}").select("gram", F.lit(True).alias("many"))
    places = (
        wanted.join(many, "gram", "left")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("gram", "start", F.coalesce("many", F.lit(False)).alias("many"))).alias("places"))
    )
    met = [work.put(_meet(_cut(docs, places), shard_bytes))]
    # Each round parts what is too large by half of the bytes still free; a key is a whole string after seven at most.
    while not (large := met[-1].where("part is not null")).isEmpty():
        met.append(work.put(_meet(_part(large), shard_bytes)))
    done = reduce(DataFrame.unionByName, met).where("part is null")
    strings = done.where("h1 is not null")
    first = strings.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = strings.join(first, ["h1", "h2"]).where("struct(doc_id, start) <> first").select("doc_id", "start", (F.col("start") + LENGTH).alias("end"))
    spans = settled.where("gram is null").select("doc_id", "start", "end").unionByName(done.where("h1 is null").select("doc_id", "start", "end")).unionByName(later)

    def join(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in batch.column(1).to_pylist():
            begin = np.array(sorted((s["start"], s["end"]) for s in row), np.int64).reshape(-1, 2)
            _, a, b = _merged(np.zeros(len(begin), np.int64), begin[:, 0], begin[:, 1])
            out.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    gathered = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    result = work.put(map_batches(gathered, join, "doc_id long, spans array<struct<start:long,end:long>>"))
    work.drop(settled, *met)
    return result


def _with_spans(docs: DataFrame, spans: DataFrame, name: str) -> DataFrame:
    """The rows with their spans; rows whose document surely has none are not shuffled."""
    spans = spans.withColumnRenamed("spans", name)
    some, none = split_by_filter(docs, spans, {"doc_id": "doc_id"})
    found = some.join(spans, "doc_id", "left").select(*docs.columns, name)
    return found if none is None else found.unionByName(none.withColumn(name, F.lit(None).cast(spans.schema[name].dataType)))


def _kept(text: bytes, spans: list[dict]) -> bytes:
    out, at = [], 0
    for span in spans:
        out.append(text[at : span["start"]])
        at = span["end"]
    return b"".join([*out, text[at:]])


def repeated_bytes(docs: DataFrame, shard_bytes: int = SHARD_BYTES, many_contexts: int = MANY_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Null texts are empty; a row without id takes no part and keeps all. Rows that repeat an id
    are one document and must repeat its text. Texts shorter than ``LENGTH`` bytes lose nothing.
    """
    spans = repeated_spans(docs, Workspace(docs.sparkSession, "repeats"), shard_bytes, many_contexts)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, found in zip(blobs(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            kept = _kept(text, found or [])
            rows.append((len(text), len(text) - len(kept), len(found or []), hashlib.sha256(kept).hexdigest()))
        columns = [pa.array([r[i] for r in rows], pa.string() if i == 3 else pa.int64()) for i in range(4)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(docs.select("doc_id", "text"), spans, "spans")
    return map_batches(rows, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows with their repeated bytes taken out of the text.

    A character of several bytes goes only if all its bytes do. ``n_chars``, if there, follows the text.
    """
    spans = repeated_spans(docs, Workspace(docs.sparkSession, "repeats"))
    at, n = docs.columns.index("text"), len(docs.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def trimmed(text: bytes, spans: list[dict]) -> list[dict]:
        out = []
        for span in spans:
            a, b = span["start"], span["end"]
            while a < b and text[a] & 0xC0 == 0x80:
                a += 1
            while a < b < len(text) and text[b] & 0xC0 == 0x80:
                b -= 1
            out.append({"start": a, "end": b})
        return out

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        for i, (text, found) in enumerate(zip(blobs(batch.column(at)), batch.column(n).to_pylist(), strict=True)):
            if found:
                texts[i] = _kept(text, trimmed(text, found)).decode()
        columns = list(batch.columns[:n])
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[:n])

    out = map_batches(_with_spans(docs, spans, "__spans"), run, schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
