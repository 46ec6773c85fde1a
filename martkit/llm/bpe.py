"""Byte-pair encoding and decoding with a segment tree over adjacent pairs.

A pre-token's bytes are symbols; every adjacent pair has a rank in the merge table, or none. The
leaves of a segment tree hold rank and position of the pair that starts there, inner nodes the
smaller child: the root is the leftmost pair of the lowest rank. A merge changes three leaves
and their ancestors, so a pre-token of n bytes takes O(n log n) steps whatever its length.
Short pre-tokens go through their trees side by side, one merge of each at a time, as rows of
arrays; a long one has a tree of its own.

Texts are cut into words between single spaces where that cannot change the pre-tokens, and a
bounded number of words is remembered with its ids. Spark deals the documents over tasks; a
document needs nothing but its own text and the tokenizer file, which executors load by path.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martkit.llm.frames import HELD, map_batches

SHORT = 64  # most bytes of a pre-token that shares arrays with others
WORDS_KEPT = 250_000  # in each of two generations
AT_ONCE = 4096  # short pre-tokens merged side by side
CHARS_AT_ONCE = 1 << 21
_NONE = np.int32(2**31 - 1)  # no pair to merge
_EDGE = 0xFFFF  # symbol beyond both ends
_DEAD = -1


def byte_characters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairRanks:
    """Ranks of symbol pairs in an open-addressing table that arrays are looked up in."""

    SIZE = 1 << 18
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pairs: np.ndarray):
        keys = (pairs[:, 0] << 16 | pairs[:, 1]).astype(np.int64)
        self.keys, self.values = np.full(self.SIZE, -1, np.int64), np.full(self.SIZE, _NONE, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] < 0
            won = np.zeros(len(todo), bool)
            first = np.unique(slot[free], return_index=True)[1]
            won[np.flatnonzero(free)[first]] = True
            self.keys[slot[won]], self.values[slot[won]] = keys[todo[won]], todo[won]
            todo, slot = todo[~won], slot[~won] + 1 & self.SIZE - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self.FACTOR >> np.uint64(46)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 16 | right
        slot = self._slot(keys)
        met = self.keys[slot]
        out = np.where(met == keys, self.values[slot], _NONE)
        todo = np.flatnonzero((met != keys) & (met >= 0))
        while len(todo):
            slot[todo] = slot[todo] + 1 & self.SIZE - 1
            met = self.keys[slot[todo]]
            hit = met == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (met >= 0)]
        return out


def merge_side_by_side(symbols: np.ndarray, ranks: PairRanks, merged: np.ndarray) -> np.ndarray:
    """Merge every row's symbols (a power of two columns, ended by -1) until no pair of it has a rank. Merged-away places get -1."""
    n, width = symbols.shape
    bits = width.bit_length() - 1
    wide = width + 2  # two more places: beyond the right and the left end
    sym = np.full((n, wide), _EDGE, np.int32)
    sym[:, :width] = symbols
    lengths = (symbols >= 0).sum(axis=1)
    after = np.tile(np.arange(1, wide + 1, dtype=np.int32), (n, 1))
    before = np.tile(np.arange(-1, wide - 1, dtype=np.int32), (n, 1))
    before[:, 0] = width + 1
    after[np.arange(n), np.maximum(lengths - 1, 0)] = width
    tree = np.full((n, 2 * width), _NONE, np.int32)
    found = ranks.of(np.where(sym[:, : width - 1] < 0, _EDGE, sym[:, : width - 1]).ravel(), np.where(sym[:, 1:width] < 0, _EDGE, sym[:, 1:width]).ravel()).reshape(n, width - 1)
    places = np.arange(width - 1, dtype=np.int32)
    tree[:, width : 2 * width - 1] = np.where(found == _NONE, _NONE, (found << bits) + places)
    for level in range(bits - 1, -1, -1):
        low = 1 << level
        tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
    sym, after, before, tree = sym.reshape(-1), after.reshape(-1), before.reshape(-1), tree.reshape(-1)
    rows = np.arange(n)
    while True:
        best = tree[rows * (2 * width) + 1]
        going = best != _NONE
        rows, best = rows[going], best[going]
        if not len(rows):
            break
        at, base, root = best & width - 1, rows * wide, rows * (2 * width)
        gone = after[base + at]
        right, left = after[base + gone], before[base + at]
        new = merged[best >> bits]
        sym[base + at], sym[base + gone] = new, _DEAD
        after[base + at], before[base + right] = right, at
        sym[base + width], sym[base + width + 1] = _EDGE, _EDGE
        ahead, behind = ranks.of(new, sym[base + right]), ranks.of(sym[base + left], new)
        nodes = np.stack((gone, at, np.where(left >= width, gone, left))) + width
        tree[root + nodes[0]] = _NONE
        tree[root + nodes[1]] = np.where(ahead == _NONE, _NONE, (ahead << bits) + at)
        tree[root + nodes[2]] = np.where(behind == _NONE, _NONE, (behind << bits) + left)
        for _ in range(bits):
            nodes >>= 1
            spot = root + 2 * nodes
            tree[root + nodes] = np.minimum(tree[spot], tree[spot + 1])
    return sym.reshape(n, wide)[:, :width]


def merge_alone(symbols: list[int], rank_of: dict[tuple[int, int], int], merged: list[int]) -> list[int]:
    """The same for one long row, with a tree of its own."""
    n = len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    none = 1 << 62
    sym, after, before = list(symbols), [*range(1, n), -1], list(range(-1, n - 1))
    tree = [none] * (2 * width)
    for i in range(n - 1):
        rank = rank_of.get((sym[i], sym[i + 1]))
        if rank is not None:
            tree[width + i] = rank * width + i
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(place: int, other: int, left: int) -> None:
        rank = rank_of.get((sym[left], sym[other])) if left >= 0 and other >= 0 else None
        node = width + place
        tree[node] = none if rank is None else rank * width + place
        node >>= 1
        while node:
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1

    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone = after[at]
        right, left = after[gone], before[at]
        sym[at], sym[gone], after[at] = merged[rank], _DEAD, right
        if right >= 0:
            before[right] = at
        put(gone, -1, -1)
        put(at, right, at)
        if left >= 0:
            put(left, at, left)
    return [s for s in sym if s != _DEAD]


class _Slots(dict):
    """Numbers of words; a new word gets the next number and is noted."""

    def __init__(self) -> None:
        self.noted: list[str] = []
        self.count = 0

    def __missing__(self, word: str) -> int:
        self[word] = number = self.count
        self.count += 1
        self.noted.append(word)
        return number


class _Pool:
    """Runs of ids in one growing array, and where the run of each number starts and how long it is."""

    def __init__(self) -> None:
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)

    def add(self, ids: np.ndarray) -> int:
        """Start of ids appended to the array."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)))
        start = self.used
        self.ids[start : start + len(ids)] = ids
        self.used += len(ids)
        return start

    def set(self, numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        need = int(numbers.max(initial=0)) + 1
        if need > len(self.starts):
            more = np.zeros(need, np.int64)
            self.starts, self.lengths = np.concatenate((self.starts, more)), np.concatenate((self.lengths, more))
        self.starts[numbers], self.lengths[numbers] = starts, lengths

    def runs(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of all runs, one after the other."""
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.zeros(0, np.uint32)
        return self.ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]


# First characters of noted words that no word of a regular text starts with; any other word follows a space.
_EXACT, _HEAD, _LINE = "\t", "\r", "\n"  # one pre-token as it is; what starts a text; what follows a line feed
_STOPS = frozenset(",.;:!?")


class BytePairs:
    """A byte-level BPE vocabulary: texts to ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        plain = not any(spec.get(k) for k in ("normalizer", "truncation", "padding")) and not any(model.get(k) for k in ("dropout", "unk_token", "ignore_merges", "byte_fallback"))
        if model.get("type") != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or not plain:
            raise ValueError("only plain byte-level BPE vocabularies are read")
        vocabulary, byte_of = model["vocab"], byte_characters()
        if max(vocabulary.values()) >= _EDGE:
            raise ValueError("vocabulary too large for 16-bit symbols")
        self.first = np.zeros(256, np.int32)
        self.first[list(byte_of.values())] = [vocabulary[c] for c in byte_of]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        pairs = [(vocabulary[a], vocabulary[b]) for a, b in merges]
        self.rank_of = {pair: rank for rank, pair in enumerate(pairs)}
        self.merged_list = [vocabulary[a + b] for a, b in merges]
        self.merged, self.ranks = np.array(self.merged_list, np.int32), PairRanks(np.array(pairs, np.int64).reshape(-1, 2))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("only added tokens that match exactly are read")
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        tokens = vocabulary | self.special
        self.bytes_of = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.forget()

    def forget(self) -> None:
        """Forget all words met so far."""
        self.words, self.pool = _Slots(), _Pool()
        self.older, self.older_pool = _Slots(), _Pool()

    def merge(self, pieces: list[str], pool: _Pool) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in the pool of the ids of pre-tokens."""
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        begins = np.cumsum(sizes) - sizes
        starts, lengths = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        for i in np.flatnonzero(sizes > SHORT).tolist():
            ids = np.array(merge_alone(symbols[begins[i] : begins[i] + sizes[i]].tolist(), self.rank_of, self.merged_list), np.uint32)
            starts[i], lengths[i] = pool.add(ids), len(ids)
        low, width = 0, 2
        while low < SHORT:
            members = np.flatnonzero((sizes > low) & (sizes <= width))
            places = np.arange(width)
            for part in (members[i : i + AT_ONCE] for i in range(0, len(members), AT_ONCE)):
                held = places < sizes[part][:, None]
                table = np.full(held.shape, -1, np.int32)
                table[held] = symbols[(begins[part][:, None] + places)[held]]
                done = merge_side_by_side(table, self.ranks, self.merged)
                left = (done >= 0) & held
                lengths[part] = left.sum(axis=1)
                starts[part] = pool.add(done[left].astype(np.uint32)) + np.cumsum(lengths[part]) - lengths[part]
            low, width = width, 2 * width
        return starts, lengths

    def _learn(self) -> None:
        """Ids of the words noted since the last time."""
        words, pool, noted = self.words, self.pool, self.words.noted
        words.noted = []
        first = words.count - len(noted)
        numbers = np.arange(first, words.count)
        known = np.fromiter((self.older.get(w, -1) for w in noted), np.int64, len(noted))
        again = np.flatnonzero(known >= 0)
        lengths = self.older_pool.lengths[known[again]]
        start = pool.add(self.older_pool.runs(self.older_pool.starts[known[again]], lengths))
        pool.set(numbers[again], start + np.cumsum(lengths) - lengths, lengths)

        new = np.flatnonzero(known < 0)
        pieces: dict[str, int] = {}
        number = pieces.setdefault
        flat: list[int] = []
        counts: list[int] = []
        for i in new.tolist():
            word = noted[i]
            kind = word[0]
            if kind == _EXACT:
                parts = (word[1:],)
            else:
                bare = word[1:] if kind == _HEAD or kind == _LINE else word
                lead = "" if bare is not word else " "
                if bare.isalpha():
                    parts = (lead + bare,)
                elif bare[:-1].isalpha() and bare[-1] in _STOPS:
                    parts = (lead + bare[:-1], bare[-1])
                else:
                    parts = self.pattern.findall(lead + bare)
                if kind == _LINE:
                    parts = ("\n", *parts)
            flat += [number(p, len(pieces)) for p in parts]
            counts.append(len(parts))
        piece_starts, piece_lengths = self.merge(list(pieces), pool)
        parts, n_parts = np.array(flat, np.int64), np.array(counts, np.int64)
        firsts = np.cumsum(n_parts) - n_parts
        single = np.flatnonzero(n_parts == 1)
        pool.set(numbers[new[single]], piece_starts[parts[firsts[single]]], piece_lengths[parts[firsts[single]]])
        joint = np.flatnonzero(n_parts != 1)
        wanted = parts[np.repeat(n_parts != 1, n_parts)]
        lengths = np.add.reduceat(piece_lengths[wanted], np.cumsum(n_parts[joint]) - n_parts[joint]) if len(wanted) else np.zeros(0, np.int64)
        start = pool.add(pool.runs(piece_starts[wanted], piece_lengths[wanted]))
        pool.set(numbers[new[joint]], start + np.cumsum(lengths) - lengths, lengths)

    @staticmethod
    def regular(text: str) -> bool:
        """Whether all white space is single spaces and line feeds between other characters."""
        flat = text.replace("\n", " ")
        return flat != "" and flat[0] != " " and flat[-1] != " " and "  " not in flat and flat.isprintable()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as the tokenizers library gives them, special strings in texts as their tokens."""
        parts: list[str] = []  # between special tokens
        plan: list[list[int]] = []  # per text: numbers of parts, or -1 - id of a special token
        for text in texts:
            if self.special_pattern is None or not any(s in text for s in self.special):
                plan.append([len(parts)])
                parts.append(text)
                continue
            at, steps = 0, []
            for match in self.special_pattern.finditer(text):
                steps += [len(parts), -1 - self.special[match.group()]]
                parts.append(text[at : match.start()])
                at = match.end()
            plan.append([*steps, len(parts)])
            parts.append(text[at:])
        done = self._parts(parts)
        return [done[steps[0]] if len(steps) == 1 else b"".join(done[s] if s >= 0 else (-1 - s).to_bytes(4, "little") for s in steps) for steps in plan]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Pre-tokens never reach across a single space or line feed between other characters, so the words of regular texts stand alone."""
        if self.words.count > WORDS_KEPT:  # words not met again since the last time go
            self.older, self.older_pool = self.words, self.pool
            self.words, self.pool = _Slots(), _Pool()
        slots: list[np.ndarray] = []
        for text in parts:
            if self.regular(text):
                words = text.replace("\n", " \n").split(" ")
                words[0] = _HEAD + words[0]
            else:
                words = [_EXACT + p for p in self.pattern.findall(text)]
            slots.append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
        noted = self.words.noted
        self._learn()
        numbers = np.concatenate([np.zeros(0, np.int64), *slots])
        lengths = self.pool.lengths[numbers]
        data = self.pool.runs(self.pool.starts[numbers], lengths).astype("<u4").tobytes()
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum([0, *map(len, slots)])] * 4
        for word in noted:
            if len(word) > SHORT:  # memory is bounded in bytes, too
                del self.words[word]
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids; bytes that are no UTF-8 become replacement characters. Unknown ids give nothing."""
        numbers = np.frombuffer(ids, "<u4")
        known = numbers[numbers < len(self.bytes_of)]
        text = b"".join(map(self.bytes_of.__getitem__, known.tolist()))
        return text.decode("utf-8", "replace").encode()


def in_portions(texts: list[str]) -> Iterator[list[str]]:
    """Texts in portions of bounded length, or one longer text: new words of a portion are merged together."""
    begin = length = 0
    for i, text in enumerate(texts):
        if i > begin and length + len(text) > CHARS_AT_ONCE:
            yield texts[begin:i]
            begin, length = i, 0
        length += len(text)
    yield texts[begin:]


_LOADED: dict[str, BytePairs] = {}


def _forget() -> None:
    for pairs in _LOADED.values():
        pairs.forget()


HELD.append(_forget)


def byte_pairs(tokenizer_file: str) -> BytePairs:
    """The vocabulary, loaded once in each worker; its words are remembered for one task."""
    if tokenizer_file not in _LOADED:
        _LOADED.clear()
        _LOADED[tokenizer_file] = BytePairs(tokenizer_file)
    return _LOADED[tokenizer_file]


def encode_documents(docs: DataFrame, tokenizer_file: str, decode: bool = False) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every row, and with ``decode`` the text those ids give back.

    Null and empty texts have no ids and decode to the empty text. Repeated rows and rows without
    doc_id give a row each; other columns, whatever their names, are not looked at. No rows: no result.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = byte_pairs(tokenizer_file)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids = [x for some in in_portions(texts) for x in pairs.encode(some)]
        columns = [batch.column(0), pa.array(ids, pa.binary())]
        if decode:
            columns.append(pa.array(map(pairs.decode, ids), pa.binary(), size=len(ids)).cast(pa.string()))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids binary" + (", decoded string" if decode else ""))


def decode_ids(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """doc_id and decoded text of rows of doc_id and ids; null ids decode to the empty text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = byte_pairs(tokenizer_file)
        texts = pa.array([pairs.decode(x or b"") for x in batch.column(1).to_pylist()], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, decoded string")
