"""Token counts by dynamic programming over prefixes.

A piece vocabulary with merges by score has one encoding for every text, and
that encoding is the only sequence of pieces in which each neighbouring pair
encodes back to itself. So the last piece of a prefix follows from the last
pieces of the shorter prefixes: it is the piece ending there that is
compatible with the last piece before it. One pass over a word gives the exact
token count of each of its prefixes; no piece spans the white space between
words, so counts of words add up. Truncation and budget questions are then
answered from the stored counts, without encoding anything again.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from martkit.llm.frames import map_batches

SPACE = "▁"
UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
LIMIT = 4096
WORDS_KEPT = 400_000
PAIRS_KEPT = 1_500_000


class PrefixCounter:
    """Exact token counts of every prefix, as the library counts for the model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        odd = [self.model.is_unknown(i) or self.model.is_control(i) or self.model.is_byte(i) for i in range(len(pieces))]
        self.pieces = {piece: i for i, piece in enumerate(pieces) if not odd[i]}
        self.names = pieces
        self.reach: dict[str, int] = {}  # longest piece that ends in these two characters
        for piece in self.pieces:
            self.reach[piece[-2:]] = max(self.reach.get(piece[-2:], 0), len(piece))
        self.totals: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.pairs: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces encode back to themselves."""
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        # The line feed has no piece and keeps the library's own leading space away.
        known = self.model.encode("\n" + self.names[left] + self.names[right])[2:] == [left, right]
        self.pairs[left << 20 | right] = known
        return known

    def word_counts(self, word: str) -> list[int]:
        """Token count of every prefix of one word (with the white space before it)."""
        counts, last = [0], [-1]
        pieces, reach, pairs = self.pieces.get, self.reach.get, self.pairs.get
        for end in range(1, len(word) + 1):
            far = reach(word[end - 2 : end], 1) if end > 1 else 1
            for begin in range(max(0, end - far), end):
                piece = pieces(word[begin:end])
                if piece is None:
                    continue
                left = last[begin]
                if left >= 0:
                    fits = pairs(left << 20 | piece)
                    if fits is None:
                        fits = self.compatible(left, piece)
                    if not fits:
                        continue
                counts.append(counts[begin] + 1)
                last.append(piece)
                break
            else:  # a character without a piece of its own becomes its bytes
                counts.append(counts[-1] + len(word[end - 1].encode()))
                last.append(-1)
        return counts

    @staticmethod
    def units(text: str) -> list[str]:
        """The words of a text, each with the white space before it."""
        if not text:
            return []
        words = text.split(" ")
        if SPACE in text or "" in words:
            return UNITS.findall(SPACE + text.replace(" ", SPACE))
        return [SPACE + w for w in words]

    def unit_totals(self, units: list[str]) -> list[int]:
        """Token count of each word."""
        if len(self.totals) >= WORDS_KEPT:  # words not met again since the last time go
            self.older, self.totals = self.totals, {}
        totals, older = self.totals, self.older
        for word in set(units).difference(totals):
            known = older.get(word)
            totals[word] = self.word_counts(word)[-1] if known is None else known
        return [totals[u] for u in units]

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of every prefix of the text, the empty one first."""
        units, out, base = self.units(text), [0], 0
        for i, unit in enumerate(units):
            counts = self.word_counts(unit)
            out += [base + c for c in counts[2 if i == 0 else 1 :]]  # the first white space is the library's own
            base += counts[-1]
        return out

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most so many tokens."""
        units = self.units(text)
        ends = list(accumulate(self.unit_totals(units), initial=0))
        whole = bisect_right(ends, budget) - 1  # so many whole words fit
        chars = max(0, sum(map(len, units[:whole])) - 1)
        if whole < len(units):
            counts = self.word_counts(units[whole])
            more = max(i for i, c in enumerate(counts) if ends[whole] + c <= budget)
            chars += max(0, more - (whole == 0))
        return chars


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int = LIMIT) -> DataFrame:
    """Token count of every text, and how much of it fits a limit.

    Result per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit,
    fit_chars (characters of the longest prefix within the limit). Null and
    empty texts have no tokens. Rows are counted alone, repeated ones too.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine, sizes, tokens, fits = counter(model_file), [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            n = sum(machine.unit_totals(machine.units(text)))
            sizes.append(len(text.encode()))
            tokens.append(n)
            fits.append(machine.fit(text, limit) if n > limit else len(text))
        over = [n > limit for n in tokens]
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over), pa.array(fits, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
