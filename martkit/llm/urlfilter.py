"""URL filters: many wildcard rules simulated at once over every canonical URL.

All rules are packed into the bits of a few machine words (Shift-And). A rule
is a sequence of positions; position i may follow position i - 1 when the
current byte is in its class, and a wildcard position also stays where it is.
One step of the automaton moves every rule over one byte of every URL of the
batch: ``D = ((D << 1) | start) & accepts[byte] | D & loops[byte]``.

In a rule ``*`` stands for any bytes within the host (no ``/``) and ``**``
for any bytes at all; everything else stands for itself. A rule must cover
the whole canonical URL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import blobs, map_batches

# Production rules: (verdict, host, path). A rule fits its host and all subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# The method's own globs for hosts to block where no rule speaks; all other URLs are allowed.
BLOCKED_HOSTS = tuple(f"*{word}*{path}" for word in ("casino", "free-bets", "cheap-pills", "ads-track") for path in ("", "/**"))
WORD = 64


def host_rule(host: str, path: str) -> str:
    """The glob for a host with all its subdomains, below a path prefix."""
    return f"*.{host}{path}**"


@dataclass
class Automaton:
    """Shift-And masks for a list of globs over canonical URLs (``.host/path``)."""

    globs: tuple[str, ...]
    accepts: np.ndarray = field(init=False)
    loops: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)
    finals: list[list[int]] = field(init=False)

    def __post_init__(self) -> None:
        cells: list[tuple[str, int]] = []  # (kind, rule)
        first, self.finals = [], []
        for rule, glob in enumerate(self.globs):
            at = len(cells)
            # One position per literal byte; a wildcard is a position that loops and can be passed without a byte.
            for part in re.findall(rb"\*\*|\*|[^*]", glob.encode(), re.S):
                cells.append((part.decode("latin-1"), rule))
            cells.append(("", rule))  # reached after the last byte
            first.append(at)
            self.finals.append([at, len(cells) - 1])
        n_words = max(1, -(-len(cells) // WORD))
        self.accepts = np.zeros((256, n_words), np.uint64)
        self.loops = np.zeros((256, n_words), np.uint64)
        self.start = np.zeros(n_words, np.uint64)
        self.skips = np.zeros(n_words, np.uint64)
        self.deepest = 0
        for i, (kind, _) in enumerate(cells):
            word, bit = i // WORD, np.uint64(1) << np.uint64(i % WORD)
            if kind in ("*", "**"):
                self.skips[word] |= bit
                for byte in range(256):
                    if kind == "**" or byte != 47:
                        self.loops[byte, word] |= bit
            elif kind:
                self.accepts[ord(kind), word] |= bit
        for at in first:
            self.start[at // WORD] |= np.uint64(1) << np.uint64(at % WORD)
        # Runs of wildcards need as many empty moves.
        self.deepest = max((len(m) for g in self.globs for m in re.findall(r"(?:\*+)", g)), default=0)

    def _ahead(self, state: np.ndarray) -> np.ndarray:
        out = state << np.uint64(1)
        out[:, 1:] |= state[:, :-1] >> np.uint64(WORD - 1)
        return out

    def _close(self, state: np.ndarray) -> np.ndarray:
        for _ in range(self.deepest):
            state = state | self._ahead(state & self.skips)
        return state

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """A boolean row for each URL, a column for each rule."""
        order = np.argsort([-len(u) for u in urls], kind="stable")
        lengths = np.array([len(urls[i]) for i in order], np.int64)
        result = np.zeros((len(urls), len(self.globs)), bool)
        if not len(urls):
            return result
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(urls[i] for i in order), np.uint8)
        begins = ends - lengths
        # A bit stands for "the next byte is read here": the state before the first byte is the rules' first positions.
        state = self._close(np.repeat(self.start[None, :], len(urls), axis=0))
        live = len(urls)
        for step in range(int(lengths[0])):
            live = int(np.searchsorted(-lengths, -step, "left"))  # URLs longer than this step come first
            now = state[:live]
            byte = data[begins[:live] + step]
            state[:live] = self._close(self._ahead(now & self.accepts[byte]) | now & self.loops[byte])
        for rule, (_, last) in enumerate(self.finals):
            result[order, rule] = (state[:, last // WORD] >> np.uint64(last % WORD)) & np.uint64(1) != 0
        return result


def canonical_parts(url: str = "url") -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` and for null."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    raw_host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(raw_host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.substr(rest, F.length(raw_host) + 1), r"^([^?#]*)", 1)
    return host, path


def judge_urls(pages: DataFrame, rules=RULES, blocked=BLOCKED_HOSTS, key: str = "page_id", url: str = "url") -> DataFrame:
    """Verdict on each URL.

    The rule with the longest text that fits decides; among URLs without one,
    hosts that fit a blocked glob are blocked and all others allowed. Rows are
    judged alone, so repeated rows, ties and an empty table need no care; a
    null or malformed URL has empty host and path and is allowed.
    Result: key, host, path, rule (null if none), verdict.
    """
    names = [host + path for _, host, path in rules]
    by_length = sorted(range(len(rules)), key=lambda i: (-len(names[i]), names[i]))
    host, path = canonical_parts(url)
    parts = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    machine = Automaton(tuple(host_rule(h, p) for _, h, p in rules) + tuple(blocked))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, paths = blobs(batch.column(1)), blobs(batch.column(2))
        hits = machine.matches([b"." + h + p for h, p in zip(hosts, paths, strict=True)])
        found, verdicts = [], []
        for row in hits:
            rule = next((i for i in by_length if row[i]), None)
            found.append(None if rule is None else names[rule])
            verdicts.append(rules[rule][0] if rule is not None else "block" if row[len(rules) :].any() else "allow")
        columns = [*batch.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    key_type = pages.schema[key].dataType.simpleString()
    return map_batches(parts, run, f"page_id {key_type}, host string, path string, rule string, verdict string")
