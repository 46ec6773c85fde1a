"""License scans through a positional index of rare words.

Each template is indexed by the rarest words of its own mandatory key phrase
(highest inverse document frequency over all documents): postings of (template,
position). Each occurrence of such a word in a file proposes where the key phrase
would begin, and proposals that agree are counted. Where all words of a template
agree and the key phrase stands there, the template is reported, whatever other
words the file has, and aligned with the words around.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import alnum_words, blobs, map_batches

# Fixed phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# The method's own templates: label, notice text, mandatory key phrase.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
)
RAREST = 2  # words of each template's key phrase that are looked up


class LicenseIndex:
    """Postings of the templates' words, with the words' document frequencies."""

    def __init__(self, frequency: dict[bytes, int], n_docs: int, templates=TEMPLATES, base=BASE, rarest: int = RAREST):
        self.templates = [(label, alnum_words(text.encode()), alnum_words(key.encode())) for label, text, key in templates]
        self.base = [(alnum_words(phrase.encode()), label) for phrase, label in base.items()]
        self.idf = {w: math.log((1 + n_docs) / (1 + frequency.get(w, 0))) + 1 for _, words, key in self.templates for w in words + key}
        self.rarest = rarest
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed: list[int] = []  # agreeing words at a place of each key phrase
        for number, (_, _, key) in enumerate(self.templates):
            chosen = {w for _, w in sorted((-self.idf[w], w) for w in set(key))[: self.rarest]}
            self.needed.append(sum(w in chosen for w in key))
            for position, word in enumerate(key):
                if word in chosen:
                    self.postings[word].append((number, position))

    def base_places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Start and label of every place of a base phrase."""
        found = []
        for phrase, label in self.base:
            rarest = max(range(len(phrase)), key=lambda i: (self.idf.get(phrase[i], 0.0), len(phrase[i])))
            at = -1
            for _ in range(words.count(phrase[rarest])):
                at = words.index(phrase[rarest], at + 1)
                first = at - rarest
                if first >= 0 and words[first : first + len(phrase)] == phrase:
                    found.append((first, label))
        return found

    def template_scores(self, words: list[bytes]) -> dict[str, float]:
        """Best share of each template's idf weight that stands in its place, where its key phrase does."""
        votes: Counter[tuple[int, int]] = Counter()
        for at, word in enumerate(words):
            for number, position in self.postings.get(word, ()):
                votes[number, at - position] += 1
        best: dict[str, float] = {}
        for (number, first), n in votes.items():
            label, template, key = self.templates[number]
            if n < self.needed[number] or first < 0 or words[first : first + len(key)] != key:
                continue
            # Words may be left out or put in between the key phrase and the rest, so every place around is aligned.
            share = max(self.share(template, words, start) for start in range(first - len(template), first + len(key) + 1))
            best[label] = max(best.get(label, 0.0), share)
        return best

    def share(self, template: list[bytes], words: list[bytes], start: int) -> float:
        there = sum(self.idf[w] for i, w in enumerate(template) if 0 <= start + i < len(words) and words[start + i] == w)
        return there / sum(self.idf[w] for w in template)

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, all labels, score."""
        words = alnum_words(text)
        places = self.base_places(words)
        scores = {} if self.postings.keys().isdisjoint(words) else self.template_scores(words)
        base = {label for _, label in places}
        score = 1.0 if base else max(scores.values(), default=0.0)
        starts = [at for at, _ in places]
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(scores))), min(1.0, score)


def word_frequencies(docs: DataFrame, words: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many of all documents each word of a fixed vocabulary stands, and the number of documents."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[bytes] = Counter()
        for text in blobs(batch.column(0)):
            counts.update(words.intersection(alnum_words(text)))
        counts[b""] = batch.num_rows
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    totals = map_batches(docs.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in totals.collect()}  # at most the vocabulary
    return found, found.pop(b"", 0)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE, rarest: int = RAREST) -> DataFrame:
    """License phrases and notices of every text.

    Result per row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score. The score is 1 with a base phrase, else the best share
    of a template found, else 0. Null and empty texts have no words, no labels
    and score 0. Rows are scanned alone, repeated ones too.
    """
    vocabulary = {w for _, text, key in templates for w in alnum_words(f"{text} {key}".encode())}
    shared = docs.sparkSession.sparkContext.broadcast(LicenseIndex(*word_frequencies(docs, vocabulary), templates, base, rarest))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = shared.value
        rows = [index.scan(text) for text in blobs(batch.column(1))]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
