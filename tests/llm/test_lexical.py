"""Ranked search against a plain scan of all documents for every item."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from martkit.llm import lexical
from tests.llm.conftest import SF

LOWER = {c: c + 32 for c in range(65, 91)}
ITEM = "item_id long, text string, doc_id string, score double"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=20):
    """docs and items: (id, text) pairs."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = {}
    for item, query in asked.items():
        scored = []
        for i, c in counts:
            if i is None or not c:
                continue
            m = 75 + (25 * sum(c.values()) * n_docs) // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in query.items() if c[t])
            if score > 0:
                scored.append((-score, i))
        out[item] = [(r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return {i: x for i, x in out.items() if x}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {i: sorted(x) for i, x in out.items()}


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def test_given_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert found(lexical.search(docs, items)) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


@pytest.fixture(scope="module")
def items(spark, texts):
    asked = [(1, texts[20], "d", 1.0), (2, "  ", None, None), (3, None, None, None), (4, "a A a b ß", None, None), (4, "x y", None, None), (None, texts[40], None, None), (5, "nowhere", None, None), (6, "xy" * 40, None, None), (7, texts[len(texts) - 1], None, None)]
    return spark.createDataFrame(asked, ITEM)


@pytest.mark.parametrize("blocks", [2048, 3])
def test_odd_rows(spark, docs, items, monkeypatch, blocks):
    """Small blocks cut a stratum over many rows of the index; results stay the same."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", blocks)
    some = docs.unionByName(spark.createDataFrame([(None, "a a ab x y", None, None, None, None, None, None)], docs.schema))
    want = brute(pairs(some, "doc_id"), pairs(items, "item_id"))
    assert found(lexical.search(some, items)) == want and None in want
    assert found(lexical.search(some, items, query_limit=60)) == want
    assert found(lexical.search(some, items, k=2)) == brute(pairs(some, "doc_id"), pairs(items, "item_id"), 2)


def test_empty_tables(spark, docs, no_docs, items):
    assert lexical.search(no_docs, items).collect() == [] and lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.where("text is null or text = ' '"), items).collect() == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PORTION", 10)
    text = "Ab cd-efghijklmnopq rs é tu " * 9 + "x" * 40
    assert [w.decode() for p in lexical.portions(text.encode()) for w in p] == terms(text)


def test_copies_in_one_stratum(spark):
    """A third of all documents are one text: one stratum, many blocks, ties by id."""
    docs = spark.range(9000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'alpha beta gamma' else concat('alpha w', id, ' beta', repeat(' z', int(id % 7))) end as text")
    items = spark.createDataFrame([(1, "gamma"), (2, "alpha z z"), (3, "w5 w7 beta")], "item_id long, text string")
    assert found(lexical.search(docs, items)) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_bounds_hold_and_skip():
    """No document scores above its block's bound, and a floor above the bound asks for no visit."""
    rng = np.random.default_rng(4)
    rows = [{"item_id": q, "term": b"t%d" % t, "count": int(rng.integers(1, 4))} for q in range(30) for t in rng.choice(40, 6, False)]
    queries = lexical.Queries.of(rows)
    queries.weights = rng.integers(0, 9000, len(queries.vocabulary))
    terms_ = [np.sort(rng.choice(len(queries.vocabulary), 9, False)).astype(np.int32) for _ in range(200)]
    block = lexical._block(7, 130, list(range(200)), terms_, [rng.integers(1, 9, 9).astype(np.int32) for _ in terms_])
    row = dict(zip(lexical._NAMES, block, strict=True))
    bounds = queries.bounds(row["m"], row["heads"], row["peaks"])
    got = {q: (d, s) for q, d, s in lexical.score_block(row, queries, np.arange(30), np.zeros(30, np.int64), 200)}
    assert all(s.max() <= bounds[q] for q, (_, s) in got.items()) and len(got) > 20
    high = list(lexical.score_block(row, queries, np.arange(30), bounds + 1, 200))
    assert high == []
