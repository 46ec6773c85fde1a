"""Byte pairs against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from martkit.llm import bpe, frames, queries
from tests.llm.conftest import SF

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(FILE)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_byte_pairs(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, docs, no_docs, library):
    got = bpe.encode_documents(docs, FILE, decode=True).collect()
    assert len(got) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in got:
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert ids(r["ids"]) == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode_documents(no_docs, FILE, decode=True).collect() == []
    no_id = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(len(r["ids"]) for r in bpe.encode_documents(no_id, FILE).collect()) == [0, 8]
    again = bpe.decode_ids(bpe.encode_documents(docs, FILE), FILE).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in got)


def test_random_texts(pairs, library):
    rng = random.Random(1)
    parts = [*"abc ABC \n\t  'll's 12é漢🙂.,-  ᠎", "<|endoftext|>", "<|endo", "  ", "\n\n", " don't", "\r\n", " it's ", "ß" * 70]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(pairs.encode([text])[0]) == want
        assert pairs.decode(np.array(want, "<u4").tobytes()).decode() == library.decode(want, skip_special_tokens=False)


def test_every_basic_character(pairs, library):
    for low in range(0, 0x10000, 64):
        some = [f"a{c}b {c}{c} x{c} {c} '{c}" for c in map(chr, range(low, low + 64)) if not 0xD800 <= ord(c) < 0xE000]
        for text, got, want in zip(some, pairs.encode(some), library.encode_batch(some, add_special_tokens=False), strict=True):
            assert ids(got) == want.ids, text


def test_long_words(pairs, library):
    rng = random.Random(2)
    for text in ("a" * 65, "ab" * 5000, "".join(rng.choice("abcdefgh") for _ in range(200_000)), "é" * 3000, " " * 4000 + "x", "." * 9999):
        assert ids(pairs.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids
    assert all(len(w) <= bpe.SHORT for w in pairs.words)


def test_both_trees_give_the_plain_merges(pairs):
    """Side by side, alone, and by searching all pairs anew for the leftmost of the lowest rank."""
    rng = random.Random(3)
    for width in (2, 4, 8, 64):
        rows = [[rng.choice(pairs.first[list(b"theandio r")]) for _ in range(rng.randrange(1, width + 1))] for _ in range(40)]
        symbols = np.full((40, width), -1, np.int32)
        for i, row in enumerate(rows):
            symbols[i, : len(row)] = row
        together = bpe.merge_side_by_side(symbols, pairs.ranks, pairs.merged)
        for row, done in zip(rows, together, strict=True):
            plain = list(map(int, row))
            while found := [(pairs.rank_of[p], i) for i, p in enumerate(zip(plain[:-1], plain[1:], strict=True)) if p in pairs.rank_of]:
                rank, i = min(found)
                plain[i : i + 2] = [pairs.merged_list[rank]]
            assert done[: len(row)][done[: len(row)] >= 0].tolist() == plain == bpe.merge_alone(list(map(int, row)), pairs.rank_of, pairs.merged_list)


def test_memory_is_bounded(pairs, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 50)
    some = bpe.BytePairs(FILE)
    rng = random.Random(4)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(60)) for _ in range(3)]
        for got, want in zip(some.encode(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert ids(got) == want.ids
        assert len(some.words) <= 50 + 180 and some.pool.used <= (50 + 180) * 4


def test_a_worker_hands_back_its_memory_after_a_task(library):
    """Workers outlive tasks and stages: words and Arrow's free memory go with the task, and the next task gives the same ids."""

    class Frame:
        mapInArrow = staticmethod(lambda task, schema: task)

    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    task = frames.map_batches(Frame, lambda b: pa.RecordBatch.from_arrays([pa.array(bpe.byte_pairs(FILE).encode(b.column(0).to_pylist()))], ["ids"]), "ids binary")
    want = [w.ids for w in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        running = task([batch])
        assert [ids(x) for x in next(running).column(0).to_pylist()] == want
        assert bpe.byte_pairs(FILE).words.count > 10_000
        assert list(running) == []
        held = bpe.byte_pairs(FILE)
        assert not held.words and not held.older and not held.words.noted and held.pool.used == held.older_pool.used == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.BytePairs(public_tokenizers.path("word_bpe_49k.json"))
