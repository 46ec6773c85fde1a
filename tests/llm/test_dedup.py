"""Near copies, repeated bytes and components against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martkit.llm import nearcopies, queries, repeats, suffixes
from martkit.llm.frames import Workspace
from martkit.llm.graph import components, extended
from tests.llm.conftest import SF

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_links(texts):
    sets, parent, owners = {}, {i: i for i in texts}, defaultdict(list)
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
        for s in sets[i]:
            owners[s].append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        common = defaultdict(int)
        for s in sets[i]:
            for j in owners[s]:
                common[j] += j < i
        for j, n in common.items():
            if j < i and 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def brute_repeats(texts, length=100):
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(bool(gone[k]) and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def read(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def test_near_copies(docs, texts, no_docs):
    want = brute_links(texts)
    rows = nearcopies.near_copies(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]]
    assert nearcopies.near_copies(no_docs).collect() == []


def test_near_copies_without_id(spark):
    rows = nearcopies.near_copies(spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (2, "A b c d")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in rows) == [(-1, -1, False), (2, 2, True), (4, 2, False)]


def test_near_copies_query(spark):
    want = brute_links(read(spark, SF))
    rows = queries.op3_near_copies(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == want


def test_blocks_join_all_that_can_be_joined(spark):
    """Groups of several blocks: equal bits join all components of a group, of another one none; full sets have the last word."""
    rng = np.random.default_rng(3)
    bits = [nearcopies.packed(rng.integers(0, 1 << 63, nearcopies.BANDS * nearcopies.ROWS, dtype=np.uint64)).tobytes() for _ in range(3)]
    rows = [(i % 2, i, i if i % 5 else 0, 100, bits[i % 2]) for i in range(2600)]
    kind = "key long, node long, component long, n long, bits binary"
    members = spark.createDataFrame(rows, kind)
    links = nearcopies._links_across(members, "key", 85)
    known = members.select(F.col("node").alias("a"), F.col("component").alias("b"))
    got = {r["node"]: r["component"] for r in components(links.unionByName(known), Workspace(spark, "t")).collect()}
    assert {r["a"] % 2 == r["b"] % 2 for r in links.collect()} == {True}
    assert all(got.get(i, i) == 0 for i in range(2600))  # component 0 is in both groups
    odd = spark.createDataFrame([(9, i, i, 100, bits[2]) for i in range(700)] + [(9, 1000, 1000, 80, bits[2])], kind)
    full = odd.withColumn("shingles", F.when(F.col("node") % 2 == 0, F.lit(np.arange(100, dtype=np.uint64).tobytes())).otherwise(F.lit(np.arange(50, 150, dtype=np.uint64).tobytes())))
    got = {r["node"]: r["component"] for r in components(nearcopies._links_across(full, "key", 85), Workspace(spark, "t")).collect()}
    assert got == {i: i % 2 for i in range(2, 700)}


def test_estimate_is_unbiased():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        a = rng.integers(1, 1 << 63, 4000, dtype=np.uint64)
        n = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate((a[:n], rng.integers(1, 1 << 63, 4000 - n, dtype=np.uint64))))
        got = nearcopies.estimate(nearcopies.packed(nearcopies.minima(np.unique(a))), nearcopies.packed(nearcopies.minima(b)))
        assert abs(float(got) - share) < 0.15


def test_repeated_bytes(docs, texts, no_docs):
    want = brute_repeats(texts)
    # Small limits lead every group through the ways for hot ones as well.
    for shard, many in ((repeats.SHARD_BYTES, repeats.MANY_CONTEXTS), (2000, 1), (300, 10_000), (200, 1)):
        rows = repeats.repeated_bytes(docs, shard, many).collect()
        assert len(rows) == len(texts) + 1
        for r in rows:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], (r["doc_id"], shard, many)
    assert repeats.repeated_bytes(no_docs).collect() == []


def test_repeated_bytes_query(spark):
    rows = queries.op4_repeated_bytes(spark, SF).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == brute_repeats(read(spark, SF))


def test_a_gram_of_most_documents_is_split(spark):
    """A header stands in all documents, in as many contexts: its anchors are dealt over tasks, and results stay exact."""
    rng = random.Random(9)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    header = "-- a common header, of seventy letters or more, stands above every page --"
    passage = own(130)
    texts = {i: own(90) + header + own(90) + (passage if i % 50 == 7 else "") for i in range(3000)}
    texts |= {5000 + i: texts[3 * i] for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    anchored = repeats._anchor_rows(docs).cache()
    hottest = anchored.groupBy("gram").count().agg(F.max("count")).first()[0]
    assert repeats.hot_keys(anchored, ["gram"]).count() > 0 and hottest > 1000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = repeats._settle(anchored).where("gram is not null").withColumn("task", F.spark_partition_id()).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    top = Counter(r["gram"] for r in rows).most_common(1)[0][0]
    assert len({r["task"] for r in rows if r["gram"] == top}) > 2
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.repeated_bytes(docs).collect()}
    assert got == brute_repeats(texts)
    anchored.unpersist()


def test_equal_parts_of_a_group_are_led_on_once(spark, monkeypatch):
    """A line of almost a whole string, in many contexts: each round leads on the distinct parts, not a copy for each document."""
    rng = random.Random(4)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = own(98)
    texts = {i: own(150) + rng.choice("xyz") + line + rng.choice("xyz") + own(150) for i in range(600)}
    docs = spark.createDataFrame([*texts.items(), (3, texts[3])], "doc_id long, text string").repartition(3)
    led, part = [], repeats._part
    monkeypatch.setattr(repeats, "_part", lambda large: led.append(large.count()) or part(large))
    rows = repeats.repeated_bytes(docs, 4000, 10).collect()
    want = brute_repeats(texts)
    assert len(rows) == 601 and all((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]] for r in rows)
    assert sum(n for _, n, _, _ in want.values()) > 500 * 100 and len(led) > 2 and sum(led) < 7 * len(texts)  # 4333 of at most 4200 when equal parts are all led on, 3540 now


def test_without_repeats_keeps_characters_whole(spark):
    rng = random.Random(2)
    shared = "".join(rng.choice("äöüß€") for _ in range(90))
    df = spark.createDataFrame([(1, "é" + shared + "a", 0), (2, "x" + shared + "ñ", 0), (None, shared, 0)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in repeats.without_repeats(df).collect()}
    assert got == {1: ("é" + shared + "a", 92), 2: ("xñ", 2), None: (shared, 90)}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200).map(lambda b: bytes(97 + c % 3 for c in b)), st.sampled_from([2, 1024]))
def test_suffix_array(data, small):
    keep, suffixes.SMALL_ALPHABET = suffixes.SMALL_ALPHABET, small
    try:
        array = suffixes.suffix_array(np.frombuffer(data, np.uint8))
    finally:
        suffixes.SMALL_ALPHABET = keep
    assert array.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    prefix = suffixes.common_prefixes(np.frombuffer(data, np.uint8), array, np.zeros(min(1, len(data)), np.int64), 256)
    for a, b in zip(array[:-1], array[1:]):
        n = next((k for k in range(len(data)) if data[a + k : a + k + 1] != data[b + k : b + k + 1] or b + k >= len(data)), 0)
        assert prefix[b] == n


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 5)] + [(rng.randrange(40), rng.randrange(40)) for _ in range(30)] + [(0, i) for i in range(200, 260)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def test_components_take_no_needless_rounds(spark):
    """Edges that are stars already take no round, and without more links the components stay as they are."""
    work = Workspace(spark, "t")
    parts = components(spark.createDataFrame([(1, 2), (3, 1), (7, 9), (4, 4)], "a long, b long"), work)
    assert work.made == 1 and {tuple(r) for r in parts.collect()} == {(2, 1), (3, 1), (9, 7)}
    assert extended(parts, spark.createDataFrame([], "a long, b long"), work) is parts and work.made == 1
    more = work.put(spark.createDataFrame([(9, 3), (5, 6)], "a long, b long"))
    assert {tuple(r) for r in extended(parts, more, work).collect()} == {(2, 1), (3, 1), (7, 1), (9, 1), (6, 5)}
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long")
    assert {tuple(r) for r in components(chain, Workspace(spark, "t")).collect()} == {(i, 0) for i in range(1, 51)}


@pytest.mark.parametrize("text", [b"", b"a", b"a b", b"A B c d"])
def test_shingles(text):
    assert len(nearcopies.shingle_set(text)) == {0: 0, 1: 1, 2: 1, 4: 2}[len(text.split())]
