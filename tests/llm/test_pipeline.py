"""The pipeline's stages, each against what it should keep of its own input."""

import random

import __spark_entry__ as entry
import corpus_pipeline
from martkit.llm import decontaminate, nearcopies, queries, quality
from tests.llm.conftest import SF
from tests.llm.test_dedup import brute_repeats
from tests.llm.test_texts import check_packing


def test_registered():
    found = entry.queries()
    assert set(queries.QUERIES) <= set(found) and found["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_on_odd_rows(spark, docs, no_docs, tmp_path):
    for some, folder in ((docs, "odd"), (no_docs, "none")):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, some, SF).write.parquet(f"{tmp_path}/{folder}{number}")
            some = spark.read.parquet(f"{tmp_path}/{folder}{number}")
            if number < 4:
                assert some.columns == docs.columns
            if folder == "odd" and number == 0:
                some = docs
        assert (some.count() == 0) == (folder == "none")
    assert nearcopies.near_copies(docs).count() == docs.count()


def kept_of_near_copies(texts, size=5, percent=80):
    """Smallest id of each group of near copies, by all pairs."""
    words = {i: t.lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} for i, w in words.items()}
    group = {i: i for i in texts}
    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    return {i for i, g in group.items() if g == i}


def test_near_copies_of_the_stage(spark):
    """Block edits of 15 to 25 parts in a hundred, and scattered edits that only shorter shingles bear."""
    rng, texts = random.Random(8), {}
    for base in range(12):
        own = [f"b{base}x{rng.randrange(10**6)}" for _ in range(400)]
        block = [f"n{base}y{k}" for k in range(60 + 5 * base)]
        scattered = list(own)
        for k in range(20, 380, 380 // (base + 8)):
            scattered[k] = f"s{base}z{k}"
        for n, w in enumerate((own, own + block, own[: 400 - len(block)], own[:200] + block + own[200:], scattered)):
            texts[10_000 * n + 10 * base] = " ".join(w)
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    want = kept_of_near_copies(texts)
    assert want != kept_of_near_copies(texts, 3, 85) and len(want) < len(texts)
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()} == want


def test_bands_follow_the_limit():
    assert [nearcopies.bands_for(p) for p in (100, 85, 80)] == [1, 28, 44]


def test_stages(spark, tmp_path):
    """All stages in turn, each against what it should keep of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        texts = {i: r["text"] for i, r in before.items()}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        rows = after.collect()
        if number < 4:
            assert after.columns == docs.columns
        if number == 0:
            good = {r["doc_id"] for r in quality.judge_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["predicted"]}
            assert {r["doc_id"] for r in rows} == good and 0 < len(good) < len(before)
        if number == 1:
            assert {r["doc_id"] for r in rows} == kept_of_near_copies(texts)
        if number == 2:
            want = brute_repeats(texts)
            assert {r["doc_id"] for r in rows} == set(texts)
            for r in rows:
                assert 0 <= len(r["text"].encode()) - (want[r["doc_id"]][0] - want[r["doc_id"]][1]) <= 6 * want[r["doc_id"]][2] and r["n_chars"] == len(r["text"])
        if number == 3:
            hit = {r["doc_id"] for r in decontaminate.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect() if r["n_hit"]}
            assert {r["doc_id"] for r in rows} == set(before) - hit
        if number == 4:
            check_packing(rows, texts)
        docs = after
    assert corpus_pipeline.run(spark, SF).count() == len(rows)
