"""Row-wise operators, packing, search and classifier against the libraries and brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from checks import compare
from martkit.llm import decontaminate, htmltext, licenses, neighbours, packing, quality, queries, tokencount, urlfilter
from tests.llm.conftest import SF

LOWER = {c: c + 32 for c in range(65, 91)}
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, duck, name):
    assert compare.difference(queries.QUERIES[name](spark, SF).toArrow(), compare.fetch_oracle(duck, queries.ORACLES[name])) is None


def test_urls(spark):
    urls = [None, "", "x", "http://COM/", "http://com", "https://a.b.Example.com/en/x?q#f", "https://www.example.com/en/1", "https://xexample.com/en/1", "ftp://y.net/fr/#a", "//a.net/es/",
            "http://m.casino-win.org/es", "http://cheap-pills.org", "http://é.net/es/x", "http://a.com/x.net/es/", "http://b.org/.net/es/", "http://user@a.com:80/en"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] * 2, "page_id long, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(df).collect()}
    none = ("", "", None, "allow")
    assert [got[i] for i in range(len(urls))] == [
        none, none, none, ("com", "/", "com/", "allow"), ("com", "", None, "allow"), ("a.b.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("xexample.com", "/en/1", "com/", "allow"), ("y.net", "/fr/", "net/fr/", "block"), none, ("m.casino-win.org", "/es", None, "block"), ("cheap-pills.org", "", None, "block"),
        ("é.net", "/es/x", "net/es/", "block"), ("a.com", "/x.net/es/", "com/", "allow"), ("b.org", "/.net/es/", None, "allow"), ("user@a.com:80", "/en", None, "allow"),
    ]
    assert urlfilter.judge_urls(df.limit(0)).collect() == []


def test_html_of_great_depth():
    """Work grows with the page, not with the square of its depth."""
    shapes = ("<div>t, ", "<form>t, ", "<b><div>", "<div></b>", "<div><li>x</li>", "<p><b><i>")
    for shape in shapes:
        begin = time.process_time()
        htmltext.extract(shape * 4_000)
        short = time.process_time() - begin
        begin = time.process_time()
        text = htmltext.extract(shape * 32_000 + "x")
        assert time.process_time() - begin < 24 * max(short, 0.05) and text
    deep = htmltext.extract("<div>" * 50_000 + "<p>A text, of a page, that is deep.</p><p>Another, like it, follows.</p>")
    assert deep == "A text, of a page, that is deep.\nAnother, like it, follows."


def test_html_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert htmltext.extract_pages(pages).collect() == []


def test_automaton_over_many_words():
    globs = tuple(f"*{i}x*/**y{i}" for i in range(40))
    machine = urlfilter.Automaton(globs)
    urls = [f".a{i}xb/c/y{j}".encode() for i in range(0, 45, 3) for j in range(0, 45, 4)] + [b"", b"/"]
    want = [[re.fullmatch(g.replace("**", ".!").replace("*", "[^/]*").replace(".!", ".*"), u.decode()) is not None for g in globs] for u in urls]
    assert machine.matches(urls).tolist() == want


def test_html(spark):
    page = (
        "<html><head><title>t</title><script>var a='<p>no</p>'</script><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>"
        '<div class="ad">Buy now, please, do it.</div><div class="content"><h1>A  title</h1><p><b>One, two &amp; three, four<br>five.<p>Six\n seven &eacute;&#8364;.<!-- <p>x</p> --><ul><li>eight</li></ul>'
        '<div class="comments"><p>Nice, really, very nice indeed, thanks.</p></div></div><div id="sidebar"><p>Other, stuff, here.</p></div><form><p>Mail?</p></form><footer>(c)</footer></body></html>'
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<nav>x</nav>"), (5, "u", "plain &lt;text&gt;"), (1, "u", page), (6, "u", "<p>cut of</")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in htmltext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = "A title\nOne, two & three, four five.\nSix seven é€.\neight"
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0), 4: ("", 0), 5: ("plain <text>", 12), 6: ("cut of", 6)}


@pytest.mark.parametrize("name", ["content has-sidebar", "overflow-hidden", "ad-free", "no-comments", "single-post related", "hidden", None])
def test_html_wrappers(name):
    """An article in a wrapper with unwanted words, or in a form round the page, is not lost."""
    article = ["A title", *(f"Sentence {i} of the article, with some words, and a few more of them." for i in range(4))]
    tag, attributes = ("div", f' class="{name}"') if name else ("form", "")
    inner = f"<h1>{article[0]}</h1>" + "".join(f"<p>{x}</p>" for x in article[1:])
    page = f'<body><nav>Home</nav><{tag}{attributes}>{inner}<div class="ad">Buy now, please.</div><div class="comments"><p>Nice, really.</p></div></{tag}><footer>(c)</footer></body>'
    assert htmltext.extract(page) == "\n".join(article)


def test_html_query(spark):
    """All the page generator's articles, without anything around them."""
    import html as codes

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op2_html_extraction(spark, SF).collect():
        article = re.sub(r"</?[a-z0-9]*$|<$", "", re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S)[1])
        blocks = (" ".join(codes.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b)


def brute_leaks(texts, items, window=10):
    out = {}
    for i, t in texts:
        w, hit, found = alnum(t), set(), set()
        for item, text in items:
            v = alnum(text)
            for k in range(max(1, len(v) - window + 1)) if v else ():
                part = v[k : k + window]
                for a in range(len(w) - len(part) + 1):
                    if w[a : a + len(part)] == part:
                        hit.update(range(a, a + len(part)))
                        found.add(str(item))
        out[i] = (len(w), len(hit), found)
    return out


def test_leaks(spark, docs, texts, no_docs):
    items = [(1, " ".join(alnum(texts[14])[20:45])), (2, "A"), (3, None), (4, "--"), (5, texts[-1 % len(texts)][500:800]), (5, "q"), (12, "éà  Ü")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(texts.items(), items)
    for chunk in (decontaminate.CHUNK_BYTES, 900):
        rows = decontaminate.find_leaks(docs, bench, chunk_bytes=chunk).collect()
        assert len(rows) == len(texts) + 1
        for r in rows:
            assert (r["n_words"], r["n_hit"], set(r["items"])) == want[r["doc_id"]]
        clean = decontaminate.keep_clean(docs, bench, chunk_bytes=chunk)
        assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, x in want.items() if not x[1]}
    assert decontaminate.find_leaks(no_docs, bench).collect() == []
    assert {r["n_hit"] for r in decontaminate.find_leaks(docs, bench.limit(0)).collect()} == {0}


def test_leaks_of_items_without_id(spark):
    """Their passages are hits like any other, only without a name."""
    passage = " ".join(f"p{i}" for i in range(12))
    bench = spark.createDataFrame([(None, passage), (None, None), (7, "q r s")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {passage} b"), (2, "a b c"), (3, f"q r s {passage}")], "doc_id long, text string")
    for chunk in (decontaminate.CHUNK_BYTES, 450):
        got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.find_leaks(docs, bench, chunk_bytes=chunk).collect()}
        assert got == {1: (12, []), 2: (0, []), 3: (15, ["7"])}
        assert [r["doc_id"] for r in decontaminate.keep_clean(docs, bench, chunk_bytes=chunk).collect()] == [2]


def test_leaks_query(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    windows = defaultdict(set)
    for item, text in items:
        v = alnum(text)
        for k in range(max(1, len(v) - 9)) if v else ():
            windows[tuple(v[k : k + 10])].add(str(item))
    sizes = sorted({len(w) for w in windows})
    for r in queries.op5_decontamination(spark, SF).collect():
        w, hit, found = alnum(dict(texts)[r["doc_id"]]), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= owners
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(w), len(hit), len(found), sha, bool(hit))


def test_one_item_of_many_texts_is_spread(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(60)]
    bench = spark.createDataFrame([("one", t) for t in texts], "item_id string, text string")
    chunks = list(decontaminate.benchmark_chunks(bench, 10, 20_000))
    assert len(chunks) > 2 and [last for _, last in chunks] == [False] * (len(chunks) - 1) + [True]
    assert sorted(t.decode() for items, _ in chunks for _, t in items) == sorted(texts) and max(len(items) for items, _ in chunks) < 40
    docs = spark.createDataFrame([(0, "clean words only"), (1, f"a {texts[5]} b {texts[40]} c")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.find_leaks(docs, bench, chunk_bytes=20_000).collect()}
    assert got == {0: (0, []), 1: (24, ["one"])}


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BPE)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts.items():
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        at = 0
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert all(r["length"] == 2048 for r in own[1:]) and len(own) == -(-len(ids) // 2048)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r["length"] for r in rows) / 2048


def test_packing(spark, docs, texts, no_docs):
    unique = docs.dropDuplicates(["doc_id"])
    check_packing(packing.pack_documents(unique, BPE).collect(), texts)
    check_packing(packing.pack_documents(unique, BPE, open_sequences=2).collect(), texts)
    assert packing.pack_documents(no_docs, BPE).collect() == []
    assert packing.pack_documents(docs, BPE).where("doc_id = 3").count() == 2
    r = packing.pack_documents(unique, BPE, keep_ids=True).where("doc_id = 14 and piece = 0").first()
    assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


def test_packing_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sequences, least = check_packing(queries.op6_packing(spark, SF).collect(), texts)
    assert sequences <= least * 1.15


def test_packing_does_not_get_worse_with_size(spark):
    """Far more pieces than the open sequences of the shuffle partitions can take."""
    rng, n = np.random.default_rng(6), int(spark.conf.get("spark.sql.shuffle.partitions"))
    lengths = rng.choice([51, 53, 56, 60, 44, 40, 30, 20, 12, 5], 3_000 * n).tolist()
    pieces = spark.createDataFrame([(i, 0, 0, x, 0) for i, x in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(pieces, capacity=100, open_sequences=250).collect()
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(r["length"] for r in rows) == sorted(lengths)
    for own in places.values():
        ends = np.cumsum([0, *(x for _, x in sorted(own))])
        assert [a for a, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= 100
    free = packing.Packer(100, len(lengths))  # no sequence ever closes early
    for x in sorted(lengths, reverse=True):
        free.place(x)
    assert free.made <= len(places) <= 1.03 * free.made


def test_fullest_closes_first():
    packer = packing.Packer(10, 2)
    assert [packer.place(n) for n in (6, 7, 9, 4, 3, 1, 10)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0), (2, 9), (4, 0)]


def brute_neighbours(rows, every, k):
    usable = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in usable if j != i)
            out[i] = near[:k]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)] + [(i, [1.0] * 6) for i in range(400, 900)]
    rows += [(1000, None), (1100, [0.0] * 6), (1200, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1300, [float("nan")] * 6), (1400, [float("inf")] + [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("x", "y")
    want = brute_neighbours([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5, 10)
    got = defaultdict(list)
    for r in neighbours.search(df, every=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(got) == set(want)
    found = [len({j for _, j in got[q]} & {j for _, j in want[q]}) / 10 for q in want]
    assert np.mean(found) >= 0.9
    assert got[500] == want[500] and all(len(x) == 10 for x in got.values())  # ties go to the smaller id
    few = spark.createDataFrame(rows[:4], df.schema)
    assert [r["vec_id"] for r in neighbours.search(few).orderBy("rank").collect()] == [j for _, j in brute_neighbours([(i, np.float32(v)) for i, v in rows[:4]], 100, 10)[0]]
    assert neighbours.search(df.limit(0)).collect() == []
    rows = lambda out: sorted(map(tuple, out.collect()))
    assert rows(neighbours.search(df, every=2, query_rows=7)) == rows(neighbours.search(df, every=2))  # parts of the queries


def test_neighbours_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute_neighbours(rows, 100, 10), defaultdict(list)
    for r in queries.op7_neighbours(spark, sf).collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    assert np.mean([len({j for j, _ in got[q]} & {j for _, j in want[q]}) / len(want[q]) for q in want]) >= 0.9
    table = dict(rows)
    for q, found in got.items():
        for j, score in found:
            assert score == pytest.approx(float(np.linalg.norm(np.array(table[q], float) - np.array(table[j], float))), rel=1e-12)


def brute_base(text):
    w, places, labels = alnum(text), [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for a in range(len(w) - len(p) + 1):
            if w[a : a + len(p)] == p:
                places.append(a)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses(spark, docs, texts, no_docs):
    extra = ["All rights reserved. ALL RIGHTS reserved", "cc BY cc by-nc 4.0", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "the mit of license", "gnu General Public License, version 3",
             "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0."]
    found = licenses.scan_licenses(docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")))
    got = {r["doc_id"]: r for r in found.collect()}
    for i, t in [*texts.items(), *((1000 + i, t) for i, t in enumerate(extra))]:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert [got[1000 + i]["labels"] for i in range(8)] == ["reserved", "cc-by,cc-by-nc-4.0", "apache-2.0", "mit", "", "gpl,gpl-3.0", "gpl,gpl-3.0", "cc-by,cc-by-nc-4.0"]
    assert all(got[i]["labels"] == "" and got[i]["score"] == 0 for i in texts)
    assert licenses.scan_licenses(no_docs).collect() == []


def test_license_labels_do_not_depend_on_other_words(spark):
    """All notices in one text, and each beside prose that holds every licence word."""
    prose = " x ".join(sorted({w for _, text, _ in licenses.TEMPLATES for w in text.split()}))
    wanted = [",".join(sorted({x[0] for x in licenses.TEMPLATES}))] + [x[0] for x in licenses.TEMPLATES] * 2
    texts = [". ".join(x[1] for x in licenses.TEMPLATES)] + [f"{prose} y {x[1]}" for x in licenses.TEMPLATES] + [f"{prose} y {x[2]}" for x in licenses.TEMPLATES]
    filler = spark.createDataFrame([(100 + i, "mit released license public this is to the under work by") for i in range(50)], "doc_id long, text string")
    found = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(filler))
    got = {r["doc_id"]: set(r["labels"].split(",")) - set(licenses.BASE.values()) for r in found.where("doc_id < 100").collect()}
    assert [got[i] for i in range(len(texts))] == [set(w.split(",")) for w in wanted]


def test_licenses_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op8_license_scan(spark, SF).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(texts[r["doc_id"]])


def test_token_counts(docs, texts, no_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = tokencount.count_tokens(docs, PIECES, limit=300).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        t = texts[r["doc_id"]] or ""
        n = len(model.encode(t))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 300)
        assert len(model.encode(t[: r["fit_chars"]])) <= 300 and (r["fit_chars"] == len(t) or len(model.encode(t[: r["fit_chars"] + 1])) > 300)
    assert tokencount.count_tokens(no_docs, PIECES).collect() == []


def test_every_prefix(texts):
    import sentencepiece

    model, counter = sentencepiece.SentencePieceProcessor(model_file=PIECES), tokencount.PrefixCounter(PIECES)
    for t in [t for t in texts.values() if t][:20]:
        t = t[:400]
        assert counter.prefix_counts(t) == [len(model.encode(t[:i])) for i in range(len(t) + 1)]


def test_token_count_query(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op9_token_counts(spark, SF).collect():
        assert r["n_tokens"] == len(model.encode(texts[r["doc_id"]]))


def test_quality_query(spark):
    """Held-out accuracy: the model never sees the labels it is judged by."""
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_quality(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([p == t for p, t in held]) >= 0.95


def test_quality_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, int(i > 17), 0) for i in range(40)] + [(None, 1, 0), (5, None, 0), (18, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for some in (labels.limit(0), labels.where("quality = 1")):
        assert {r["predicted"] for r in quality.judge_quality(docs, some).collect()} == {1}
    assert {r["predicted"] for r in quality.judge_quality(docs, labels.where("quality = 0")).collect()} == {0}
    assert quality.judge_quality(no_docs, labels).collect() == []
    kept = quality.score_documents(docs, quality.train(docs, labels, fit_rows=3))
    assert sorted(kept.columns) == sorted(docs.columns)


def test_quality_fit_against_plain_solvers():
    """Log-count ratios by plain counting, and the dual against projected gradient steps on its whole matrix."""
    rng = np.random.default_rng(11)
    labels = rng.integers(0, 2, 60)
    rows = [np.unique(rng.integers(0, 40, 12) + (0 if y else 25)).astype(np.uint32) for y in labels]
    ratios = quality.log_count_ratios(rows, labels)
    counts = {y: np.ones(quality.BUCKETS) for y in (0, 1)}
    for r, y in zip(rows, labels, strict=True):
        for f in r:
            counts[int(y)][f] += 1
    assert np.allclose(ratios, np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum()))
    signs = np.where(labels > 0, 1.0, -1.0)
    dense = np.zeros((60, 70))
    for i, r in enumerate(rows):
        dense[i, r] = ratios[r] / np.linalg.norm(ratios[r])
    upper = np.array([60 / (2 * (signs == s).sum()) for s in signs])
    gram = (signs[:, None] * dense) @ (signs[:, None] * dense).T
    alpha = np.zeros(60)
    step = 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(60_000):
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, upper)
    plain = dense.T @ (alpha * signs)
    model = quality.fit(rows, labels, passes=400)
    weight = np.divide(model.products, ratios, out=np.zeros_like(ratios), where=ratios != 0)[:70]
    value = lambda w: 0.5 * w @ w + (upper * np.maximum(0, 1 - signs * (dense @ w))).sum()
    assert abs(value(weight) - value(plain)) < 1e-3 * value(plain)
    assert np.allclose(dense @ weight, dense @ plain, atol=0.01)
