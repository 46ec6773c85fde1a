import random

import pytest

from martkit.llm.frames import ready

DOC = "doc_id long, text string, lang string, source string, n_chars long, extra string, score double, n_words long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ready(spark)


def words(rng, n):
    return [rng.choice("the an or of it ne ra tion el".split()) + rng.choice("ab cd ef gh ij kl mn op".split()) + str(rng.randrange(60)) for _ in range(n)]


def odd_texts():
    """Null, empty, blank, short, long, non-ASCII, repeated, near-copied and passage-sharing texts."""
    rng = random.Random(5)
    base = words(rng, 160)
    passage = " ".join(words(rng, 40))
    texts = [None, "", " ", "\t\n", "a", "a b", "A  b", "éÀ ü  ß", "🙂 x\x00y", "a" * 700, "ab " * 400, "x y z", "<|endoftext|> q", "▁▁ p ▁"]
    texts += [" ".join(base)] * 4
    for i in range(12):
        copy = list(base)
        for _ in range(i):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(1000)}"
        texts.append(" ".join(copy))
    texts += [" ".join(words(rng, 30)) + "\n" + passage + "\n" + " ".join(words(rng, 25)) for _ in range(12)]
    texts += [" ".join(words(rng, rng.randrange(1, 200))) for _ in range(20)]
    texts.append(" ".join(words(rng, 9000)))
    return texts


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "e", 0.5, 7) for i, t in enumerate(odd_texts())]
    rows.append((3, rows[3][1], None, None, None, None, None, None))  # a repeated row
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def texts():
    return dict(enumerate(odd_texts()))
