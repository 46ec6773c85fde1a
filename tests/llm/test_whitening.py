"""Whitening against a plain eigendecomposition and whole-number arithmetic."""

import math

import numpy as np
import pytest

from martkit.llm import queries, whitening
from tests.llm.conftest import SF


def plain(vectors):
    """deviation, explained and whitened up to sign, from a list of vectors."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[float(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, basis = values[order], basis[:, order]
    return n, deviation, values, centred @ basis / np.sqrt(np.maximum(values, 1e-300))


def check(rows, vectors, most=32):
    """rows of the result against vectors by key, keys unique."""
    keys = sorted(vectors)
    n, deviation, values, want = plain([vectors[k] for k in keys])
    k = min(most, int((values > 1e-10 * values[0]).sum()))
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == len(keys) * k
    table = np.array([[got[key, c + 1]["whitened"] for c in range(k)] for key in keys])
    assert all(got[key, 1]["deviation"] == d and got[key, 1]["n"] == n for key, d in zip(keys, deviation, strict=True))
    assert np.allclose([got[keys[0], c + 1]["explained"] for c in range(k)], values[:k] / values.sum(), rtol=1e-9)
    signs = np.sign((table * want[:, :k]).sum(axis=0))
    assert np.allclose(table * signs, want[:, :k], atol=1e-7)
    own = np.abs(table.T @ table / n - np.outer(table.mean(axis=0), table.mean(axis=0)) - np.eye(k)).max()
    errors = {r["identity_error"] for r in rows}
    reached = 1e-10 + 1e-14 * values[0] / values[k - 1]  # what double precision leaves of the smallest component
    assert len(errors) == 1 and errors.pop() < reached and own < reached


def test_query(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    result = queries.op12_whitening(spark, SF)
    assert dict(result.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check(result.collect(), vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = {i: rng.standard_normal(5).round(3).tolist() for i in range(40)}
    good |= {100 + i: good[0] for i in range(30)}  # a hot vector
    good[200] = [2.0, -3.5, 1e5, 0.0, 1 / 64]
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, float("inf"), 1.0, 1.0, 1.0], [1.0, -float("inf"), 1.0, 1.0, 1.0], [1.0, 2.0], [1e300] * 5, [1.0] * 9]
    rows = [(i, v, 1, 0.0) for i, v in good.items()] + [(900 + i, v, None, None) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, whitened double").repartition(4)
    check(whitening.whiten(df).collect(), good)
    check(whitening.whiten(df, most=2).collect(), good, 2)
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("vec_id = 900")).collect() == []
    assert whitening.whiten(df.where("vec_id = 5")).collect() == []
    assert whitening.whiten(df.where("vec_id >= 100 and vec_id < 130")).collect() == []
    twice = df.where("vec_id < 40").unionAll(df.where("vec_id < 40").selectExpr("cast(null as long)", "embedding", "component", "whitened"))
    result = whitening.whiten(twice).collect()
    assert len(result) == 80 * 5 and sum(r["vec_id"] is None for r in result) == 200 and {r["n"] for r in result} == {80}


def test_constant_and_dependent_dimensions(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-400, 400, (60, 3)) / 64
    vectors = {i: [*b, b[0] + b[1], 7.0, 2 * b[2]] for i, b in enumerate(base.tolist())}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    check(whitening.whiten(df).collect(), vectors)


def test_large_numbers_stay_exact(spark):
    vectors = {i: [1e9 * i, -3.0 * i * i, 5e7] for i in range(12)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).collect()}
    _, deviation, _, _ = plain(list(vectors.values()))
    assert [int(got[i]) for i in range(12)] == deviation and max(deviation) > 2**63


@pytest.mark.parametrize("spectrum", ["spread", "clusters", "equal", "tiny"])
def test_feast_finds_all(spectrum):
    rng = np.random.default_rng(3)
    n = 70
    basis = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = {
        "spread": np.arange(1.0, n + 1),
        "clusters": np.repeat([100.0, 50.0, 10.0, 1.0, 0.1, 0.0, 0.0], 10) + rng.random(n) * 1e-4,
        "equal": np.repeat([9.0, 3.0], 35),
        "tiny": 10.0 ** -np.linspace(0, 12, n),
    }[spectrum]
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.components(matrix, 32)
    assert len(found) == 32 and np.allclose(found, np.sort(values)[::-1][:32], rtol=1e-8, atol=1e-13 * values.max())
    assert np.abs(vectors @ vectors.T - np.eye(32)).max() < 1e-9
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-12 * values.max()


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 40):
        matrix = rng.standard_normal((n, n))
        matrix += matrix.T
        values = np.linalg.eigvalsh(matrix)
        shifts = np.r_[values - 1e-6, values + 1e-6, 0.0]
        assert whitening.Inertia(matrix).above(shifts).tolist() == [(values > s).sum() for s in shifts]


def test_contour_keeps_only_the_interval():
    values = np.array([1.0, 2.0, 5.0, 9.0])
    kept = whitening.contour_projection(np.diag(values), np.eye(4), 1.5, 6.5, 24)
    assert np.allclose(np.diag(kept), [0, 1, 1, 0], atol=1e-3)
