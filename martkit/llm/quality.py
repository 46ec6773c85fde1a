"""Quality classifier: a linear model over n-gram indicators scaled by naive Bayes log-count ratios.

Indicators are distinct n-grams of a text: of its bytes, of its character
shapes (letter runs, capitals, digits, each punctuation mark) and of "this word
equals the one before". Each is scaled by the log ratio of its share
among good and bad documents, rows are scaled to length one, and hinge
loss is minimised by dual coordinate descent. The model is fitted on a bounded
sample of labelled rows: ``fit_rows`` of each class, by a hash of the id.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import blobs, map_batches

BUCKETS = 1 << 16
FIT_ROWS = 3000  # labelled rows of each class
FOLDS, HELD_FOLD = 3, 1
BYTE_GRAMS, SHAPE_GRAMS, REPEAT_GRAMS = (1, 2, 3), (1, 2, 3, 4), (1, 2, 3, 4)

_SHAPES = np.array([ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else ord("a") if 97 <= c <= 122 or c >= 128 else c for c in range(256)], np.uint8)


def _grams(codes: np.ndarray, sizes: tuple[int, ...], kind: int) -> list[np.ndarray]:
    """Hash buckets of the n-grams of a sequence of small codes."""
    out, run = [], np.zeros(len(codes), np.uint32)
    for n in range(1, max(sizes) + 1):
        if len(codes) < n:
            break
        run = run[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :]
        if n in sizes:
            mixed = (run ^ np.uint32(kind * 0x9E3779B1 + n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
            out.append((mixed ^ mixed >> np.uint32(15)) & np.uint32(BUCKETS - 1))
    return out


def features(text: bytes) -> np.ndarray:
    """Sorted distinct feature buckets of a text."""
    codes = np.frombuffer(text, np.uint8)
    shape = _SHAPES[codes]
    if len(shape):
        shape = shape[np.concatenate(([True], shape[1:] != shape[:-1]))]
    words = text.split()
    repeats = np.fromiter(map(eq, words, words[1:]), np.uint8, max(0, len(words) - 1)) + np.uint8(1)
    seen = np.zeros(BUCKETS, bool)
    for part in (*_grams(codes, BYTE_GRAMS, 1), *_grams(shape, SHAPE_GRAMS, 2), *_grams(repeats, REPEAT_GRAMS, 3)):
        seen[part] = True
    return np.flatnonzero(seen).astype(np.uint32)


class Model:
    """Weights over the feature buckets; the score is a logistic of the margin."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, slope: float, shift: float):
        self.squares, self.products, self.slope, self.shift = ratios**2, ratios * weights, slope, shift

    def margin(self, found: np.ndarray) -> float:
        norm = float(self.squares[found].sum()) ** 0.5
        return float(self.products[found].sum()) / norm if norm > 0 else 0.0

    def score(self, text: bytes) -> float:
        z = self.slope * self.margin(features(text)) + self.shift
        return float(1 / (1 + np.exp(-min(50.0, max(-50.0, z)))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of each feature's smoothed share among good and among bad rows."""
    good, bad = np.full(BUCKETS, smooth), np.full(BUCKETS, smooth)
    for found, label in zip(rows, labels, strict=True):
        (good if label > 0 else bad)[found] += 1
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, passes: int = 15, seed: int = 7) -> Model:
    """Dual coordinate descent on the hinge loss of the scaled indicators, then a logistic fit of the margins.

    With one class only, or no rows, every text scores that class (good if no rows).
    """
    signs = np.where(labels > 0, 1.0, -1.0)
    if len(set(signs.tolist())) < 2:
        zero = np.zeros(BUCKETS)
        return Model(zero, zero, 0.0, -3.0 if len(signs) and signs[0] < 0 else 3.0)
    ratios = log_count_ratios(rows, labels)
    values = [ratios[r] / max(float(np.sqrt((ratios[r] ** 2).sum())), 1e-12) for r in rows]
    weight, alpha = np.zeros(BUCKETS), np.zeros(len(rows))
    counts = {s: float((signs == s).sum()) for s in (1.0, -1.0)}
    upper = np.array([cost * len(rows) / (2 * counts[s]) for s in signs])
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            # Rows have length one, so the step needs no division.
            step = signs[i] * float(weight[rows[i]] @ values[i]) - 1.0
            new = min(max(alpha[i] - step, 0.0), upper[i])
            if new != alpha[i]:
                weight[rows[i]] += (new - alpha[i]) * signs[i] * values[i]
                alpha[i] = new
    margins = np.array([float(weight[r] @ v) for r, v in zip(rows, values, strict=True)])
    slope, shift = _logistic(margins, signs > 0)
    return Model(ratios, weight, slope, shift)


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over margins, classes weighted alike (Newton steps with a ridge)."""
    share = good.mean()
    weights = np.where(good, 0.5 / share, 0.5 / (1 - share))
    target = np.where(good, 0.98, 0.02)
    x, beta = np.stack([margins, np.ones(len(margins))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        gradient = x.T @ (weights * (p - target)) + 1e-3 * beta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(curve, gradient)
    return max(float(beta[0]), 1e-3), float(beta[1])


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on labelled rows outside the held-out fold, at most ``fit_rows`` of each class.

    Labels without id or quality are skipped; an id with several labels counts as bad if one says so,
    documents that share an id each count.
    """
    spark = docs.sparkSession
    known = labels.where((fold() != HELD_FOLD) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = None
    for side in (0, 1):
        part = known.where((F.col("quality") > 0).cast("int") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = {r["doc_id"]: r["quality"] for r in chosen.collect()}  # at most 2 * fit_rows
    picked = F.broadcast(spark.createDataFrame(list(ids.items()), f"doc_id {labels.schema['doc_id'].dataType.simpleString()}, quality int"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t).tobytes() for t in blobs(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "quality", "found"])

    sample = map_batches(docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "quality"), run, "doc_id string, quality int, found binary".replace("doc_id string", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))
    rows = sample.toArrow().to_pylist()
    rows.sort(key=lambda r: (str(r["doc_id"]), r["found"]))
    return fit([np.frombuffer(r["found"], np.uint32) for r in rows], np.array([r["quality"] for r in rows], np.int64))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``score`` (0 to 1, higher: good is likelier) in place of any column of that name.

    Each text is scored alone; null counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop("score")
    at = rows.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = pa.array([shared.value.score(t) for t in blobs(batch.column(at))], pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return map_batches(rows, run, ", ".join([*fields, "score double"]))


def judge_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if the score is 0.5 or more) for every document.

    A null id is never held out.
    """
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels, fit_rows))
    held = F.coalesce(fold() == HELD_FOLD, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
