"""Whitening of embeddings with components from FEAST contour integration.

Spark gathers exact sums and the covariance of all vectors in two passes, as partial matrices of each
task added up by dimension; only matrices of the vectors' width, never rows, reach the driver. There
inertia counts of the shifted covariance part the upper end of its spectrum into intervals of
few eigenvalues. For each interval the projector onto its eigenvectors is a contour integral of the
resolvent: a quadrature of complex shifted solves on a circle. Rayleigh-Ritz on the projected
block gives components, and the block is projected again until they no longer change and are as
many as the inertia counts say. Two more passes whiten all rows: one measures the result's own covariance,
the other returns it.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.frames import map_batches

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
LARGEST = 2.0**62  # scaled entries from here on have no 64-bit integer
NODES = 8  # of the quadrature on the upper half of a circle
PER_INTERVAL = 8
ROUNDS = 40
GRID = 129
CELLS_AT_ONCE = 2_000_000  # entries of vectors in one matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the symmetric matrix's eigenvalues, by reflections."""
    a = np.array(matrix, float)
    n = len(a)
    off = np.zeros(max(0, n - 1))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if k == n - 2 or np.linalg.norm(x[1:]) == 0:
            off[k] = x[0]
            continue
        off[k] = -size if x[0] > 0 else size
        x[0] -= off[k]
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ x
        w -= x * (x @ w)
        rest -= 2 * (np.outer(x, w) + np.outer(w, x))
    return np.diag(a).copy(), off


class Inertia:
    """Numbers of eigenvalues above shifts, by the signs of the pivots of the shifted matrix."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.off = tridiagonal(matrix)
        self.norm = float(np.abs(self.diagonal).max(initial=0) + 2 * np.abs(self.off).max(initial=0)) or 1.0

    def above(self, shifts: np.ndarray) -> np.ndarray:
        shifts = np.asarray(shifts, float)
        tiny = self.norm * 1e-300 + 1e-300
        pivot = self.diagonal[0] - shifts
        count = (pivot > 0).astype(int)
        for d, e in zip(self.diagonal[1:], self.off, strict=True):
            pivot = d - shifts - e * e / np.where(np.abs(pivot) < tiny, -tiny, pivot)
            count += pivot > 0
        return count


def _free(inertia: Inertia, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    grid = np.linspace(low, high, GRID)
    return grid, inertia.above(grid)


def intervals(inertia: Inertia, low: float, high: float, most: int = PER_INTERVAL) -> list[tuple[float, float]]:
    """Cut (low, high) where no eigenvalue is near, into parts of few eigenvalues; ones that cannot be told apart stay together."""
    grid, above = _free(inertia, low, high)
    inside = above[0] - above[-1]
    if not inside:
        return []
    first, last = np.flatnonzero(above < above[0])[0] - 1, np.flatnonzero(above > above[-1])[-1] + 1
    tight = high - low <= 1e-11 * inertia.norm
    if inside <= most or tight:
        return [(low, high)]
    values, starts, sizes = np.unique(-above, return_index=True, return_counts=True)
    parts = [(s * min(above[0] + v, -v - above[-1]), grid[a], grid[a + s - 1]) for v, a, s in zip(values, starts, sizes, strict=True) if s > 1 and above[-1] < -v < above[0]]
    if not parts:  # all in neighbouring cells
        margin = (high - low) / (GRID - 1)
        return intervals(inertia, max(low, grid[first] - margin / 2), min(high, grid[last] + margin / 2), most)
    _, a, b = max(parts)
    cut = (a + b) / 2
    return intervals(inertia, low, cut, most) + intervals(inertia, cut, high, most)


def contour_projection(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int = NODES) -> np.ndarray:
    """The block's part in the eigenvectors between low and high: (1 / 2 pi i) times the integral of (z - V)^-1 block dz."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for j in range(nodes):
        turn = np.exp(1j * np.pi * (j + 0.5) / nodes)
        z = centre + radius * turn
        out += (radius * turn * np.linalg.solve(z * np.eye(len(matrix)) - matrix, block.astype(complex))).real / nodes
    return out


def feast(matrix: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues between low and high and their unit eigenvectors as columns; as many as inertia says, or an error."""
    n = len(matrix)
    scale = max(np.abs(matrix).sum(axis=1).max(), 1e-300)
    rng = np.random.default_rng(12)
    width = min(n, inside + inside // 2 + 6)
    while True:
        block, worst = rng.standard_normal((n, width)), np.inf
        for _ in range(ROUNDS):
            q = np.linalg.qr(contour_projection(matrix, block, low, high))[0]
            values, turn = np.linalg.eigh(q.T @ matrix @ q)
            block = q @ turn
            error = np.linalg.norm(matrix @ block - block * values, axis=0) / scale
            here = (values > low) & (values < high) & (error < 1e-6)
            before, worst = worst, error[here].max(initial=0)
            if here.sum() == inside and (worst < 1e-15 or (worst < 1e-13 and worst > before / 2)):
                return values[here], block[:, here]
        if width == n:
            raise ArithmeticError(f"{int(here.sum())} of {inside} eigenvalues found between {low} and {high}")
        width = min(n, 2 * width)


def components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and unit eigenvectors as rows: at most so many, none whose eigenvalue is 0 to double precision."""
    n = len(covariance)
    if not n or not np.abs(covariance).max() > 0:
        return np.zeros(0), np.zeros((0, n))
    inertia = Inertia(covariance)
    high = inertia.norm * 1.01
    zero = 16 * n * np.finfo(float).eps * inertia.norm
    low = zero
    if inertia.above([zero])[0] > most:
        a, b = zero, high  # narrow down to a cut below which the rest lies
        while b - a > 1e-12 * inertia.norm:
            grid, above = _free(inertia, a, b)
            exact = np.flatnonzero(above == most)
            if len(exact) > 1:
                a = b = (grid[exact[0]] + grid[exact[-1]]) / 2
            else:
                at = np.flatnonzero(above > most)[-1]
                a, b = grid[at], grid[at + 1]
        low = a  # equal eigenvalues at the cut are all taken here and cut below
    found = []
    for part in intervals(inertia, low, high):
        above = inertia.above(part)
        found.append(feast(covariance, *part, int(above[0] - above[1])))
    if sum(len(v) for v, _ in found) != inertia.above([low])[0]:
        raise ArithmeticError("eigenvalues missed")
    together = np.linalg.qr(np.concatenate([x for _, x in found], axis=1))[0]  # neighbours of different intervals made orthogonal
    values, turn = np.linalg.eigh(together.T @ covariance @ together)
    vectors = (together @ turn).T
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[order]


def integers(batch: pa.RecordBatch, width: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the usable rows of a batch (vectors in its last column) and their integer vectors, in matrices of one width and bounded size."""
    column = batch.columns[-1]
    lengths = np.where(np.array(column.is_valid()), np.diff(np.array(column.offsets)), -1)
    entries = column.values.to_numpy(zero_copy_only=False).astype(float)  # null entries become nan
    starts = np.array(column.offsets)[:-1]
    for size in np.unique(lengths) if width is None else [width]:
        rows = np.flatnonzero(lengths == size)
        step = max(1, CELLS_AT_ONCE // max(1, size))
        for i in range(0, len(rows) if size > 0 else 0, step):
            some = rows[i : i + step]
            scaled = np.floor(SCALE * entries[starts[some][:, None] + np.arange(size)])
            good = (np.abs(scaled) < LARGEST).all(axis=1)
            yield some[good], scaled[good].astype(np.int64) + SHIFT


def _per_task(rows: DataFrame, add: Callable[[pa.RecordBatch, dict], None], schema: str, types: list[pa.DataType]) -> DataFrame:
    """One pass whose tasks each return the few rows they gathered."""
    names = [s.split()[0] for s in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            add(batch, state)
        if state:
            columns = zip(*(row for part in state.values() for row in part()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return rows.mapInArrow(run, schema)


class _Sums:
    """Exact sums of integer vectors of one width, the high and low halves of the integers apart."""

    def __init__(self, width: int):
        self.width, self.n, self.high, self.low = width, 0, np.zeros(width, np.int64), np.zeros(width, np.int64)

    def __call__(self) -> Iterator[tuple]:
        return ((self.width, i, self.n, int(h), int(lo)) for i, (h, lo) in enumerate(zip(self.high, self.low, strict=True)))


class _Products:
    """Sums of products of all pairs of columns."""

    def __init__(self, width: int):
        self.total = np.zeros((width, width))

    def __call__(self) -> Iterator[tuple]:
        return ((i, row) for i, row in enumerate(self.total))


@dataclass
class Whitening:
    """Count, exact sums, components (rows), their eigenvalues and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def centres(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers, and n times what is left of it."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([s - self.n * w for s, w in zip(self.sums, whole, strict=True)], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.centres()
        return (x - whole).astype(float) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums over dimensions of (n x - S)^2 as decimals; null if one has more than 38 digits."""
        kind = pa.decimal128(38, 0)
        whole, rest = self.centres()
        near = x - whole
        reach = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if self.width * reach * reach < 2**63:
            return pa.array(((self.n * near - rest) ** 2).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(kind)
        exact = ((near.astype(object) * self.n - rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([decimal.Decimal(v) if v < 10**38 else None for v in exact.tolist()], kind)


def gather(rows: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of a vector column: sums in one pass, the covariance in another."""

    def add_sums(batch: pa.RecordBatch, state: dict) -> None:
        for _, x in integers(batch):
            if len(x):
                part = state.setdefault(x.shape[1], _Sums(x.shape[1]))
                part.n += len(x)
                part.high += (x >> 32).sum(axis=0)
                part.low += (x & 0xFFFFFFFF).sum(axis=0)

    partial = _per_task(rows, add_sums, "width int, place int, n long, high long, low long", [pa.int32(), pa.int32(), *[pa.int64()] * 3])
    decimals = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    top = partial.where("place = 0").groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if top is None:
        return None
    width, n = top["width"], top["n"]
    found = partial.where(F.col("width") == width).groupBy("place").agg(*decimals).orderBy("place").collect()
    model = Whitening(n, [int(r["high"]) * 2**32 + int(r["low"]) for r in found], np.zeros(0), np.zeros((0, width)), 0.0)
    whole, rest = model.centres()

    def add_products(batch: pa.RecordBatch, state: dict) -> None:
        for _, x in integers(batch, width):
            near = (x - whole).astype(float)
            state.setdefault(0, _Products(width)).total += near.T @ near

    covariance = _added(_per_task(rows, add_products, "row int, products array<double>", [pa.int32(), pa.list_(pa.float64())]), width) / n
    covariance -= np.outer(rest / n, rest / n)
    model.trace = float(np.trace(covariance))
    model.values, model.vectors = components(covariance, most)
    return model


def _added(partial: DataFrame, width: int) -> np.ndarray:
    """Partial matrices of all tasks, added up by place."""
    out = np.zeros((width, width))
    for r in partial.select("row", F.posexplode("products").alias("at", "product")).groupBy("row", "at").agg(F.sum("product").alias("total")).collect():
        out[r["row"], r["at"]] = r["total"]
    return out


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the identity."""
    k = len(model.values)

    def add(batch: pa.RecordBatch, state: dict) -> None:
        for _, x in integers(batch, model.width):
            z = np.c_[model.whitened(x), np.ones(len(x))]
            state.setdefault(0, _Products(k + 1)).total += z.T @ z

    total = _added(_per_task(rows, add, "row int, products array<double>", [pa.int32(), pa.list_(pa.float64())]), k + 1) / model.n
    return float(np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max())


def whiten(embeddings: DataFrame, most: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key, component (from 1), n, deviation (decimal), whitened, explained and identity_error of every usable row and component.

    Left out are null and empty vectors, vectors with null or non-finite entries or entries whose integer has more
    than 64 bits, and vectors that are not as long as most (of equally frequent lengths the longest counts). All others are
    fitted and whitened, with null and repeated keys as well. Components whose eigenvalue is 0 to
    double precision, as of constant dimensions, have no unit variance and no rows; a single row or equal
    rows only, and an empty table, give no rows. Other columns are not looked at.
    """
    spark, kind = embeddings.sparkSession, embeddings.schema[key].dataType.simpleString()
    rows = embeddings.select(F.col(column).alias("vector"))
    model = gather(rows, most)
    if model is None or not len(model.values):
        return spark.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    error = identity_error(rows, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = []
        for some, x in integers(batch, model.width):
            z = model.whitened(x)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            parts.append(pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), model.deviations(x), values], ["key", "deviation", "values"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts and sum(p.num_rows for p in parts) else None

    done = map_batches(embeddings.select(F.col(key).alias("key"), F.col(column).alias("vector")), run, f"key {kind}, deviation decimal(38,0), values array<double>")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return done.select("key", "deviation", F.posexplode("values").alias("at", "whitened")).select(
        F.col("key").alias(key),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
