"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred distinct rows form a tall matrix X that never leaves its tasks. A step multiplies X by a vector and the transposed X by the
result, in one pass over packed blocks of rows. The left vectors are as long as the data and stay implicit: each is X times
a short vector z, so its inner products with others follow from z and the transposed products, which are as short as a row.
Both sides are fully reorthogonalised, twice. The singular values of the small bidiagonal matrix give the deviations, its
right vectors the components. A start vector that sees only part of the space (equal deviations) is followed by further ones, orthogonal to
all before, until nothing above the wanted values is left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.session import cut_lineage

SCALE = 256.0
COMPONENTS = 4
BLOCK_BYTES = 1 << 20
REDUCERS = 8
SETTLED, SEEN = 1e-13, 1e-6
SAFE = 2**62


@dataclass(frozen=True)
class Whitening:
    """Rows in the fit list, sums of each dimension, components as rows, their eigenvalues, the trace and the largest identity error."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def quantised(vectors: DataFrame, scale: float = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(scale * entry) of the rows whose vector is not null, not empty and has finite entries only."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), entries.alias("entries")).filter((F.size("entries") > 0) & finite)
    return rows.select("vec_id", F.transform("entries", lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _pack(d: int):
    rows = max(1, BLOCK_BYTES // (8 * d))

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0), d)
            yield pa.RecordBatch.from_arrays([pa.array([x[i:i + rows].tobytes() for i in range(0, len(x), rows)], pa.binary())], names=["block"])

    return run


def _partial(f: Callable[[np.ndarray], np.ndarray], d: int):
    def run(batches):
        total = None
        for batch in batches:
            for block in batch.column(0):
                mine = f(np.frombuffer(block.as_py(), np.int64).reshape(-1, d))
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    return run


def _added(dtype: type):
    def run(batches):
        total = None
        for batch in batches:
            for part in batch.column(0):
                mine = np.frombuffer(part.as_py(), dtype)
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    return run


def summed(blocks: DataFrame, f: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """Sum over all blocks of ``f(block)``, a vector of doubles; at most ``REDUCERS`` partial sums reach the driver."""
    parts = blocks.mapInArrow(_partial(f, d), "part binary").repartition(REDUCERS).mapInArrow(_added(np.float64), "part binary")
    return sum(np.frombuffer(r.part, np.float64) for r in parts.collect())


def exact_sums(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension; halves of 32 bits cannot overflow."""

    def halves(batches):
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_py(), np.int64).reshape(-1, d)
                at, low, high = np.arange(-1, d), (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(len(x), low)), pa.array(np.append(0, high))], names=["at", "low", "high"])

    parts = blocks.mapInArrow(halves, "at long, low long, high long").groupBy("at")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    found = {r["at"]: (int(r["high"]) << 32) + int(r["low"]) for r in parts.agg(*wide).collect()}
    return found.get(-1, 0), [found.get(i, 0) for i in range(d)]


def _without(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` orthogonalised against ``basis``, twice."""
    if basis:
        rows = np.array(basis)
        for _ in range(2):
            v = v - rows.T @ (rows @ v)
    return v


def _start(d: int, basis: list[np.ndarray], rng: np.random.Generator) -> np.ndarray | None:
    """A random unit vector orthogonal to ``basis``, or None if that spans the space."""
    if len(basis) >= d:
        return None
    v = _without(rng.normal(size=d), basis)
    return v / np.linalg.norm(v)


def bidiagonalise(product, d: int, wanted: int, locked: list[np.ndarray], rng: np.random.Generator, tolerance: float = SETTLED) -> tuple[list[tuple[float, np.ndarray]], bool]:
    """The ``wanted`` largest (singular value, right vector) orthogonal to ``locked``, falling, and whether the space is spanned.

    ``product(z)`` is (|Xz| ** 2, XᵀXz). Steps go on until the residuals of the wanted values are below ``tolerance`` times the largest.
    """
    right, short, back, alphas, betas = [], [], [], [], []  # v, z with u = Xz, Xᵀu, the two diagonals
    v, beta = _start(d, locked, rng), 0.0
    while v is not None:
        right.append(v)
        z = v - beta * short[-1] if beta else v
        size, g = product(z)
        if short:
            rows, images = np.array(short), np.array(back)
            for _ in range(2):
                c = rows @ g
                z, g, size = z - rows.T @ c, g - images.T @ c, size - c @ c
        alpha, largest = np.sqrt(max(size, 0.0)), max([*alphas, np.sqrt(max(size, 0.0))])
        if alpha <= 1e-14 * largest or not largest:
            alpha, z, g = 0.0, np.zeros(d), np.zeros(d)
        else:
            z, g = z / alpha, g / alpha
        short.append(z)
        back.append(g)
        alphas.append(alpha)
        w = _without(g - alpha * v, [*right, *locked])
        beta = float(np.linalg.norm(w))
        left, values, rights = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        spanned = len(right) + len(locked) >= d
        if spanned or (len(values) >= wanted and beta and np.abs(beta * left[-1, :wanted]).max() <= tolerance * values[0]):
            vectors = np.array(right).T @ rights[:wanted].T
            return [(float(s), vectors[:, i] / np.linalg.norm(vectors[:, i])) for i, s in enumerate(values[:wanted])], spanned
        if beta <= 1e-13 * max(largest, np.finfo(float).tiny):
            v, beta = _start(d, [*right, *locked], rng), 0.0
        else:
            v = w / beta
        betas.append(beta)
    return [], True


def leading(product, d: int, wanted: int) -> list[tuple[float, np.ndarray]]:
    """The ``wanted`` largest singular values with their right vectors, equal ones as often as they occur."""
    rng = np.random.default_rng(20240611)
    found, spanned = bidiagonalise(product, d, min(wanted, d), [], rng)
    while not spanned and len(found) < d:
        more, spanned = bidiagonalise(product, d, 1, [v for _, v in found], rng, SEEN)
        bound = sorted((s for s, _ in found), reverse=True)[min(wanted, len(found)) - 1]
        if not more or more[0][0] <= bound * (1 - SEEN):
            break
        if more[0][0] <= bound:  # too close to tell: settle it
            more, _ = bidiagonalise(product, d, 1, [v for _, v in found], rng)
        found += more
    return sorted(found, key=lambda x: -x[0])[:wanted]


def fit(points: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of the distinct rows of ``points`` (x: array<long> of length ``d``). Directions without deviation are no components."""
    blocks = cut_lineage(points.select("x").distinct().mapInArrow(_pack(d), "block binary"), "whitening")
    n, sums = exact_sums(blocks, d)
    if not n:
        return Whitening(0, sums, np.zeros((0, d)), np.zeros(0), 0.0, 0.0)
    mean = np.array([s / n for s in sums])

    def squares(x):
        return np.array([((x - mean) ** 2).sum()])

    trace = float(summed(blocks, squares, d)[0]) / n

    def product(z):
        def both(x):
            centred = x - mean
            u = centred @ z
            return np.concatenate(([u @ u], u @ centred))

        out = summed(blocks, both, d)
        return out[0], out[1:]

    found = leading(product, d, components) if trace > 0 else []
    found = [(s * s / n, v) for s, v in found if s * s / n > 1e-13 * trace]
    values, vectors = np.array([e for e, _ in found]), np.array([v for _, v in found]).reshape(-1, d)
    k = len(found)
    if not k:
        return Whitening(n, sums, vectors, values, trace, 0.0)

    def white(x):
        return (x - mean) @ vectors.T / np.sqrt(values)

    centre = summed(blocks, lambda x: white(x).sum(axis=0), d) / n

    def spread(x):
        w = white(x) - centre
        return (w.T @ w).reshape(-1)

    error = float(np.abs(summed(blocks, spread, d).reshape(k, k) / n - np.eye(k)).max())
    return Whitening(n, sums, vectors, values, trace, error)


def _apply(model: Whitening, d: int):
    def deviation(x: np.ndarray) -> list:
        """Exact sums of squares; None where 64 bits do not hold one."""
        if max(int(np.abs(x).max(initial=0)) * model.n, max(abs(s) for s in model.sums)) < SAFE // 2:
            y = x * model.n - np.array(model.sums, np.int64)
            if ((y.astype(float) ** 2).sum(axis=1) < SAFE).all():
                return (y * y).sum(axis=1).tolist()
        exact = (sum((model.n * int(c) - s) ** 2 for c, s in zip(row, model.sums)) for row in x)
        return [v if v < 2**63 else None for v in exact]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            white = (x - model.mean) @ model.components.T / np.sqrt(model.eigenvalues)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation(x), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(white.reshape(-1)))],
                                             names=["vec_id", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per usable row: vec_id, n, deviation, whitened (one value per component), explained (share of the trace, likewise), identity_error.

    Entries become floor(scale * entry), at most what 64 bits hold. Rows whose vector is null, empty or has null or non-finite entries are left out. The
    fit list is each distinct vector once; ``n`` is its length. ``deviation`` is the exact sum of (n * x - sum) squared over the dimensions, null
    beyond 64 bits. Vectors of different lengths live in spaces of their own, each with its own fit. There are fewer components
    where the data deviate in fewer directions, none if all vectors are equal. Repeated rows and null ids stay. Other columns are ignored.
    """
    rows = quantised(vectors, scale, vec_id, vector)
    lengths = sorted(r.d for r in rows.select(F.size("x").alias("d")).distinct().collect())
    kind = rows.schema["vec_id"].dataType
    result = T.StructType([T.StructField("vec_id", kind), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    out = None
    for d in lengths or [1]:
        mine = rows.filter(F.size("x") == d)
        model = fit(mine, d, components)
        made = mine.mapInArrow(_apply(model, d), result) if model.n else vectors.sparkSession.createDataFrame([], result)
        explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
        made = made.select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
        out = made if out is None else out.unionByName(made)
    return out
