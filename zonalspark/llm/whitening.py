"""Operator 13: whitening of embeddings.

Each partition goes over its vectors once: a streaming rank-one update (Welford)
of the count, the mean and the centred products, so that nothing is subtracted
from a large sum. The states of partitions are merged by the parallel update
formula, some tens at a time in a tree of groups, always in the same order. The
covariance, a matrix of the vector's length, goes through a symmetric QR: reflected
to three diagonals, then rotated with shifts until none but the middle one is left.
A second pass over the vectors measures the covariance of what was whitened.

A vector takes part if it is not null and all its entries are there and finite. An
entry c becomes the long floor(scale * c) + shift. Vectors of another length are
whitened by themselves: each length has its own fit. A component without variance
(one row, equal rows, fewer rows than entries) has a null ``whitened`` and takes no
part in ``identity_error``, which is null if there is no other; ``explained`` is null
if there is no variance at all. A ``deviation`` beyond a long is null. Equal
eigenvalues keep the order of the solver. Repeated rows are rows, and so are null
and repeated ids. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: States that are merged in one group.
FAN = 32
#: Rows that are put out at a time.
ROWS = 1024
#: Variance below this share of the largest one's is rounding.
LEAST = 1e-12
_STATE = "part long, dims int, n long, sums string, mean binary, products binary"
_MOST = 2**63 - 1


class Moments:
    """Count, exact sums, mean and centred products of vectors of one length."""

    def __init__(self, dims: int):
        self.n, self.sums = 0, [0] * dims
        self.mean, self.products = np.zeros(dims), np.zeros((dims, dims))

    def add(self, rows: np.ndarray) -> None:
        """Each row in turn: a rank-one update."""
        n, mean, products = self.n, self.mean, self.products
        turned = np.empty_like(products)
        for x in rows.astype(np.float64):
            n += 1
            delta = x - mean
            mean += delta / n
            np.multiply(delta[:, None], delta * ((n - 1) / n), out=turned)
            products += turned
        self.n = n
        if rows.dtype == np.int64:
            self.sums = [s + t for s, t in zip(self.sums, _sums(rows), strict=True)]

    def merge(self, other: Moments) -> None:
        n = self.n + other.n
        if n:
            delta = other.mean - self.mean
            self.products += other.products + np.outer(delta, delta) * (self.n * (other.n / n))
            self.mean += delta * (other.n / n)
        self.n, self.sums = n, [s + t for s, t in zip(self.sums, other.sums, strict=True)]

    def covariance(self) -> np.ndarray:
        return (self.products + self.products.T) / (2 * self.n)

    def row(self, part: int, dims: int) -> tuple:
        """dims: the length of the vectors that these are the moments of, or of what was made of them."""
        return part, dims, self.n, ",".join(map(str, self.sums)), self.mean.tobytes(), self.products.tobytes()

    @classmethod
    def of(cls, row: dict) -> Moments:
        out = cls(len(row["mean"]) // 8)
        out.n, out.sums = row["n"], [int(x) for x in row["sums"].split(",") if x]
        out.mean[:] = np.frombuffer(row["mean"])
        out.products[:] = np.frombuffer(row["products"]).reshape(out.products.shape)
        return out


def _sums(rows: np.ndarray) -> list[int]:
    small = int(np.abs(rows).max(initial=0)) * len(rows) < 2**62
    return [int(x) for x in (rows if small else rows.astype(object)).sum(axis=0)] if len(rows) else [0] * rows.shape[1]


def _states(held: dict[int, Moments]) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    return _batch([m.row(part, dims) for dims, m in held.items()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[c.split()[0] for c in _STATE.split(", ")])


def merged(states: DataFrame) -> dict[int, Moments]:
    """One state for each length of vector, from those of partitions: a tree of groups, the first of a group first."""
    most = states.select(F.max("part")).collect()[0][0]

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        out = Moments.of(rows[0])
        for row in rows[1:]:
            out.merge(Moments.of(row))
        return pa.Table.from_batches([_batch([out.row(rows[0]["part"] // FAN, rows[0]["dims"])])])

    while most:
        states = states.groupBy("dims", F.expr(f"part div {FAN}")).applyInArrow(join, _STATE)
        most //= FAN
    return {r["dims"]: Moments.of(r.asDict()) for r in states.collect()} if most is not None else {}


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(middle diagonal, the one beside it, rows of the basis) after reflections of a symmetric matrix."""
    a, basis = matrix.astype(np.float64).copy(), np.eye(len(matrix))
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        length = math.sqrt(x @ x)
        if length == 0 or not x[1:].any():
            continue
        v = x
        v[0] += math.copysign(length, v[0])
        v /= math.sqrt(v @ v)
        below = a[k + 1 :, k + 1 :]
        p = below @ v
        w = p - (v @ p) * v
        below -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = -math.copysign(length, a[k + 1, k])
        basis[k + 1 :] -= 2 * np.outer(v, v @ basis[k + 1 :])
    return np.diag(a).copy(), np.diag(a, -1).copy(), basis


def symmetric_qr(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows, of a symmetric matrix; the largest entry of each is positive."""
    size = float(np.abs(matrix).max(initial=0)) or 1.0  # so that no square is too small or too large
    middle, beside, basis = tridiagonal(matrix / size)
    high, turns = len(middle) - 1, 0
    while high > 0:
        small = np.abs(beside[:high]) <= 2.3e-16 * (np.abs(middle[:high]) + np.abs(middle[1 : high + 1]))
        beside[:high][small] = 0
        if small[-1]:
            high -= 1
            continue
        turns += 1
        if turns > 60 * len(middle):
            raise ArithmeticError("the rotations do not settle: the matrix has entries that are not finite")
        apart = np.flatnonzero(small)
        low = int(apart[-1]) + 1 if len(apart) else 0
        half, last = (middle[high - 1] - middle[high]) / 2, beside[high - 1]
        x = middle[low] - (middle[high] - last * last / (half + math.copysign(math.hypot(half, last), half)))
        z = beside[low]
        for k in range(low, high):
            r = math.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > low:
                beside[k - 1] = r
            p, q, f = middle[k], middle[k + 1], beside[k]
            middle[k] = c * c * p + 2 * c * s * f + s * s * q
            middle[k + 1] = s * s * p - 2 * c * s * f + c * c * q
            x = beside[k] = c * s * (q - p) + (c * c - s * s) * f
            if k < high - 1:
                z = s * beside[k + 1]
                beside[k + 1] *= c
            basis[[k, k + 1]] = c * basis[k] + s * basis[k + 1], c * basis[k + 1] - s * basis[k]
    order = np.argsort(-middle, kind="stable")
    basis = basis[order]
    signs = np.sign(basis[np.arange(len(basis)), np.abs(basis).argmax(axis=1)]) if len(basis) else np.ones(0)
    return middle[order] * size, basis * signs[:, None]


class Model:
    """What whitens vectors of one length."""

    def __init__(self, moments: Moments, components: int = COMPONENTS):
        self.n, self.sums = moments.n, moments.sums
        values, vectors = symmetric_qr(moments.covariance())
        self.trace = float(np.trace(moments.covariance()))
        self.values, self.vectors = values[:components], vectors[:components]
        self.live = self.values > max(LEAST * self.values.max(initial=0), 0)
        self.matrix = (self.vectors[self.live] / np.sqrt(self.values[self.live])[:, None]).T
        self.error: float | None = None

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        small = self.n * max(int(np.abs(rows).max(initial=0)), 1) < 2**62 and all(abs(s) < 2**62 for s in self.sums)
        kind = np.int64 if small else object
        return rows.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return (self.deviations(rows) / self.n).astype(np.float64) @ self.matrix

    def squares(self, rows: np.ndarray) -> list[int | None]:
        """The sum of squared deviations of each row; None beyond a long."""
        d = self.deviations(rows)
        if d.dtype == np.int64 and np.square(d, dtype=np.float64).sum(axis=1).max(initial=0) < 2**62:
            return np.square(d).sum(axis=1).tolist()
        return [s if s <= _MOST else None for s in (sum(int(x) ** 2 for x in row) for row in d)]


def taking_part(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    x = F.transform(F.col(embedding), lambda e: e.cast("double"))
    ok = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.filter(F.coalesce(ok & (F.size(embedding) > 0), F.lit(False))).select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))


def _by_length(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, ids, longs) of the vectors of a batch."""
    lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths).tolist():
        part = batch.take(pa.array(np.flatnonzero(lengths == dims)))
        entries = part.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        whole = np.clip(np.floor(entries * scale), -(2.0**62), 2.0**62).astype(np.int64) + shift
        yield dims, part.column(0), whole.reshape(part.num_rows, dims)


def fit(rows: DataFrame, *, scale: int = SCALE, shift: int = SHIFT) -> dict[int, Moments]:
    """Moments of each length of vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            for dims, _, x in _by_length(batch, scale, shift):
                held.setdefault(dims, Moments(dims)).add(x)
        yield _states(held)

    return merged(rows.mapInArrow(run, _STATE))


def _measured(rows: DataFrame, models: dict[int, Model], scale: int, shift: int) -> None:
    """Sets each model's largest difference between the covariance of what it whitens and the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            for dims, _, x in _by_length(batch, scale, shift):
                if models[dims].live.any():
                    y = models[dims].whitened(x)
                    held.setdefault(dims, Moments(y.shape[1])).add(y)
        yield _states(held)

    for dims, moments in merged(rows.mapInArrow(run, _STATE)).items():
        models[dims].error = float(np.abs(moments.covariance() - np.eye(len(moments.mean))).max())


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every vector that takes part."""
    rows = taking_part(vectors, vec_id=vec_id, embedding=embedding)
    models = {dims: Model(m, components) for dims, m in fit(rows, scale=scale, shift=shift).items()}
    _measured(rows, models, scale, shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, ids, x in _by_length(batch, scale, shift):
                model = models[dims]
                k = len(model.values)
                for a in range(0, len(x) if k else 0, ROWS):
                    part, own = x[a : a + ROWS], ids.slice(a, ROWS)
                    m = len(part)
                    y = np.zeros((m, k))
                    y[:, model.live] = model.whitened(part)
                    none = np.tile(~model.live, m)
                    explained = np.maximum(model.values, 0) / model.trace if model.trace > 0 else np.zeros(k)
                    yield pa.RecordBatch.from_arrays([
                        own.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                        pa.array(model.squares(part), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(y.ravel(), mask=none),
                        pa.array(np.tile(explained, m), mask=np.full(m * k, model.trace <= 0)), pa.array([model.error] * (m * k), pa.float64()),
                    ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema[vec_id].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def report(vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
