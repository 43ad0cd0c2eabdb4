"""Embedding whitening: distributed covariance, own symmetric eigensolver, broadcast projection.

1. Vectors that are null, or hold null or non-finite entries, go (in SQL). An
   entry c becomes the integer x = floor(64 * c) + 1000000; the sums S of every
   dimension are exact.
2. Each task centres its vectors, z = (n * x - S) / n with an exact numerator,
   and sums z z^T; the d x d partial sums are added in a shuffle. What the
   driver gets grows with the dimension d only, never with the rows.
3. The covariance is brought to tridiagonal form by Householder reflections;
   bisection on Sturm counts gives its leading eigenvalues, inverse iteration
   their vectors. Vectors whose eigenvalues lie close together are
   reorthogonalised against each other in every iteration. The reflections
   then carry them back.
4. The components (at most ``COMPONENTS`` x d doubles) are broadcast and every
   vector is projected in its own task.

``identity_error`` is the largest absolute entry of the whitened rows'
covariance minus the identity, from one more pass. Whitened values are linear
images of the centred z, so they are centred already.

Defined cases: an empty table, or one without a usable vector, gives no rows.
The dimension is the most frequent length (ties: the longer one); vectors of
another length go like malformed ones, as do empty ones and entries of 2^56 or
more, whose x is no long. Components whose eigenvalue is not above
``RANK_TOLERANCE`` times the largest have no whitened value and are left out:
constant vectors give no rows, a rank of r gives r components. Repeated rows
count as often as they stand; a null id stays null. A deviation of 39 digits
or more is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
RANK_TOLERANCE = 1e-11
#: Eigenvalues closer than this share of the norm are one cluster.
CLUSTER = 1e-3
#: Vectors worked on at once.
ROWS = 4096

_EPS = float(np.finfo(np.float64).eps)


# -- eigenvalues of a symmetric matrix ---------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and Householder vectors of T = Q^T A Q for a symmetric A."""
    a = np.array(matrix, np.float64)
    n = len(a)
    mirrors: list[np.ndarray | None] = []
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        if not x[1:].any():
            off[k] = x[0]
            mirrors.append(None)
            continue
        norm = np.linalg.norm(x)
        off[k] = -np.copysign(norm, x[0])
        x[0] -= off[k]
        v = x / np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    return np.diag(a).copy(), off, mirrors


def reflect_back(vector: np.ndarray, mirrors: list[np.ndarray | None]) -> np.ndarray:
    """Q y for the reflections of ``tridiagonal``."""
    y = vector.copy()
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        if v is not None:
            y[k + 1 :] -= 2 * (v @ y[k + 1 :]) * v
    return y


def sturm_count(diag: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues of T lie below each shift: negative pivots of T - shift."""
    least = max(float((off**2).max(initial=0)), 1.0) * np.finfo(np.float64).tiny * 4
    count = np.zeros(len(shifts), np.int64)
    pivot = np.ones(len(shifts))
    for i, d in enumerate(diag):
        pivot = (d - shifts) - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues of T, falling, by bisection on Sturm counts."""
    n = len(diag)
    wide = np.concatenate((np.abs(off), [0.0])) + np.concatenate(([0.0], np.abs(off)))
    norm = max(abs(float((diag - wide).min())), abs(float((diag + wide).max())))
    slack = 4 * _EPS * norm * n + np.finfo(np.float64).tiny
    rank = n - 1 - np.arange(min(most, n))  # as many eigenvalues lie below
    low = np.full(len(rank), float((diag - wide).min()) - slack)
    high = np.full(len(rank), float((diag + wide).max()) + slack)
    for _ in range(2000):
        middle = low + (high - low) / 2
        open_ = (high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high)) + _EPS * _EPS * norm) & (middle > low) & (middle < high)
        if not open_.any():
            break
        below = sturm_count(diag, off, middle) > rank
        high, low = np.where(open_ & below, middle, high), np.where(open_ & ~below, middle, low)
    return low + (high - low) / 2


class _Shifted:
    """Pivoted elimination of T - shift, for repeated solves."""

    def __init__(self, diag: np.ndarray, off: np.ndarray, shift: float, least: float) -> None:
        n = len(diag)
        a, b, c = (diag - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
        self.times, self.swapped = [0.0] * n, [False] * n
        for i, under in enumerate(off.tolist()):
            if abs(a[i]) >= abs(under):
                if abs(a[i]) < least:
                    a[i] = least
                self.times[i] = under / a[i]
                a[i + 1] -= self.times[i] * b[i]
            else:
                times, here, after = a[i] / under, a[i + 1], b[i + 1]
                a[i], a[i + 1], b[i], c[i], b[i + 1] = under, b[i] - times * here, here, after, -times * after
                self.times[i], self.swapped[i] = times, True
        if abs(a[-1]) < least:
            a[-1] = least
        self.a, self.b, self.c = a, b, c

    def solve(self, right: np.ndarray) -> np.ndarray:
        y, n = right.tolist(), len(right)
        for i in range(n - 1):
            if self.swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= self.times[i] * y[i]
        for i in range(n - 1, -1, -1):
            s = y[i] - (self.b[i] * y[i + 1] if i + 1 < n else 0.0) - (self.c[i] * y[i + 2] if i + 2 < n else 0.0)
            y[i] = s / self.a[i]
            if abs(y[i]) > 1e200:  # only the direction counts
                y = [v * 1e-200 for v in y]
        return np.array(y)


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal vectors (rows) of T for falling eigenvalues, by inverse iteration."""
    n = len(diag)
    norm = float(np.abs(diag).max(initial=0) + 2 * np.abs(off).max(initial=0)) or 1.0
    out = np.zeros((len(values), n))
    first, last_shift = 0, np.inf
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j  # a new cluster
        # equal eigenvalues get shifts a few units apart, so that their solves differ
        shift = min(value, last_shift - 4 * _EPS * norm) if j > first else value
        last_shift = shift
        solver = _Shifted(diag, off, shift, _EPS * norm)
        r = np.random.default_rng(j)
        v = r.standard_normal(n)
        for turn in range(12):
            v = v / np.linalg.norm(v)
            if turn:
                v = solver.solve(v)
                v = v / np.linalg.norm(v)
            for _ in range(2):
                v = v - out[first:j].T @ (out[first:j] @ v)
            size = np.linalg.norm(v)
            if size < 1e-8:  # lay in the cluster's span: another start
                v = r.standard_normal(n)
                continue
            v = v / size
            image = diag * v
            image[:-1] += off * v[1:]
            image[1:] += off * v[:-1]
            if turn > 2 and np.linalg.norm(image - value * v) <= 8 * n * _EPS * norm:
                break
        out[j] = v
    return out


def leading_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their unit eigenvectors as rows."""
    scale = float(np.abs(matrix).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((0, len(matrix)))
    diag, off, mirrors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diag, off, most)
    rows = np.stack([reflect_back(v, mirrors) for v in tridiagonal_vectors(diag, off, values)])
    rows *= np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(1)])[:, None]
    return values * scale, rows


# -- the Spark side ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fit: number of vectors, exact sums, eigenvalues, components (rows), trace, identity error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def _finite(column: Column) -> Column:
    return F.forall(column, lambda c: F.coalesce(F.abs(c) < float(2**56), F.lit(False)))  # NaN is the greatest value


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors without null or non-finite entries."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    return rows.where((F.size("embedding") > 0) & _finite(F.col("embedding")))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """x of every entry, one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(flat * SCALE).astype(np.int64) + SHIFT).reshape(-1, dim)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _numerators(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, exact: 64-bit where it fits, Python integers otherwise."""
    if n * int(np.abs(x).max(initial=0)) < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _sums(vectors: DataFrame, dim: int) -> tuple[int, tuple[int, ...]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            for part in _parts(batch):
                x = _integers(part.column("embedding"), dim)
                small = int(np.abs(x).max(initial=0)) < 1 << 50
                n += len(x)
                total = [a + int(b) for a, b in zip(total, (x if small else x.astype(object)).sum(0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)), pa.array([n] * dim, pa.int64())], ["i", "total", "n"]
            )

    parts = vectors.select("embedding").mapInArrow(run, "i int, total decimal(38,0), n bigint")
    rows = parts.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("i").collect()  # one row a dimension
    return rows[0]["n"], tuple(int(r["total"]) for r in rows)


def _gram(vectors: DataFrame, dim: int, width: int, rows_of) -> np.ndarray:
    """Sum over all vectors of w w^T, w = rows_of(x): width x width, added in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for part in _parts(batch):
                w = rows_of(_integers(part.column("embedding"), dim))
                total += w.T @ w
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j], pa.float64())], ["i", "j", "part"])

    cells = vectors.select("embedding").mapInArrow(run, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("part")).collect()
    out = np.zeros((width, width))
    for r in cells:  # width * (width + 1) / 2 cells
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["part"]
    return out


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The exact numerators n * x - S and the whitened values of rows x."""
    above = _numerators(x, model.n, model.sums)
    z = (above / model.n).astype(np.float64)
    return above, (z @ model.components.T) / np.sqrt(model.values)


def _dimension(vectors: DataFrame) -> int | None:
    top = vectors.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return top["dim"] if top else None


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """Whitening of all usable vectors; None where there is none."""
    vectors = usable(df, id_col, vector_col)
    dim = _dimension(vectors)
    if dim is None:
        return None
    vectors = vectors.where(F.size("embedding") == dim)
    n, sums = _sums(vectors, dim)
    centred = _gram(vectors, dim, dim, lambda x: (_numerators(x, n, sums) / n).astype(np.float64)) / n
    values, rows = leading_components(centred, most)
    keep = values > RANK_TOLERANCE * values.max(initial=0)
    model = Whitening(n, sums, values[keep], rows[keep], float(np.trace(centred)))
    if not keep.any():
        return model
    held = df.sparkSession.sparkContext.broadcast(model)
    again = _gram(vectors, dim, int(keep.sum()), lambda x: _whitened(x, held.value)[1]) / n
    return Whitening(n, sums, model.values, model.components, model.trace, float(np.abs(again - np.eye(len(again))).max()))


def transform(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row for each usable vector and component."""
    vectors = usable(df, id_col, vector_col)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return vectors.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in schema.split(", ")[1:])])
    dim, k = len(model.sums), len(model.values)
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        share = model.values / model.trace
        for batch in batches:
            for part in _parts(batch):
                x = _integers(part.column("embedding"), dim)
                above, white = _whitened(x, model)
                most = int(np.abs(above).max(initial=0))
                squares = (above if dim * most**2 < 1 << 62 else above.astype(object)) ** 2
                deviation = [Decimal(d) if d < 10**38 else None for d in map(int, squares.sum(1))]
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(rows), model.n)),
                        pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(rows)), pa.array(white.ravel()), pa.array(np.tile(share, len(x))), pa.array(np.full(len(rows), model.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.where(F.size("embedding") == dim).mapInArrow(run, schema)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Fit on all vectors of the table and transform them."""
    return transform(df, fit(df, id_col, vector_col, most), id_col, vector_col)
