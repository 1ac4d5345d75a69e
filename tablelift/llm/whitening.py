"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

1. Each vector becomes whole numbers ``floor(256 * c)``; the fit list holds each different vector once.
2. Count and sums over the fit list, exact; then the scatter, centred before multiplying: every task adds the outer
   products of its own vectors, the tasks' matrices are added entry by entry in Spark, and one matrix reaches the driver.
3. Pivoted Cholesky of the scatter, up to its numerical rank: with rows in pivot order it is ``L @ L.T``.
4. One-sided Jacobi rotates the columns of the triangular factor ``L`` itself until they are orthogonal. Their squared
   norms are the eigenvalues of the scatter, the normalised columns its eigenvectors; the scatter is never squared or
   multiplied again, so small eigenvalues keep their digits.
5. A second pass whitens every row. How far the whitened fit list's covariance is from the identity is measured.

What grows with the table stays in Spark; the driver holds d x d numbers. The fit list has no hot key: copies
are combined within tasks before they are moved.

Vectors that are null, or hold a null or non-finite entry, are left out; so are entries of 2**54 or more in size, whose
``floor(256 * c)`` has no exact long. ``dim`` is the length of the vectors; None takes the commonest one (of equally
common ones the longest), and vectors of other lengths are left out too. Rows with a null or repeated id are whitened like all
others. Where the covariance has a rank below the number of components asked for, only those of its rank come out: none
for a single different vector, or an empty table. Equal eigenvalues give any orthonormal basis of their space, the same for all rows. Other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import share_code, stored
from tablelift.llm.vectors import packed, rows_of, unpacked, whole

#: Entries from here on have no exact long.
LIMIT = 2.0**62
#: Share of the largest diagonal entry, times d and the rounding unit, below which a pivot counts as zero.
RANK_TOLERANCE = 8.0
#: Cosine at which two columns count as orthogonal, and the sweeps after which rotation ends.
ORTHOGONAL, SWEEPS = 1e-15, 60
#: Rows turned into doubles at once.
ROWS = 4096


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): ``a[order][:, order] = L @ L.T``, L lower trapezoidal with as many columns as the rank."""
    a, d = a.copy(), len(a)
    order, low = np.arange(d), np.zeros((d, d))
    least = RANK_TOLERANCE * d * np.finfo(float).eps * max(float(np.diagonal(a).max(initial=0.0)), 0.0)
    for k in range(d):
        rest = np.diagonal(a)[k:]
        p = k + int(np.argmax(rest))
        if a[p, p] <= least:
            return low[:, :k], order
        if p != k:
            a[[k, p]] = a[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
            low[[k, p]], order[[k, p]] = low[[p, k]], order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return low, order


def jacobi_columns(low: np.ndarray) -> np.ndarray:
    """The columns of ``low @ V`` for the rotations V that make them orthogonal, longest first.

    A sweep is a round robin: in each of its steps all columns are paired, and the disjoint pairs turn together.
    """
    u, r = low.copy(), low.shape[1]
    size = r + r % 2
    for _ in range(SWEEPS):
        turned = False
        ring = np.arange(size)
        for _ in range(size - 1):
            left, right = ring[: size // 2], ring[size // 2 :][::-1]
            real = (left < r) & (right < r)
            i, j = left[real], right[real]
            x, y = u[:, i], u[:, j]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            off = np.abs(xy) > ORTHOGONAL * np.sqrt(xx * yy)
            if off.any():
                turned = True
                i, j, x, y = i[off], j[off], x[:, off], y[:, off]
                zeta = (yy[off] - xx[off]) / (2.0 * xy[off])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                s = c * t
                u[:, i], u[:, j] = c * x - s * y, s * x + c * y
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if not turned:
            break
    return u[:, np.argsort(-(u * u).sum(axis=0), kind="stable")]


@dataclass(frozen=True)
class Whitening:
    """Fit of a table: vectors ``n``, their exact sums, eigenvalues of the covariance and unit components (columns)."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    components: np.ndarray
    identity_error: float = 0.0

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, in doubles: the whole numbers ``n * x - sums`` are exact before they are divided."""
        return self._apart(x).astype(np.float64) / self.n

    def _apart(self, x: np.ndarray) -> np.ndarray:
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)**2, exact."""
        apart = self._apart(x)
        if apart.dtype != object and self.dim * int(np.abs(apart).max(initial=0)) ** 2 < 1 << 62:
            return (apart * apart).sum(axis=1).tolist()
        return [sum(int(c) ** 2 for c in row) for row in apart]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)


def _exact_sums(x: np.ndarray) -> list[int]:
    if int(np.abs(x).max(initial=0)) * max(1, len(x)) < 1 << 62:
        return x.sum(axis=0).tolist()
    return [int(s) for s in x.astype(object).sum(axis=0)]


def _added(fit: DataFrame, dim: int, matrix, size: int) -> np.ndarray:
    """Sum over the fit list of ``matrix(x)``, ``size`` doubles for a batch: added in each task, then in Spark."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total += matrix(unpacked(batch.column(0).slice(at, ROWS), dim))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    out = np.zeros(size)
    for r in fit.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def _common_length(rows: DataFrame) -> int:
    sizes = rows.where("v IS NOT NULL").groupBy(F.size("v").alias("d")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return most["d"] if most else 0


def fit_list(rows: DataFrame, dim: int) -> DataFrame:
    """Each different vector once, packed."""

    def run(batches):
        for batch in batches:
            _, x = whole(batch, dim, LIMIT)
            yield pa.RecordBatch.from_arrays([pa.array(packed(x), pa.binary())], names=["x"])

    return stored(rows.mapInArrow(run, "x binary").distinct())


def fit(rows: DataFrame, dim: int, k: int) -> Whitening:
    """The leading ``k`` components of the table's fit list."""
    chosen = fit_list(rows, dim)

    def sums(batches):
        n, total = 0, [0] * dim
        for batch in batches:
            x = unpacked(batch.column(0), dim)
            n += len(x)
            total = [a + b for a, b in zip(total, _exact_sums(x))]
        values = [Decimal(v) for v in (n, *total)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["i", "v"])

    added = dict(chosen.mapInArrow(sums, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").cast("string").alias("v")).toLocalIterator())
    n, total = int(added.get(0, 0)), tuple(int(added.get(i + 1, 0)) for i in range(dim))
    none = Whitening(n, total, 0.0, np.zeros(0), np.zeros((dim, 0)))
    if n == 0 or dim == 0:
        return none
    upper = np.triu_indices(dim)

    def outer(x):
        c = none.centred(x)
        return (c.T @ c)[upper]

    scatter = np.zeros((dim, dim))
    scatter[upper] = _added(chosen, dim, outer, len(upper[0]))
    scatter = np.triu(scatter) + np.triu(scatter, 1).T
    low, order = pivoted_cholesky(scatter)
    turned = jacobi_columns(low)
    norms = np.sqrt((turned * turned).sum(axis=0))
    components = np.empty_like(turned)
    components[order] = turned / norms
    k = min(k, len(norms))
    found = Whitening(n, total, float(np.trace(scatter)) / n, (norms * norms / n)[:k], components[:, :k])
    if k == 0:
        return found
    # The whitened fit list itself is measured: means taken off before its covariance is formed.
    mean = _added(chosen, dim, lambda x: found.whitened(x).sum(axis=0), k) / n

    def squares(x):
        w = found.whitened(x) - mean
        return (w.T @ w).ravel()

    covariance = _added(chosen, dim, squares, k * k).reshape(k, k) / n
    return Whitening(n, total, found.trace, found.values, found.components, float(np.abs(covariance - np.eye(k)).max()))


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row for each remaining vector and component."""
    spark, dim, k = rows.sparkSession, model.dim, len(model.values)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        explained = m.values / m.trace
        for batch in batches:
            ids, x = whole(batch, dim, LIMIT)
            for at in range(0, len(x), ROWS):
                part = x[at : at + ROWS]
                n = len(part)
                deviation = [Decimal(v) for v in m.deviation(part)]
                each = np.repeat(np.arange(n), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, n).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, m.n)),
                     pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)), pa.array(m.whitened(part).ravel()),
                     pa.array(np.tile(explained, n)), pa.array(np.full(n * k, m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema) if k else spark.createDataFrame([], schema)


def whitened(embeddings: DataFrame, k: int = 4, dim: int | None = None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (1 to ``k``), n, deviation (exact), whitened, explained and identity_error."""
    share_code(embeddings.sparkSession)
    rows = rows_of(embeddings, id, vector)
    return apply(rows, fit(rows, _common_length(rows) if dim is None else dim, k))
