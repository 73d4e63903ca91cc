"""Embedding whitening by spectrum slicing.

The covariance of the distinct vectors is summed over Spark's tasks; what is left is a
matrix of the vectors' dimension. An LDL' factorisation of it, shifted by a number,
has as many positive pivots as there are eigenvalues above that number (Sylvester).
Bisection over these counts isolates each leading eigenvalue, Rayleigh quotient
iteration from inside the interval converges cubically to its vector, and counts
just above and below the result certify its number. Eigenvalues closer to each other
than rounding can part are iterated together, each vector orthogonal to the ones before.

Vectors become integers ``floor(scale * c) + shift`` first; distances from the mean are
then exact: ``n * x - S`` with ``S`` the sums over the ``n`` distinct vectors.

Defined cases: rows whose vector is null, or holds a null, a non-finite entry or one
whose integer lies beyond 53 bits, are dropped, and so are rows whose vector is not as
long as most are (of equally many, the longest); repeated rows and ids each have their
rows; null ids are kept; ``deviation`` is null where it does not fit 64 bits. Components
with no variance beyond rounding are not given, so equal vectors, a single vector, an
empty table or vectors of no length have no rows. Other columns are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsline.llm.shared import require, write_scratch

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
_EPS = float(np.finfo(np.float64).eps)
#: Matrices summed by one task, until no more than this many are left for the driver.
_FAN_IN = 16


# --- the eigenvalues of a symmetric matrix ---------------------------------------------------

_PIVOT_BOUND = (1 + 17 ** 0.5) / 8


class Factors:
    """``P A P' = L D L'`` of a symmetric matrix, D of blocks of one or two, pivots after Bunch and Kaufman."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, np.float64)
        n = len(a)
        self.order, self.below, self.blocks = np.arange(n), np.eye(n), []
        k = 0
        while k < n:
            pair = False
            down = np.abs(a[k + 1:, k])
            if len(down) and down.max() > 0:
                r = k + 1 + int(down.argmax())
                most, own = down.max(), abs(a[k, k])
                if own < _PIVOT_BOUND * most:
                    across = np.delete(np.abs(a[k:, r]), r - k).max()
                    if own * across >= _PIVOT_BOUND * most * most:
                        pass
                    elif abs(a[r, r]) >= _PIVOT_BOUND * across:
                        self._swap(a, k, r)
                    else:
                        self._swap(a, k + 1, r)
                        pair = True
            width = 2 if pair else 1
            block = a[k:k + width, k:k + width].copy()
            rest = a[k + width:, k:k + width].copy()
            if pair or block[0, 0] != 0:
                factor = np.linalg.solve(block, rest.T).T
                self.below[k + width:, k:k + width] = factor
                a[k + width:, k + width:] -= factor @ rest.T
            self.blocks.append((k, block))
            k += width

    def _swap(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            k = min(i, j)
            self.below[[i, j], :k] = self.below[[j, i], :k]
            self.order[[i, j]] = self.order[[j, i]]

    def positive(self) -> int:
        return sum(int((np.linalg.eigvalsh(b) > 0).sum()) for _, b in self.blocks)

    def solve(self, v: np.ndarray, least: float) -> np.ndarray:
        """A solution of ``A x = v``; pivots below ``least`` count as it, as the direction is what is wanted."""
        y = v[self.order].astype(np.float64)
        n = len(y)
        for k in range(n):
            y[k + 1:] -= self.below[k + 1:, k] * y[k]
        for k, block in self.blocks:
            w = len(block)
            if w == 1:
                d = block[0, 0]
                y[k] /= d if abs(d) >= least else (least if d >= 0 else -least)
            else:
                y[k:k + w] = np.linalg.solve(block, y[k:k + w])
        for k in range(n - 1, -1, -1):
            y[k] -= self.below[k + 1:, k] @ y[k + 1:]
        out = np.empty(n)
        out[self.order] = y
        return out


class Spectrum:
    """Counts of the eigenvalues of a symmetric matrix above any number, and its leading pairs."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.n = matrix, len(matrix)
        self.norm = float(np.abs(matrix).sum(axis=1).max()) if self.n else 0.0
        self.rounding = 4 * _EPS * max(self.norm, 1e-300)
        self.known = {2 * self.norm + 1: 0, -(2 * self.norm + 1): self.n}

    def shifted(self, at: float) -> Factors:
        return Factors(self.matrix - at * np.eye(self.n))

    def above(self, at: float) -> int:
        """Number of eigenvalues above ``at``."""
        if at not in self.known:
            self.known[at] = self.shifted(at).positive()
        return self.known[at]

    def bracket(self, j: int) -> tuple[float, float]:
        """The narrowest known ``low, high`` with the j-th largest eigenvalue between them."""
        return (max(s for s, c in self.known.items() if c >= j), min(s for s, c in self.known.items() if c < j))

    def isolate(self, j: int) -> tuple[float, float]:
        """A bracket that holds the j-th eigenvalue alone, or one too narrow to be cut."""
        low, high = self.bracket(j)
        while not (self.above(low) == j and self.above(high) == j - 1) and high - low > 8 * self.rounding:
            self.above((low + high) / 2)
            low, high = self.bracket(j)
        return low, high

    def _iterate(self, low: float, high: float, before: np.ndarray, alone: bool) -> tuple[float, np.ndarray, bool]:
        """Rayleigh quotient iteration from the middle of a bracket, orthogonal to the vectors ``before``."""
        rng = np.random.default_rng(len(before))
        clean = lambda y: y - before.T @ (before @ y) if len(before) else y
        v = clean(clean(rng.standard_normal(self.n)))
        v /= np.linalg.norm(v)
        at, least = (low + high) / 2, _EPS * max(self.norm, 1e-300)
        quotient = at
        for turn in range(12):
            y = clean(clean(self.shifted(at).solve(v, least)))
            v = y / np.linalg.norm(y)
            quotient = float(v @ self.matrix @ v)
            inside = low - self.rounding <= quotient <= high + self.rounding
            if float(np.linalg.norm(self.matrix @ v - quotient * v)) <= 2 * self.rounding and turn and inside:
                return quotient, v, True
            # the quotient is the better shift once it lies in the bracket
            at = quotient if inside and alone else (low + high) / 2
        return quotient, v, low - self.rounding <= quotient <= high + self.rounding

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The largest eigenvalues beyond rounding, falling, and their unit vectors as rows."""
        floor = 16 * self.n * self.rounding
        count = min(most, self.above(floor)) if self.norm > 0 else 0
        values, vectors = [], np.zeros((0, self.n))
        for j in range(1, count + 1):
            low, high = self.isolate(j)
            while True:
                alone = self.above(low) == j and self.above(high) == j - 1
                value, v, inside = self._iterate(low, high, vectors, alone)
                if inside and self._certain(j, value):
                    break
                if high - low <= 8 * self.rounding:
                    break  # a group that rounding cannot part: any orthogonal vectors of it will do
                self.above((low + high) / 2)
                low, high = self.bracket(j)
            values.append(value)
            vectors = np.vstack([vectors, v])
        return np.array(values), vectors

    def _certain(self, j: int, value: float) -> bool:
        """Whether the counts on both sides say that ``value`` is the j-th eigenvalue."""
        return self.above(value - 16 * self.rounding) >= j and self.above(value + 16 * self.rounding) < j


# --- sums over Spark's tasks -----------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def points(rows: DataFrame, vec_id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """``(vec_id, x)`` of the usable rows, ``x`` as integers; written once."""
    def whole(batches):
        for batch in batches:
            column = batch.column(1)
            values = np.asarray(column.flatten().fill_null(np.nan), np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * values) + shift
            good = np.abs(x) < 2.0 ** 53
            sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            bad = np.bincount(row[~good], minlength=len(sizes)) > 0
            keep = ~bad & np.asarray(column.is_valid())
            kept = x[keep[row]].astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept))],
                names=["vec_id", "x"])

    given = rows.select(F.col(f"`{vec_id}`").cast("long"), F.col(f"`{vector}`").cast("array<double>"))
    return write_scratch(given.mapInArrow(whole, "vec_id long, x array<long>"), "whitening-points")


def _summed(parts: DataFrame) -> np.ndarray | None:
    """The sum of one list of doubles a task: by tasks of a few at a time, then the last few on the driver."""
    def add(batches):
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.asarray(batch.column(0)[i].values)
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])

    parts = write_scratch(parts, "whitening-sums")
    left = parts.count()
    while left > _FAN_IN:
        left = -(-left // _FAN_IN)
        parts = write_scratch(parts.repartition(left).mapInArrow(add, "part array<double>"), "whitening-sums")
    rows = [np.array(r["part"]) for r in parts.collect()]
    return np.sum(rows, axis=0) if rows else None


def _products(fit: DataFrame, project) -> np.ndarray | None:
    """The sum over all rows of ``z z'``, ``z`` what ``project`` makes of the row, flat."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                z = project(_matrix(batch.column(0)))
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["part"])

    return _summed(fit.select("x").mapInArrow(run, "part array<double>"))


class Whitening:
    """What has been fitted: the count, sums and whitening of the distinct vectors."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums = n, sums
        self.values, self.vectors, self.trace = values, vectors, trace
        self.base = np.array([round(Fraction(s, n)) for s in sums], np.int64)  # the mean's integer part, exactly
        self.rest = np.array([float(Fraction(s, n) - int(b)) for s, b in zip(sums, self.base)])
        self.left = np.array([s - n * int(b) for s, b in zip(sums, self.base)], object)
        self.error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over the dimensions of ``(n x - S) ** 2``, exact."""
        away = x - self.base
        most = int(np.abs(away).max(initial=0)) * self.n + max((abs(int(v)) for v in self.left), default=0)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return pa.array(((self.n * away - self.left.astype(np.int64)) ** 2).sum(axis=1))
        wide = ((self.n * away.astype(object) - self.left) ** 2).sum(axis=1)
        return pa.array([v if v < 1 << 63 else None for v in wide.tolist()], pa.int64())


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``points``; None where nothing varies."""
    distinct = write_scratch(points.select("x").distinct(), "whitening-fit")

    def add(batches):
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column(0)).sum(axis=0)
                n, total = n + batch.num_rows, own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))),
                                              pa.array(np.concatenate([[n], total]))], names=["at", "s"])

    rows = distinct.mapInArrow(add, "at long, s long").groupBy("at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # a row for each dimension
    sums = [int(s) for _, s in sorted((r["at"], r["s"]) for r in rows)]
    if len(sums) < 2:
        return None
    n, sums = sums[0], sums[1:]
    d = len(sums)
    fitted = Whitening(n, sums, np.ones(0), np.zeros((0, d)), 0.0)
    covariance = _products(distinct, fitted.centred).reshape(d, d) / n
    covariance = (covariance + covariance.T) / 2
    fitted.trace = float(np.trace(covariance))
    fitted.values, fitted.vectors = Spectrum(covariance).leading(components)
    if not len(fitted.values):
        return None
    k = len(fitted.values)
    fitted.error = float(np.abs(_products(distinct, fitted.whiten).reshape(k, k) / n - np.eye(k)).max())
    return fitted


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every usable row."""
    require(rows, vec_id, vector)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    usable = points(rows, vec_id, vector, scale, shift)
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    usable = usable.where(F.size("x") == (lengths["d"] if lengths else 0))
    fitted = fit(usable, components) if lengths and lengths["d"] else None
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = len(fitted.values)
    explained = fitted.values / fitted.trace

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            every = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, fitted.n)), fitted.deviations(x).take(every),
                 pa.array(fitted.whiten(x).ravel()), pa.array(np.tile(explained, len(x))),
                 pa.array(np.full(len(x) * k, fitted.error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(project, schema)
