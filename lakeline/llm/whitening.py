"""Whitening of embeddings by spectrum slicing.

Entries are quantised to whole numbers, x = floor(scale * c) + shift.  Exact
integer sums give the mean and, over the vectors less the whole part of their
mean, the covariance (the rest of the mean is taken off exactly, in whole
numbers, before the one division).  Its leading eigenvalues are isolated by
spectrum slicing: the LDL' factors of V - s*I have as many negative pivots as
V has eigenvalues below s, so bisection on counts ends with one eigenvalue in
an interval.  Rayleigh quotient iteration, which converges cubically, starts
inside; a result that leaves its interval is thrown away and the interval
halved.  Two more counts beside the result certify its number.  Eigenvalues
that no count can separate are one multiple eigenvalue, whose vectors are made
orthogonal as they are found.

Defined results: a null vector, an empty one, or one with a null or non-finite
entry is dropped, and so is one whose length isn't the most common one (of two
as common, the longer).  Repeated rows and null ids count and are returned as
rows of their own.  Quantised entries stop at +-2**60; a deviation of more
than 38 digits is null.  Directions without variance, to the precision of
doubles, have no component, so equal vectors, one vector or an empty table
give an empty result.

Scale: four passes (quantise, sums, moments, result with the measured
identity error before it), no shuffle of vectors.  A task returns one row for
each sum: d, d * (d + 1) / 2 and k * (k + 1) / 2 of them, added up by key; the
driver gets these and solves a d x d problem, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import OUT_ROWS, written

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
_MOST = 1 << 60
_DIGIT = 19            # bits of a digit beside its sign; see _products
_ROWS = 1 << 14
_PIVOT = (1 + 17 ** 0.5) / 8
_EPS = float(np.finfo(np.float64).eps)
SCHEMA = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


# --- rows ------------------------------------------------------------------

def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has entries, all of them finite numbers."""
    v = F.col(vector).cast("array<double>")
    return df.where(F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False)))


def one_length(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows whose vector has the most common length, and that length."""
    found = df.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = found["d"] if found else 0
    return df.where(F.size(vector) == d), d


def matrix(column: pa.Array) -> np.ndarray:
    """Arrow lists of one length as a matrix."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> tuple[DataFrame, int]:
    """(id, x) of the usable rows as a written table, and the length of x."""
    rows = usable(df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")), "v")
    x = F.transform("v", lambda c: F.greatest(F.lit(float(-_MOST)), F.least(F.lit(float(_MOST)), F.floor(c * scale).cast("double"))).cast("long") + shift)
    return one_length(written(rows.select("id", x.alias("x")), "quantised"), "x")


# --- sums over all rows ----------------------------------------------------

def _products(z: np.ndarray) -> np.ndarray:
    """Exact sums z'z as Python numbers.  Signed digits of 20 bits: products of
    two, over at most 2**14 rows, are whole numbers that doubles hold."""
    digits, rest = [], z
    while not digits or rest.any():
        low = ((rest + (1 << _DIGIT)) & ((2 << _DIGIT) - 1)) - (1 << _DIGIT)
        digits.append(low.astype(np.float64))
        rest = (rest - low) >> (_DIGIT + 1)
    out = np.zeros((z.shape[1], z.shape[1]), object)
    for lo in range(0, len(z), _ROWS):
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                out += (a[lo: lo + _ROWS].T @ b[lo: lo + _ROWS]).astype(np.int64).astype(object) * (1 << ((_DIGIT + 1) * (i + j)))
    return out


def _sums(rows: DataFrame, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> list:
    """The sum over all batches of the vectors that ``of`` makes of a batch;
    each task adds up its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = of(matrix(b.column(0)))
                total = part if total is None else total + part
        if total is not None:
            values = [Decimal(int(v)) for v in total] if kind != "double" else total.tolist()
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(values)), pa.int32()), "v": pa.array(values, pa.float64() if kind == "double" else pa.decimal128(38, 0))})

    found = rows.select("x").mapInArrow(run, f"k int, v {kind}").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    return [r["v"] if kind == "double" else int(r["v"]) for r in found]


class Moments:
    """n, the sums S, the whole parts ``middle`` of the mean, and V."""

    def __init__(self, rows: DataFrame, d: int):
        first = _sums(rows, "decimal(38,0)", lambda x: np.concatenate([[len(x)], x.astype(object).sum(0)]))
        self.n, self.sums = (first[0], first[1:]) if first else (0, [])
        if not self.n:
            return
        self.middle = np.array([s // self.n for s in self.sums], np.int64)
        middle, (a, b) = self.middle, np.triu_indices(d)
        second = _sums(rows, "decimal(38,0)", lambda x: _products(x - middle)[a, b])
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, middle, strict=True)]  # sums of x - middle
        self.covariance = np.zeros((d, d))
        for i, j, c in zip(a, b, second, strict=True):
            self.covariance[i, j] = self.covariance[j, i] = (self.n * c - self.rest[i] * self.rest[j]) / self.n ** 2
        # Exact up to this division.
        self.trace = float(np.trace(self.covariance))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean."""
        return (x - self.middle) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """Sum of (n*x - S)**2 of each row, exact; null beyond 38 digits."""
        z = x - self.middle
        if (self.n * int(np.abs(z).max()) + max(map(abs, self.rest))) ** 2 * z.shape[1] >= 1 << 62:
            z = z.astype(object)
        y = z * self.n - np.array(self.rest, z.dtype)
        return [Decimal(int(v)) if v < 10 ** 38 else None for v in (y * y).sum(1)]


# --- spectrum slicing ------------------------------------------------------

class Factors:
    """P (A - s*I) P' = L D L' with pivots of one or two rows, the largest first."""

    def __init__(self, a: np.ndarray, s: float, tiny: float):
        n = len(a)
        self.order, self.pivots = np.arange(n), []
        w = a - s * np.eye(n)
        self.lower, k = w, 0
        while k < n:
            size = np.abs(w[k:, k:])
            beside = size.copy()
            np.fill_diagonal(beside, 0)
            r, (p, q) = int(size.diagonal().argmax()), sorted(divmod(int(beside.argmax()), n - k))
            if size[r, r] >= _PIVOT * beside[p, q] or beside[p, q] < tiny:
                self._swap(k, k + r)
                if abs(w[k, k]) < tiny:
                    w[k, k] = tiny  # s is an eigenvalue, to rounding
                left, pivot = w[k + 1:, k].copy(), w[k: k + 1, k: k + 1].copy()
                w[k + 1:, k] = left / pivot[0, 0]
                w[k + 1:, k + 1:] -= np.outer(left, left) / pivot[0, 0]  # symmetric to the last bit
            else:
                self._swap(k, k + p)
                self._swap(k + 1, k + q)
                left, pivot = w[k + 2:, k: k + 2].copy(), w[k: k + 2, k: k + 2].copy()
                w[k + 2:, k: k + 2] = left @ np.linalg.inv(pivot)
                update = w[k + 2:, k: k + 2] @ left.T
                w[k + 2:, k + 2:] -= (update + update.T) / 2
            self.pivots.append((k, pivot))
            k += len(pivot)

    def _swap(self, i: int, j: int) -> None:
        if i != j:
            w = self.lower
            w[[i, j]] = w[[j, i]]
            w[:, [i, j]] = w[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]

    @property
    def negative(self) -> int:
        """How many eigenvalues are negative; a pivot of two rows has one."""
        return sum(1 if len(p) == 2 else int(p[0, 0] < 0) for _, p in self.pivots)

    def solve(self, b: np.ndarray) -> np.ndarray:
        y = b[self.order]
        for k, p in self.pivots:
            y[k + len(p):] -= self.lower[k + len(p):, k: k + len(p)] @ y[k: k + len(p)]
        for k, p in reversed(self.pivots):
            m = len(p)
            y[k: k + m] = np.linalg.solve(p, y[k: k + m]) - self.lower[k + m:, k: k + m].T @ y[k + m:]
        out = np.empty_like(y)
        out[self.order] = y
        return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the symmetric positive
    semidefinite ``a``: the ``k`` largest, falling, but none without variance."""
    n, norm = len(a), float(np.abs(a).sum(1).max(initial=0))
    tol = 4 * n * _EPS * norm
    seen: dict[float, int] = {-tol: 0, norm * (1 + 8 * _EPS) + tol: n}

    def below(s: float) -> int:
        if s not in seen:
            seen[s] = Factors(a, s, _EPS * _EPS * norm).negative
        return seen[s]

    values, vectors = [], []
    for j in range(min(k, n) if norm > 0 else 0):
        at = n - 1 - j  # eigenvalues below number j
        lo = max(s for s, c in seen.items() if c <= at)
        hi = min(s for s, c in seen.items() if c > at and s > lo)

        def halve(lo: float, hi: float) -> tuple[float, float]:
            mid = (lo + hi) / 2
            return (mid, hi) if below(mid) <= at else (lo, mid)

        while below(hi) - below(lo) > 1 and hi - lo > tol:
            lo, hi = halve(lo, hi)
        if hi <= 2 * tol:
            break  # no variance left
        close = [v for e, v in zip(values, vectors, strict=True) if e - hi <= 1e-3 * norm]
        while True:
            value, vector = _quotients(a, lo, hi, close, norm, j)
            near = max(tol, 2 * float(np.linalg.norm(a @ vector - value * vector)))
            if lo - tol <= value <= hi + tol and near <= 16 * tol and below(value - near) <= at < below(value + near):
                break
            if hi - lo <= tol:
                raise ArithmeticError(f"eigenvalue {j + 1} between {lo} and {hi} was not certified")
            lo, hi = halve(lo, hi)
        if value <= 2 * tol:
            break
        values.append(value)
        vectors.append(vector)
    return np.array(values), np.array(vectors).T.reshape(n, len(vectors))


def _quotients(a: np.ndarray, lo: float, hi: float, close: list[np.ndarray], norm: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from inside (lo, hi), orthogonal to ``close``."""
    def unit(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for v in close:
                x = x - (v @ x) * v
        return x / np.linalg.norm(x)

    x, value, last = unit(np.random.default_rng(seed).standard_normal(len(a))), (lo + hi) / 2, np.inf
    for turn in range(40):
        x = unit(Factors(a, value, _EPS * _EPS * norm).solve(x))
        quotient = float(x @ a @ x)
        left = float(np.linalg.norm(a @ x - quotient * x))
        if turn < 2 and not lo <= quotient <= hi:
            continue  # the shift stays until the vector is of this interval
        if left >= last / 2:
            break
        value, last = quotient, left
    return float(x @ a @ x), x


# --- the operator ----------------------------------------------------------

def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row
    for each usable vector and component."""
    spark = df.sparkSession
    rows, d = quantised(df, id_col, vector_col, scale, shift)
    m = Moments(rows, d) if d else None
    values, vectors = leading(m.covariance, components) if m and m.n else (np.zeros(0), None)
    k = len(values)
    if not k:
        return spark.createDataFrame([], SCHEMA).withColumnRenamed("id", id_col)
    to = vectors / np.sqrt(values)
    a, b = np.triu_indices(k)

    def second(x: np.ndarray) -> np.ndarray:
        w = m.centred(x) @ to
        return np.concatenate([w.sum(0), (w.T @ w)[a, b]])

    got = np.array(_sums(rows, "double", second)) / m.n
    error = float(np.abs(got[k:] - got[:k][a] * got[:k][b] - (a == b)).max())
    explained = values / m.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, OUT_ROWS // k)
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                part = whole.slice(lo, step)
                x, n = matrix(part.column(1)), part.num_rows
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_pydict({
                    "id": part.column(0).take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), "n": pa.array(np.full(n * k, m.n, np.int64)),
                    "deviation": pa.array(m.deviations(x), pa.decimal128(38, 0)).take(each), "whitened": pa.array((m.centred(x) @ to).ravel()),
                    "explained": pa.array(np.tile(explained, n)), "identity_error": pa.array(np.full(n * k, error))})

    return rows.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)
