"""Statistics over many columns, as matrices of Arrow batches.

An expression for each pair of columns is fine for a dozen columns; at some
hundred the plan itself (d * (d + 1) / 2 aggregates) is the cost.  Here a task turns
its batches into one array of partial sums, and arrays meet ``FAN`` at a time
in a tree of tasks, so what the driver gets is a few d x d arrays, whatever the
number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions.exprs import present

FAN = 64             # arrays that one task reduces to one
_EPS = float(np.finfo(np.float64).eps)


def reduce_arrays(rows: DataFrame, leaf: Callable[[np.ndarray], np.ndarray], merge: Callable[[np.ndarray, np.ndarray], np.ndarray],
                  fan: int = FAN) -> np.ndarray | None:
    """``leaf`` of every batch of ``rows`` (its double columns as a matrix,
    missing values as NaN), merged to one flat array; None without rows."""
    d = len(rows.columns)

    def level(arrays: Callable[[pa.RecordBatch], Iterator[np.ndarray]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for part in arrays(b):
                    total = part if total is None else merge(total, part)
            if total is not None:
                yield pa.RecordBatch.from_pydict({"a": pa.array([total.tolist()], pa.list_(pa.float64()))})
        return run

    def of_rows(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        if b.num_rows:
            yield leaf(np.column_stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(d)]).astype(np.float64, copy=False))

    def of_arrays(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        for k in range(b.num_rows):
            yield b.column(0).slice(k, 1).flatten().to_numpy()

    found = rows.mapInArrow(level(of_rows), "a array<double>").checkpoint(eager=True)
    while (n := found.count()) > fan:
        found = found.repartition(-(-n // fan)).mapInArrow(level(of_arrays), "a array<double>").checkpoint(eager=True)
    out = None
    for r in found.collect():
        out = np.array(r[0]) if out is None else merge(out, np.array(r[0]))
    return out


def co_moments(df: DataFrame, columns: list[str]) -> dict[str, np.ndarray]:
    """Over the rows where both columns of a pair are present: n, s (sums of
    the first), p (sums of products), q (sums of squares of the first), each
    d x d, of values less ``centre``."""
    d = len(columns)
    means = df.agg(*[F.avg(present(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    centre = np.array([m if m is not None else 0.0 for m in means])

    def leaf(x: np.ndarray) -> np.ndarray:
        there = ~np.isnan(x)
        z, m = np.where(there, x - centre, 0.0), there.astype(np.float64)
        return np.concatenate([(m.T @ m).ravel(), (z.T @ m).ravel(), (z.T @ z).ravel(), ((z * z).T @ m).ravel()])

    flat = reduce_arrays(df.select(*[present(c).alias(f"x{i}") for i, c in enumerate(columns)]), leaf, np.add)
    parts = (flat if flat is not None else np.zeros(4 * d * d)).reshape(4, d, d)
    return dict(zip("nspq", parts, strict=True)) | {"centre": centre}


def corr_wide(df: DataFrame, columns: list[str], digits: int = 8) -> DataFrame:
    """(col_a, col_b, corr) of every pair, as ``profile.corr_matrix`` gives it,
    for any number of columns the driver holds d x d numbers of."""
    m = co_moments(df, columns)
    n, s, p, q, c = (m[k] for k in ("n", "s", "p", "q", "centre"))
    spread = n * q - s * s
    # What rounding of the centre leaves of a constant column counts as zero.
    noise = (n * 8 * _EPS * np.maximum(np.abs(c), 1e-300)[:, None]) ** 2
    spread = np.where(spread <= noise, 0.0, spread)
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = (n * p - s * s.T) / np.sqrt(spread * spread.T)
    corr = np.where((spread > 0) & (spread.T > 0), np.clip(corr, -1, 1), np.nan)
    np.fill_diagonal(corr, np.where(np.diag(spread) > 0, 1.0, np.nan))
    rows = [(a, b, None if np.isnan(corr[i, j]) else float(corr[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double").withColumn("corr", F.round("corr", digits))
