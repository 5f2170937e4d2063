"""Linear regression from distributed sums and factors.

- Normal equations and batch descent need only the Gram matrix ``G = X'X`` and
  ``b = X'y`` (with an intercept column of ones): one aggregate pass, and the
  d x d algebra runs on the driver.
- The pseudo-inverse comes from a tall-skinny QR factorisation: each Arrow
  batch is reduced to the triangular factor of [X y], factors are stacked and
  reduced again in a tree, and the last one has the singular values of X
  itself.  (Those of G are squared: a design of condition 1e9 would lose all
  digits there.)
- Mini-batch descent: a step on a batch is an affine map of the coefficients,
  so runs of batches are composed to one map where their rows lie, and the
  driver applies the maps in order.  The result is that of the serial loop.
  Rows are stored, dealt out and sorted as blocks of 8-byte words, by array
  operations; Spark moves blocks, not rows.

Rows with a null or NaN in a feature or the target take no part.  A fit
without any row raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.functions import fixed
from lakeline.functions.exprs import present
from lakeline.operators.wide import FAN, reduce_arrays
from lakeline.session import scratch_path, shuffles_removed

INTERCEPT = "intercept"
BATCH_ROWS = 20      # rows of a mini-batch
TOGETHER = 8         # epochs whose rows are dealt out by one job, at most
JOB_ROWS = 20_000_000  # rows that a job of more than one epoch deals out, at most
TASK_BYTES = 1 << 25  # rows of a slice of a job's epochs, about
LEAST_ROWS = 100_000  # rows of such a slice, where more slices than that size asks for keep all cores busy
BLOCK_BYTES = 1 << 16  # a stored block of rows
GROUP_BYTES = 1 << 23  # a row group of blocks
CHUNK_BYTES = 1 << 21  # rows that a task deals out at a time: they stay in a core's cache
CELL_BYTES = 1 << 26  # an epoch's slice of more (a hot key) is sorted by Spark, row by row
RANK_TOL = 1e-13     # singular values below this share of the largest count as zero


def _complete(df: DataFrame, features: list[str], target: str, intercept: bool, *keep) -> DataFrame:
    """x0, x1, ... and y as doubles, of the rows that have them all."""
    cols = [present(c) for c in features]
    xs = [F.lit(1.0), *cols] if intercept else cols
    named = [c.alias(f"x{i}") for i, c in enumerate(xs)]
    ok = present(target).isNotNull()
    for c in cols:
        ok = ok & c.isNotNull()
    return df.filter(ok).select(*keep, *named, present(target).alias("y"))


def gram(df: DataFrame, features: list[str], target: str, intercept: bool = True) -> DataFrame:
    """Aggregate of the upper triangle of X'X, X'y and the row count."""
    rows, d = _complete(df, features, target, intercept), len(features) + intercept
    aggs = [F.count(F.lit(1)).alias("m")]
    for i in range(d):
        for j in range(i, d):
            aggs.append(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g_{i}_{j}"))
        aggs.append(F.sum(F.col(f"x{i}") * F.col("y")).alias(f"b_{i}"))
    return rows.agg(*aggs)


def _unpack(row, d: int):
    if not row["m"]:
        raise ValueError("no row has all features and the target")
    G = np.zeros((d, d))
    b = np.zeros(d)
    for i in range(d):
        for j in range(i, d):
            G[i, j] = G[j, i] = row[f"g_{i}_{j}"] or 0.0
        b[i] = row[f"b_{i}"] or 0.0
    return G, b, row["m"]


@dataclass
class Linear:
    terms: list[str]
    coef: np.ndarray

    def as_dict(self) -> dict:
        return dict(zip(self.terms, self.coef.tolist()))

    def predict(self, df: DataFrame, out: str = "prediction", digits: int | None = None) -> DataFrame:
        e = F.lit(0.0)
        for term, c in zip(self.terms, self.coef):
            e = e + (F.lit(float(c)) if term == INTERCEPT else F.col(term).cast("double") * F.lit(float(c)))
        return df.withColumn(out, F.round(e, digits) if digits is not None else e)

    def frame(self, spark, digits: int = 6) -> DataFrame:
        return spark.createDataFrame([(t, round(float(c), digits)) for t, c in zip(self.terms, self.coef)],
                                     "term string, coef double")


def _terms(features, intercept):
    return ([INTERCEPT] if intercept else []) + list(features)


def fit_normal(df: DataFrame, features: list[str], target: str, intercept: bool = True) -> Linear:
    """Closed form: solve (XᵀX) θ = Xᵀy."""
    G, b, _ = _unpack(gram(df, features, target, intercept).first(), len(features) + intercept)
    return Linear(_terms(features, intercept), np.linalg.solve(G, b))


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR factorisation, square: padded with zero rows where the
    input has fewer than columns."""
    d = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return r if len(r) == d else np.vstack([r, np.zeros((d - len(r), d))])


def qr_factor(rows: DataFrame, fan: int = FAN) -> np.ndarray:
    """R of the tall matrix that the double columns of ``rows`` make: a task
    reduces its batches to one R as they come, and these meet in a tree."""
    d = len(rows.columns)

    def stacked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _triangle(np.vstack([a.reshape(d, d), b.reshape(d, d)])).ravel()

    r = reduce_arrays(rows, lambda x: _triangle(x).ravel(), stacked, fan)
    if r is None:
        raise ValueError("no row has all features and the target")
    return r.reshape(d, d)


def fit_pinv(df: DataFrame, features: list[str], target: str, intercept: bool = True, rank_tol: float = RANK_TOL) -> Linear:
    """Minimum-norm least squares: the pseudo-inverse of X, by QR of [X y]."""
    r = qr_factor(_complete(df, features, target, intercept))
    return Linear(_terms(features, intercept), np.linalg.pinv(r[:-1, :-1], rcond=rank_tol) @ r[:-1, -1])


def fit_gd(df: DataFrame, features: list[str], target: str, rate: float = fixed.GD_RATE, epochs: int = fixed.GD_EPOCHS,
           intercept: bool = True) -> Linear:
    """Batch gradient descent: θ ← θ − rate · 2/m (Gθ − b), on G and b only.

    Needs scaled features (raw columns diverge at this rate)."""
    d = len(features) + intercept
    G, b, m = _unpack(gram(df, features, target, intercept).first(), d)
    theta = np.zeros(d)
    for _ in range(epochs):
        theta = theta - rate * (2.0 / m) * (G @ theta - b)
    return Linear(_terms(features, intercept), theta)


def fit_minibatch(df: DataFrame, key: str, features: list[str], target: str, epochs: int = fixed.MINIBATCH_EPOCHS,
                  batch_rows: int = BATCH_ROWS, t0: float = fixed.MINIBATCH_T0,
                  t1: float = fixed.MINIBATCH_T1, seed: int = 42,
                  intercept: bool = True, together: int = TOGETHER, slices: int | None = None) -> Linear:
    """Mini-batch descent with a t0 / (t + t1) learning schedule.

    Each epoch puts the rows in a new order, by a seeded hash of the key (ties
    by the values), and takes ``batch_rows`` of them a step, the last batch
    perhaps fewer; t counts the steps of all epochs.  A step is
    theta <- (I - e G) theta + e b with e = rate * 2 / rows, an affine map, so
    it needn't wait for theta: the hash range of an epoch is cut into
    ``slices``, each slice composes the steps of the batches that lie wholly
    inside to one map, and the driver applies the maps in order, with the
    batches that lie over an edge put together in between.  Equal to the
    serial loop up to rounding.

    Every epoch has to deal out every row.  Of a row only its hash, the
    features and the target are sent; a job deals out the rows of ``together``
    epochs (at most 8), fewer where they are more than ``JOB_ROWS``, and its
    shuffle files go when it ends, so the disk holds those of one job, not of
    all epochs.  The driver holds 2 d² numbers for each slice of a job, and
    the number of rows of each slice of all epochs."""
    d = len(features) + intercept
    spark = df.sparkSession
    names = [f"x{i}" for i in range(len(features))] + ["y"]
    width = len(names) + 1  # words of a row: hash, features, target
    rows = _blocks(_complete(df, features, target, False, F.xxhash64(key, F.lit(seed)).alias("k")))
    m = rows.agg(F.sum("n")).first()[0]
    if not m:
        raise ValueError("no row has all features and the target")
    together = max(1, min(together, TOGETHER, JOB_ROWS // m))
    cores = spark.sparkContext.defaultParallelism
    wanted = max(-(-m * together * 8 * width // TASK_BYTES), min(cores, -(-m * together // LEAST_ROWS)))
    slices = slices or (wanted if wanted < cores else -(-wanted // cores) * cores)

    with shuffles_removed(spark):
        counted = rows.select("block").mapInArrow(_counter(width, epochs, slices), "cell long, n long").groupBy("cell").agg(F.sum("n"))
        sizes = np.zeros((epochs, slices), np.int64)
        for c, n in counted.collect():
            sizes[divmod(c, slices)] = n
    start = np.cumsum(sizes, axis=1) - sizes  # rows of the epoch before each cell
    heavy = sizes > CELL_BYTES // (8 * width)
    steps = -(-m // batch_rows)

    theta, step = np.zeros(d), 0
    for first in range(0, epochs, together):
        some = range(first, min(epochs, first + together))
        begun = _Begun(len(features), intercept, batch_rows, first, slices, start[some.start:some.stop], sizes[some.start:some.stop], steps, t0, t1)
        with shuffles_removed(spark):
            dealt = rows.select("block").mapInArrow(_dealer(width, some, slices, heavy[some.start:some.stop]), "slice int, cell long, block binary") \
                .repartitionById(slices, F.col("slice"))
            got = dealt.select("cell", "block").mapInArrow(_composer(begun), _COMPOSED).collect()
            if heavy[some.start:some.stop].any():
                places = ", ".join(["slice int, place long, low long", *(f"{n} double" for n in names)])
                sliced = rows.select("block").mapInArrow(_heavy_rows(width, some, slices, heavy[some.start:some.stop]), places) \
                    .repartitionById(slices, F.col("slice")).sortWithinPartitions("place", "low", *names)
                got += sliced.select("place", *names).mapInArrow(_streamed(begun), _COMPOSED).collect()
        found = sorted((r.cell, *(np.array(v) for v in (r.head, r.move, r.tail))) for r in got)
        open_ = np.zeros(d * d + d + 1)  # sums of a batch that isn't full yet

        def close(t: int) -> None:
            nonlocal theta
            theta = _moved(theta, open_, d, t0 / (t + t1))
            open_[:] = 0

        for e in some:
            for c, head, move, tail in (f for f in found if f[0] // slices == e):
                open_ += head
                at = int(start[e, c % slices]) + int(head[-1])  # rows up to the first batch that begins in this cell
                if open_[-1] and at % batch_rows == 0:
                    close(step + at // batch_rows - 1)
                if len(move):
                    theta = move[: d * d].reshape(d, d) @ theta + move[d * d:]
                open_ += tail
            if open_[-1]:
                close(step + steps - 1)
            step += steps
    return Linear(_terms(features, intercept), theta)


def _words(batch: pa.RecordBatch) -> np.ndarray:
    """A batch of 8-byte columns as a matrix of words, a row for each row."""
    m = np.empty((batch.num_rows, batch.num_columns), np.uint64)
    for k in range(batch.num_columns):
        m[:, k] = batch.column(k).to_numpy().view(np.uint64)
    return m


def _blocks(rows: DataFrame) -> DataFrame:
    """Stored blocks of rows (a long and doubles, none missing): ``n``, the number
    of rows, and ``block``, their words."""
    most = max(1, BLOCK_BYTES // (8 * len(rows.columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _words(b)
            parts = [m[lo: lo + most] for lo in range(0, len(m), most)]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(x) for x in parts], pa.int64()), "block": pa.array([x.tobytes() for x in parts], pa.binary())})

    spark, schema = rows.sparkSession, "n long, block binary"
    path = scratch_path(spark, "minibatch-rows")
    rows.mapInArrow(run, schema).write.option("parquet.block.size", GROUP_BYTES).option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _block(value: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64).reshape(-1, width)


def _joined(blocks: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    """The rows of blocks, ``CHUNK_BYTES`` or a block more at a time."""
    held, size = [], 0
    for b in blocks:
        held.append(b)
        size += b.nbytes
        if size >= CHUNK_BYTES:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    return _joined(_block(v, width) for b in batches for v in b.column(0))


def _parted(m: np.ndarray, at: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows by their part ``at``, and where each part begins and the last ends."""
    order = np.argsort(at.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
    return np.take(m, order, axis=0), np.concatenate([[0], np.cumsum(np.bincount(at, minlength=parts))])


_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _hashed(k: np.ndarray, e: int) -> np.ndarray:
    """Spark's xxhash64(key, seed, e) for a long ``e``, from ``k``, its
    xxhash64(key, seed): each column is hashed with the hash so far as seed."""
    u, mask = np.uint64, (1 << 64) - 1
    c = e * _P2 & mask
    c = ((c << 31 | c >> 33) & mask) * _P1 & mask
    h = k + u(_P5 + 8)
    h ^= u(c)
    t = h << u(27)
    h >>= u(37)
    h |= t
    h *= u(_P1)
    h += u(_P4)
    for shift, factor in ((33, _P2), (29, _P3)):
        np.right_shift(h, u(shift), out=t)
        h ^= t
        h *= u(factor)
    np.right_shift(h, u(32), out=t)
    h ^= t
    return h


def _slices(h: np.ndarray, slices: int) -> np.ndarray:
    """The part of the hash range, of ``slices`` equal ones, that each hash lies in."""
    at = h >> np.uint64(32)
    at *= np.uint64(slices)
    at >>= np.uint64(32)
    return at.view(np.int64)


def _counter(width: int, epochs: int, slices: int):
    """For mapInArrow over blocks: the number of rows of each cell, an epoch's slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((epochs, slices), np.int64)
        for m in _chunks(batches, width):
            k = m[:, 0].copy()
            for e in range(epochs):
                n[e] += np.bincount(_slices(_hashed(k, e), slices), minlength=slices)
        cells = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int64()), "n": pa.array(n.ravel()[cells], pa.int64())})

    return run


def _dealer(width: int, some: range, slices: int, heavy: np.ndarray):
    """For mapInArrow over blocks: for each epoch of ``some`` a block for each
    slice, of the rows that lie in it, their hash as the first word.  ``heavy``:
    cells that are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = pa.array(np.arange(slices, dtype=np.int32))
        for m in _chunks(batches, width):
            k = m[:, 0].copy()
            for e in some:
                h = _hashed(k, e)
                at = _slices(h, slices)
                m[:, 0] = h
                dealt, ends = _parted(m, at, slices)
                block = pa.Array.from_buffers(pa.binary(), slices, [None, pa.py_buffer((ends * (8 * width)).astype(np.int32)), pa.py_buffer(dealt)])
                cells = pa.array(np.arange(e * slices, (e + 1) * slices))
                out = pa.RecordBatch.from_arrays([parts, cells, block], ["slice", "cell", "block"])
                sent = (np.diff(ends) > 0) & ~heavy[e - some.start]
                yield out if sent.all() else out.filter(pa.array(sent))

    return run


def _heavy_rows(width: int, some: range, slices: int, heavy: np.ndarray):
    """For mapInArrow over blocks: the rows of the cells that ``_dealer`` leaves
    out, each with its slice, its place in ``some`` epochs (3 bits of the epoch,
    60 of the hash) and the hash's other bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in _chunks(batches, width):
            for e in some:
                h = _hashed(m[:, 0], e)
                at = _slices(h, slices)
                own = np.flatnonzero(heavy[e - some.start][at])
                for lo in range(0, len(own), 10_000):
                    i = own[lo: lo + 10_000]
                    place = np.uint64((e - some.start) << 60) | h[i] >> np.uint64(4)
                    yield pa.RecordBatch.from_pydict({"slice": pa.array(at[i].astype(np.int32)), "place": pa.array(place.view(np.int64)), "low": pa.array((h[i] & np.uint64(15)).view(np.int64))}
                                                     | {f"x{j}" if j < width - 2 else "y": pa.array(m[i, j + 1].view(np.float64)) for j in range(width - 1)})

    return run


_COMPOSED = "cell long, head array<double>, move array<double>, tail array<double>"


def _summed(x: np.ndarray) -> np.ndarray:
    """X'X, X'y and the number of rows, flat; ``x``: rows of [X y]."""
    return np.concatenate([(x[:, :-1].T @ x[:, :-1]).ravel(), x[:, :-1].T @ x[:, -1], [len(x)]])


def _moved(theta: np.ndarray, sums: np.ndarray, d: int, rate: float) -> np.ndarray:
    g, b, m = sums[: d * d].reshape(d, d), sums[d * d: -1], sums[-1]
    return theta - rate * (2.0 / m) * (g @ theta - b)


def _chained(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The affine maps theta -> a[k] theta + c[k], k = 0, 1, ..., as one."""
    while len(a) > 1:
        n = len(a) // 2 * 2
        a, c = (np.concatenate([a[1:n:2] @ a[:n:2], a[n:]]),
                np.concatenate([(a[1:n:2] @ c[:n:2, :, None])[:, :, 0] + c[1:n:2], c[n:]]))
    return a[0], c[0]


@dataclass
class _Begun:
    """What composing the steps of some epochs needs to know."""
    features: int
    intercept: bool
    size: int  # rows of a batch
    first: int  # the first of the epochs
    slices: int
    start: np.ndarray  # rows of the epoch before each cell
    sizes: np.ndarray  # rows of each cell
    steps: int  # of an epoch
    t0: float
    t1: float


class _Cell:
    """Of a cell's rows, which come in order: the sums of the rows before its
    first batch, the composed map of its whole batches, and the sums of the rows
    after them."""

    def __init__(self, cell: int, b: _Begun):
        self.cell, self.b, self.d = cell, b, b.features + b.intercept
        e, k = divmod(cell, b.slices)
        self.at, self.step = int(b.start[e - b.first, k]), e * b.steps
        self.left, self.move, self.head = np.empty((0, self.d + 1)), None, np.zeros(self.d * self.d + self.d + 1)

    def add(self, part: np.ndarray) -> None:
        """``part``: rows of [X y]."""
        size, d = self.b.size, self.d
        if lack := -self.at % size:  # rows of a batch that began in an earlier cell
            self.head += _summed(part[:lack])
            self.at, part = self.at + len(part[:lack]), part[lack:]
        rows = np.vstack([self.left, part]) if len(self.left) else part
        n = len(rows) // size
        if n:
            batches = rows[: n * size].reshape(n, size, d + 1)
            sums = batches[:, :, :d].transpose(0, 2, 1) @ batches
            rate = self.b.t0 / (self.step + self.at // size + np.arange(n) + self.b.t1) * 2.0 / size
            a, c = _chained(np.eye(d) - rate[:, None, None] * sums[:, :, :d], rate[:, None] * sums[:, :, d])
            self.move = (a, c) if self.move is None else (a @ self.move[0], a @ self.move[1] + c)
            self.at += n * size
        self.left = rows[n * size:]

    def found(self) -> pa.RecordBatch:
        flat = np.concatenate([self.move[0].ravel(), self.move[1]]) if self.move is not None else np.zeros(0)
        return pa.RecordBatch.from_pydict({"cell": pa.array([self.cell], pa.int64())} | {
            n: pa.array([v.tolist()], pa.list_(pa.float64())) for n, v in (("head", self.head), ("move", flat), ("tail", _summed(self.left)))})


def _in_order(rows: np.ndarray) -> np.ndarray:
    """The order of rows of words by hash, equal ones by features and target."""
    h, n = rows[:, 0].copy(), len(rows)
    bits = max(1, (n - 1).bit_length())
    low = h.min()
    cut = max(0, int(h.max() - low).bit_length() + bits - 64)
    # The hashes' upper bits with the row's number below them: to sort words is
    # several times as fast as to sort by them.
    keys = (h - low) >> np.uint64(cut) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    keys.sort()
    order = (keys & np.uint64((1 << bits) - 1)).view(np.int64)
    found = h[order]
    if (found[1:] > found[:-1]).all():
        return order
    return np.lexsort([rows[:, k].copy().view(np.float64) for k in range(rows.shape[1] - 1, 0, -1)] + [h])


def _composer(b: _Begun):
    """For mapInArrow over (cell, block), a slice's cells whole: some
    ``TASK_BYTES``, held until all have come."""
    width, d = b.features + 2, b.features + b.intercept
    some = b.size * max(1, (1 << 22) // (8 * d * d * b.size))  # rows at a time: the maps of their batches take 4 MB or so

    def composed(cell: int, blocks: list[np.ndarray]) -> pa.RecordBatch:
        e, k = divmod(cell, b.slices)
        # Parts of the cell's hash range, so small that they are sorted in a core's cache.
        parts = max(1, 2 * int(b.sizes[e - b.first, k]) * 8 * width // CHUNK_BYTES)
        own = [[] for _ in range(parts)]
        for m in _joined(blocks):
            m, ends = _parted(m, _slices(m[:, 0], b.slices * parts) - k * parts, parts)
            for p in range(parts):
                own[p].append(m[ends[p]: ends[p + 1]])
        out = _Cell(cell, b)
        for p in range(parts):
            rows = np.concatenate(own[p])
            if not len(rows):
                continue
            rows = np.take(rows, _in_order(rows), axis=0).view(np.float64)
            if b.intercept:
                rows[:, 0] = 1.0
            else:
                rows = np.ascontiguousarray(rows[:, 1:])
            for lo in range(0, len(rows), some):
                out.add(rows[lo: lo + some])
        return out.found()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for c, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.setdefault(c, []).append(_block(v, width))
        for c in sorted(held):
            yield composed(c, held.pop(c))

    return run


def _streamed(b: _Begun):
    """For mapInArrow over rows (place, features..., y) sorted by place."""
    width = b.features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            place = batch.column(0).to_numpy()
            cells = (b.first + (place >> 60)) * b.slices + (((place & ((1 << 60) - 1)) >> 28) * b.slices >> 32)
            ones = [np.ones(len(place))] if b.intercept else []
            x = np.column_stack(ones + [batch.column(k).to_numpy() for k in range(1, width + 2)])
            edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if own is None or cells[lo] != own.cell:
                    if own is not None:
                        yield own.found()
                    own = _Cell(int(cells[lo]), b)
                own.add(x[lo:hi])
        if own is not None:
            yield own.found()

    return run
