"""Hard-negative mining by a secondary sort.

Anchors are a stated query set, scored against all rows in blocks: a block of
``ANCHORS`` anchors goes to every task, which multiplies it with its rows.
Pairs that can matter travel under the packed key (anchor, descending score,
id).  They are repartitioned by anchor and sorted within partitions by the
whole key (the DataFrame form of repartitionAndSortWithinPartitions), so that
one streaming pass meets an anchor's rows best first: a row of the same label
opens a window of negative scores below its own, and each row of another label
is emitted into the open windows that its score fits.  Nothing of an anchor is
held but its open windows.

Before that shuffle, each task leaves out what cannot be returned.  A first
round of the same shuffle finds each anchor's positives (a task sends its own
first ones only); their scores fix the windows, so in the second round a task
sends, of the rows in a window, its own first ``negatives`` ones.  Both cuts
are exact: what is left out has as many better rows in its own task.

Scores are inner products of whole numbers, floor(scale * c).  Higher scores
come first, ties by smaller id.

Defined results: rows with a null id or label, a null or empty vector, a null
or non-finite entry, or a vector whose length isn't the most common one take
no part.  An anchor's own id is never its positive or negative, repeated or
not; other repeated rows are rows of their own, and so are repeated anchors.
Positives with a score below zero have no window.  Whole entries stop at
+-2**31 / sqrt(d), so that scores fit 64 bits.  An empty table gives an empty
result.

Scale: rows times anchors multiplications, as the task asks; a pass over the
rows for each block.  The driver holds one block at a time: its vectors, and
the positives' scores.  A shuffle carries at most
(1 + negatives) * positives pairs for each anchor and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import out_batches, tasks, written
from lakeline.llm.whitening import matrix, one_length, usable

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90     # per cent of the positive's score
SCALE = 256
ANCHORS = 1024         # anchors of a block
_TOGETHER = 256        # anchors scored in one step
_PAIR = "anchor int, down long, id long, same boolean"
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def rows_of(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, x) of the rows that take part, as a written table."""
    rows = usable(df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
                  .where("id is not null and label is not null"), "v")
    rows, d = one_length(rows, "v")
    most = float(int(2 ** 31 / max(1, d) ** 0.5))
    x = F.transform("v", lambda c: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(c * scale).cast("double"))).cast("long"))
    return written(rows.select("id", "label", x.alias("x")), "vectors")


def _scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: by doubles where these hold them, else by 64-bit numbers."""
    if int(np.abs(a).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a @ x.T


class _First:
    """The first ``k`` rows seen, as (score, id, place in the task), and the
    score that a row needs to be one of them."""

    __slots__ = ("rows", "k", "least")

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.rows = np.zeros((0, 3), np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray, place: np.ndarray) -> None:
        if len(score):
            rows = np.concatenate([self.rows, np.stack([score, ids, place], 1)])
            self.rows = rows[np.lexsort((rows[:, 1], -rows[:, 0]))[:self.k]]
            if len(self.rows) == self.k:
                self.least = max(self.least, int(self.rows[-1, 0]))


def _pairs(found: list[list[_First]], same: bool) -> Iterator[pa.RecordBatch]:
    """Records under their packed keys; a row that is in several of an anchor's
    lists is one record."""
    parts = [(i, np.unique(np.concatenate([f.rows for f in fs]), axis=0)) for i, fs in enumerate(found) if fs]
    if any(len(r) for _, r in parts):
        rows = np.concatenate([r for _, r in parts])
        anchor = np.repeat(np.array([i for i, _ in parts], np.int32), [len(r) for _, r in parts])
        yield from out_batches({"anchor": pa.array(anchor), "down": pa.array(-rows[:, 0]), "id": pa.array(rows[:, 1].copy()), "same": pa.array(np.full(len(rows), same))})


class Block:
    """Some anchors: ids, labels and vectors."""

    def __init__(self, rows: list):
        self.ids, self.labels = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
        self.x = np.array([r[2] for r in rows], np.int64)

    def positives(self, batches: Iterator[pa.RecordBatch], k: int) -> list[list[_First]]:
        """This task's first rows of each anchor's label."""
        first = [_First(k, -(1 << 63)) for _ in self.ids]
        for ids, label, x, place in _numbered(batches):
            for value in np.intersect1d(label, self.labels):
                rows, mine = np.flatnonzero(label == value), np.flatnonzero(self.labels == value)
                for lo in range(0, len(mine), _TOGETHER):
                    some = mine[lo: lo + _TOGETHER]
                    for i, s in zip(some, _scores(self.x[some], x[rows]), strict=True):
                        ok = np.flatnonzero((s >= first[i].least) & (ids[rows] != self.ids[i]))
                        first[i].add(s[ok], ids[rows[ok]], place[rows[ok]])
        return [[f] for f in first]

    def negatives(self, batches: Iterator[pa.RecordBatch], windows: list[list[tuple[int, int]]], k: int) -> list[list[_First]]:
        """This task's first rows of other labels in each window."""
        first = [[_First(k, lo) for lo, _ in w] for w in windows]
        for ids, label, x, place in _numbered(batches):
            for lo in range(0, len(self.ids), _TOGETHER):
                for i, s in enumerate(_scores(self.x[lo: lo + _TOGETHER], x), lo):
                    other = (label != self.labels[i]) & (ids != self.ids[i])
                    for f, (_, high) in zip(first[i], windows[i], strict=True):
                        ok = np.flatnonzero(other & (s <= high) & (s >= f.least))
                        f.add(s[ok], ids[ok], place[ok])
        return first


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors, places in the task) of each batch."""
    seen = 0
    for b in batches:
        if b.num_rows:
            yield b.column(0).to_numpy(), b.column(1).to_numpy(), matrix(b.column(2)), np.arange(seen, seen + b.num_rows)
            seen += b.num_rows


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Whole negative scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def sorted_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs under (anchor, descending score, id): one anchor's in one
    partition, in the order of the key."""
    keyed = pairs.select(F.struct("anchor", "down", "id").alias("key"), "same")
    return keyed.repartition(tasks(pairs.sparkSession), F.col("key.anchor")).sortWithinPartitions("key")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bool]]:
    """(anchor, score, id, same) of sorted pairs, one batch at a time."""
    for b in batches:
        key = b.column(0)
        yield from zip(key.field("anchor").to_pylist(), (-key.field("down").to_numpy()).tolist(), key.field("id").to_pylist(), b.column(1).to_pylist(), strict=True)


def first_positives(pairs: DataFrame, k: int) -> DataFrame:
    """(anchor, score, id) of each anchor's first ``k`` pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def first() -> Iterator[tuple[int, int, int]]:
            anchor, n = None, 0
            for a, score, i, _ in _stream(batches):
                anchor, n = a, n + 1 if a == anchor else 1
                if n <= k:
                    yield a, score, i
        yield from _records(first(), ("anchor", pa.int32()), ("score", pa.int64()), ("id", pa.int64()))

    return sorted_pairs(pairs).mapInArrow(run, "anchor int, score long, id long")


def _records(rows: Iterator[tuple], *fields: tuple[str, pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held, strict=True), fields, strict=True)], names=[n for n, _ in fields])

    for r in rows:
        held.append(r)
        if len(held) == size:
            yield batch()
            held.clear()
    if held:
        yield batch()


def emitted(stream: Iterator[tuple[int, int, int, bool]], ids: list[int], positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
            high: int = HIGH) -> Iterator[tuple]:
    """Result rows from pairs in the order of their keys."""
    anchor, opened, windows, zeros = None, 0, [], []
    for a, score, i, same in stream:
        if a != anchor:
            anchor, opened, windows, zeros = a, 0, [], []
        if same:
            if opened < positives:
                opened += 1
                windows.append([i, score, *window(score, low, high), 0])
                if score == 0:  # its negatives tie with it: those of smaller id came before
                    for rank, z in enumerate(zeros, 1):
                        yield ids[a], i, rank, z, 0, 0
                    windows[-1][4] = len(zeros)
            continue
        if score == 0 and len(zeros) < negatives:
            zeros.append(i)
        windows = [w for w in windows if score >= w[2] and w[4] < negatives]
        for w in windows:
            if score <= w[3]:
                w[4] += 1
                yield ids[a], w[0], w[4], i, w[1], score


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).  ``anchors``: a condition on the column ``id``."""
    if not 0 <= low <= high < 100:
        raise ValueError("a streaming pass needs windows below the positive's score: 0 <= low <= high < 100")
    spark = df.sparkSession
    rows = rows_of(df, id_col, label_col, vector_col, scale)
    parts, some = [], []

    def take() -> None:
        parts.append(written(_mined(rows, Block(some), positives, negatives, low, high), "mined"))
        some.clear()

    for r in written(rows.where(anchors), "anchors").toLocalIterator():
        some.append(r)
        if len(some) == block:
            take()
    if some or not parts:
        take()
    return spark.read.schema(SCHEMA).parquet(*[f for p in parts for f in p.inputFiles()]) if len(parts) > 1 else parts[0]


def _mined(rows: DataFrame, one: Block, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pairs(one.positives(batches, positives), True)

    found: list[list] = [[] for _ in one.ids]
    for a, score, i in first_positives(rows.mapInArrow(same, _PAIR), positives).collect():  # anchors of the block * positives
        found[a].append((-score, i))
    windows = [sorted({window(-s, low, high) for s, _ in f if s <= 0}) for f in found]
    mine_ = rows.sparkSession.createDataFrame([(a, s, i, True) for a, f in enumerate(found) for s, i in f], _PAIR)

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pairs(one.negatives(batches, windows, negatives), False)

    ids = one.ids.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        yield from _records(emitted(_stream(batches), ids, positives, negatives, low, high), *zip(names, kinds, strict=True))

    return sorted_pairs(rows.mapInArrow(other, _PAIR).unionByName(mine_)).mapInArrow(run, SCHEMA)
