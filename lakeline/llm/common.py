"""Helpers shared by the operators of this subpackage: reading tables,
cutting lineage with written tables, and Arrow text batches as byte arrays.

Every operator selects only the columns it uses under names of its own, so
extra or clashing columns of its input do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.session import apply_runtime_conf, scratch_path

# Bytes of text that one vectorised step works on; a longer text is one step.
CHUNK_BYTES = 1 << 20
# Rows of one Arrow batch that a Python worker gets.
BATCH_ROWS = 2000
# Rows of one Arrow batch given back to Spark.
OUT_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    apply_runtime_conf(spark)
    # A batch of long texts is held several times over by a Python worker.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder.

    Cuts the lineage: a lost executor costs a re-read, and later plans see a
    plain table with a known size (joins with it can be split or broadcast)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def growing(df: DataFrame) -> DataFrame:
    """Mark a join side that grows with the data: the join is a sort-merge one
    at every size (never a broadcast), and AQE may split its hot keys."""
    return df.hint("merge")


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with underscores before it until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
        taken.add(n.lower())
    return out


def tasks(spark: SparkSession, at_least: int = 1) -> int:
    """Shuffle width of this session."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of driver values, planned as a JVM-side generator."""
    import json

    names = [c.split()[0] for c in schema.split(",")]
    fields = ", ".join(f"{n}: {c.split()[1]}" for n, c in zip(names, schema.split(","), strict=True))
    js = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    one = spark.range(1).select(F.explode(F.from_json(F.lit(js), f"array<struct<{fields}>>")).alias("r"))
    return one.select("r.*")


def unsigned_hex(c: Column) -> Column:
    """16 lowercase hex digits of a 64-bit value."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


# --- Arrow text batches as byte arrays -------------------------------------

_CLASS = np.arange(256, dtype=np.uint8)
_LOWER = _CLASS.copy()
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~_SPACE
# Letters a-z, digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and their offsets (null: empty)."""
    col = col.fill_null("").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def row_ranges(off: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes, at least one row each."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return _LOWER[data]


class Words:
    """Words of a run of texts: byte runs of the class ``is_word``.

    ``start`` / ``end``: byte positions; ``first``: index of each text's first
    word, with one more entry at the end."""

    def __init__(self, data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
        self.data, n = data, len(data)
        inside = is_word[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cut = off[(off > 0) & (off < n)]
        before[cut], after[cut - 1] = False, False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.inside = inside

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, the same in every run and task."""
        n = len(self.data)
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


_BASE = 0x5DEECE66D * 2**20 + 0x9B1  # odd, so it has an inverse modulo 2**64
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA3B195354A39B70D)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept per worker for usual sizes."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        made = []
        for base in (_BASE % 2**64, pow(_BASE, -1, 2**64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            made.append(np.cumprod(out, dtype=np.uint64))
        if n > 8 * CHUNK_BYTES:  # one very long text: don't keep its arrays
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def windows(h: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word index, hash) of every run of ``size`` words in one text."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + h[k: k + n]
    ok = np.flatnonzero(rows[:n] == rows[size - 1:])
    return ok, mix(out[ok])


def out_batches(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_pydict(columns)
    for k in range(0, whole.num_rows, OUT_ROWS):
        yield whole.slice(k, OUT_ROWS)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def power_of_two(n: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, n))))
