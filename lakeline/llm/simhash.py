"""SimHash near-duplicate groups by the general pigeonhole principle.

Fingerprint: bit b is 1 if it is set in over half of the XXH64 values (seed
42) of a text's shingles.  Two fingerprints link at ``MAX_BITS`` or fewer
differing bits; groups are the connected components of these links.

Search, over distinct fingerprints (copies meet in an aggregate first, so a
group of copies is one row):

1. Bits are put into eight blocks of eight, correlated bits together (from the
   co-occurrence counts of all distinct fingerprints), and the blocks into m
   parts.  General pigeonhole: if thresholds t_i sum to MAX_BITS - m + 1, any
   linked pair is within t_i bits in some part i.
2. Exact histograms of the blocks give, by convolution, the estimated number
   of candidate pairs of each part at each threshold.  A dynamic program
   chooses the thresholds (-1: the part is not probed) and m of least cost.
3. Each fingerprint is put under one key for each masked variant of each
   probed part; fingerprints under one key are compared exactly.
4. A key with more than ``BUCKET`` fingerprints is divided: the bits its key
   doesn't fix are cut into MAX_BITS + 1 groups, one of which any linked pair
   shares in full.  Fingerprints are distinct, so this ends when
   2**(free bits) <= BUCKET at the latest; no pair is lost and no group is
   compared whole.
5. Inside a key, a spanning forest of the links is emitted, not all pairs.

Defined results: a null or empty text has fingerprint zero and links like any
other.  Rows that repeat an id give one fingerprint row each; the id takes the
smallest group of its rows.  A null id is kept and is never a group's name
unless the whole group has none.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import growing, out_batches, popcount, text_bytes, unsigned_hex, unused, written
from lakeline.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BUCKET = 1024          # fingerprints compared together in one step
PART_COUNTS = (2, 3, 4)  # numbers of parts that the planner weighs
ROW_COST = 1.0         # of one key row, against
PAIR_COST = 0.02       # one compared pair
_BLOCKS, _BITS = 8, 64
_PIECE = 1 << 15       # shingles whose bits are counted in one step


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text's UTF-8 bytes."""
    words = text.lower().split()  # ASCII letters, and white space \x20 \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = xxhash.xxh64_digest(line, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(starts[: 1 - shingle].tolist(), (ends[shingle - 1:] - 1).tolist(), strict=True)])
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(_BITS, np.int64)
    for k in range(0, len(raw), _PIECE):
        ones += np.unpackbits(raw[k: k + _PIECE], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, marked: bool = False) -> DataFrame:
    """(id, fp long) of every row; ``marked``: with mark, a hash of the text."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *[F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark")] * marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            o = off.tolist()
            fp = np.array([fingerprint(data[s:e].tobytes(), shingle) for s, e in zip(o, o[1:], strict=False)], np.uint64)
            yield from out_batches({"id": b.column(0), "fp": pa.array(fp.view(np.int64))} | ({"mark": b.column(2)} if marked else {}))

    return source.mapInArrow(run, "id long, fp long" + ", mark long" * marked)


# --- statistics of all distinct fingerprints --------------------------------

def _bit_matrix(fp: np.ndarray) -> np.ndarray:
    """(n, 64) of 0 and 1; column b is bit b (lowest first)."""
    return np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(fps: DataFrame, name: str, cells: int, add) -> np.ndarray:
    """Sum over all fingerprints of a fixed number of counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k in range(0, len(fp), 1 << 14):
                total += add(fp[k: k + (1 << 14)])
        some = np.flatnonzero(total)
        yield from out_batches({"cell": pa.array(some.astype(np.int32)), "n": pa.array(total[some])})

    out = np.zeros(cells, np.int64)
    for cell, n in fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias(name)).collect():
        out[cell] = n
    return out


def correlated_blocks(together: np.ndarray, n: int) -> list[list[int]]:
    """Eight blocks of eight bits, each grown by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    free, blocks = list(range(_BITS)), []
    while free:
        inner = corr[np.ix_(free, free)] - 2 * np.eye(len(free))
        block = [free.pop(int(np.unravel_index(np.argmax(inner), inner.shape)[0]))]
        while len(block) < _BITS // _BLOCKS:
            block.append(free.pop(int(np.argmax(corr[np.ix_(free, block)].sum(axis=1)))))
        blocks.append(sorted(block))
    return blocks


def _block_value(fp: np.ndarray, block: list[int]) -> np.ndarray:
    return reduce(np.bitwise_or, (((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k for k, b in enumerate(block)))


def block_distances(histogram: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints drawn at random differ in 0..8 bits of a block."""
    share = histogram / max(histogram.sum(), 1)
    apart = popcount(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
    return np.bincount(apart.ravel(), weights=np.outer(share, share).ravel(), minlength=9)


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost that sum to ``budget``; costs[i][t + 1]
    is part i's cost at threshold t, from -1 (not probed)."""
    best = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, len(part) - 1):
                now = (cost + part[t + 1], [*chosen, t])
                if spent + t not in step or now < step[spent + t]:
                    step[spent + t] = now
        best = step
    return best[budget]


def plan_parts(blocks: list[list[int]], near: list[np.ndarray], n: int, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed part."""
    plans = []
    for m in PART_COUNTS:
        cut = [round(i * _BLOCKS / m) for i in range(m + 1)]
        parts, costs = [], []
        for lo, hi in zip(cut, cut[1:], strict=False):
            bits = [b for block in blocks[lo:hi] for b in block]
            chance = reduce(np.convolve, near[lo:hi])
            cost = [0.0]
            for t in range(max_bits + 1):
                keys = len(list(combinations(range(len(bits)), t)))
                cost.append(ROW_COST * keys * n + PAIR_COST * n * n / 2 * float(chance[: t + 1].sum()) * max(1, keys / 4))
            parts.append(bits)
            costs.append(cost)
        cost, chosen = allocate(costs, max_bits - m + 1)
        plans.append((cost, m, [(b, t) for b, t in zip(parts, chosen, strict=True) if t >= 0]))
    return min(plans)[2]


# --- candidates and links ----------------------------------------------------

def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def first_keys(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(key, fp, fixed): a row for each masked variant of each probed part.
    ``fixed``: the bits that all fingerprints under the key share."""
    masks = [_mask(bits) ^ _mask(out) for bits, t in parts for out in combinations(bits, t)]
    variants = F.array(*[F.lit(_signed(x)) for x in masks])
    return fps.select("fp", F.explode(variants).alias("fixed")) \
        .select(F.xxhash64("fixed", F.col("fp").bitwiseAND(F.col("fixed"))).alias("key"), "fp", "fixed")


def next_keys(rows: DataFrame, groups: int) -> DataFrame:
    """The same rows under finer keys: the free bits cut into ``groups``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, fixed = (b.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            for one in np.unique(fixed):
                mine = fp[fixed == one]
                free = [k for k in range(_BITS) if not int(one) >> k & 1]
                for g in range(groups):
                    more = np.uint64(int(one) | _mask(free[g::groups]))
                    yield from out_batches({"fp": pa.array(mine.view(np.int64)), "fixed": pa.array(np.full(len(mine), more).view(np.int64))})

    return rows.select("fp", "fixed").mapInArrow(run, "fp long, fixed long") \
        .select(F.xxhash64("fixed", F.col("fp").bitwiseAND(F.col("fixed"))).alias("key"), "fp", "fixed")


def _forest(fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest among the fingerprints of one key."""
    left, u, v = np.arange(len(fp)), [], []
    while len(left) > 1:
        edge, left = left[:1], left[1:]
        while len(edge) and len(left):
            near = popcount(fp[left][:, None] ^ fp[edge][None, :]) <= most
            hit = near.any(axis=1)
            u.append(left[hit])
            v.append(edge[near[hit].argmax(axis=1)])
            edge, left = left[hit], left[~hit]
    return (fp[np.concatenate(u)], fp[np.concatenate(v)]) if u else (fp[:0], fp[:0])


def key_links(cold: DataFrame, most: int) -> DataFrame:
    """(u, v): verified links among the fingerprints that share a key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            fp = lists.flatten().to_numpy().view(np.uint64)
            size = lists.value_lengths().to_numpy()
            at = np.cumsum(size) - size
            found = []
            for n in np.unique(size):
                rows = fp[at[size == n][:, None] + np.arange(n)]
                if n <= 6:  # all keys of so many at once
                    for i, j in combinations(range(int(n)), 2):
                        near = popcount(rows[:, i] ^ rows[:, j]) <= most
                        found.append((rows[near, i], rows[near, j]))
                else:
                    found += [_forest(r, most) for r in rows]
            if found:
                u, v = (np.concatenate([f[k] for f in found]).view(np.int64) for k in (0, 1))
                yield from out_batches({"u": pa.array(u), "v": pa.array(v)})

    lists = cold.groupBy("key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return lists.select("fps").mapInArrow(run, "u long, v long").distinct()


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v) over distinct fingerprints ``fps`` (a written table): links whose
    components are those of all pairs within ``max_bits``."""
    n = fps.count()
    together = _summed(fps, "together", _BITS * _BITS, lambda fp: (m := _bit_matrix(fp).astype(np.float64)).T.dot(m).astype(np.int64).ravel()).reshape(_BITS, _BITS)
    blocks = correlated_blocks(together, n)
    counts = _summed(fps, "counts", _BLOCKS * 256, lambda fp: np.concatenate([np.bincount(_block_value(fp, b), minlength=256) for b in blocks]))
    near = [block_distances(h) for h in counts.reshape(_BLOCKS, 256)]
    rows, found = first_keys(fps, plan_parts(blocks, near, n, max_bits)), []
    while True:
        rows = written(rows.distinct() if found else rows, "keys")
        sizes = written(rows.groupBy("key").count().where("count > 1"), "sizes")
        shared = rows.join(sizes, "key")
        found.append(written(key_links(shared.where(F.col("count") <= BUCKET), max_bits), "found"))
        hot = shared.where(F.col("count") > BUCKET)
        if sizes.where(F.col("count") > BUCKET).isEmpty():
            break
        rows = next_keys(hot, max_bits + 1)
    return reduce(DataFrame.unionByName, found)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id, component_size) of every row of ``docs``."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "distinct")
    # Ids with several fingerprints tie them together.
    many = written(rows.groupBy("id").agg(F.min("fp").alias("u"), F.max("fp").alias("v")).where("u <> v and id is not null"), "many")
    own = rows.join(many.select("id", "u"), "id").select("u", F.col("fp").alias("v"))
    named = _rooted(fps, links(fps, max_bits).unionByName(own))
    roots = written(named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("component_size")), "roots")
    known = written(named.join(roots, "root").select("fp", "component_id", "component_size"), "known")
    return rows.join(known, "fp").select(F.col("id").alias(id_col), unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id", "component_size")


def _rooted(fps: DataFrame, pairs: DataFrame) -> DataFrame:
    """``fps`` with the root of each one's component."""
    groups = components(pairs)
    return written(fps.join(groups, fps.fp == groups.node, "left").select(*fps.columns, F.coalesce("root", "fp").alias("root")), "rooted")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of linked texts, with all its columns.

    Rows are told apart by (id, hash of the text), and groups come from the
    texts alone: a repeated id ties nothing.  Of a group stays the row of least
    id, then least text hash; one without an id only if the group has no other.
    Of rows equal in id and text, the one whose other columns hash least."""
    key = [F.coalesce(F.col("id"), F.lit(0)).alias("tie"), F.col("id").isNull().alias("none")]
    rows = written(fingerprints(docs, id_col, text_col, shingle, marked=True), "fingerprints")
    places = written(rows.groupBy("fp", "id", "mark").agg(F.count("*").alias("n")), "places")
    fps = written(places.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "n")).alias("least")), "distinct")
    best = _rooted(fps, links(fps, max_bits)).groupBy("root").agg(F.min("least").alias("r")).select("r.*")
    kept = written(best.select(*key, "mark", "n"), "kept")
    tie, none, mark, n, rest = unused(docs.columns, "tie", "none", "mark", "n", "rest")
    names = dict(zip(("tie", "none", "mark", "n"), (tie, none, mark, n), strict=True))
    id_ = F.col(id_col).cast("long")
    own = docs.withColumns({tie: F.coalesce(id_, F.lit(0)), none: id_.isNull(), mark: F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))})
    kept = kept.withColumnsRenamed(names)
    once = own.join(growing(kept.where(F.col(n) == 1)), [tie, none, mark]).select(*docs.columns)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    copies = own.join(kept.where(F.col(n) > 1), [tie, none, mark]).withColumn(rest, F.xxhash64(F.to_json(F.struct(*others))))
    one = copies.groupBy(tie, none, mark).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), rest).alias(rest)).select(f"{rest}.*")
    return once.unionByName(one)
