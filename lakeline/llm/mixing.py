"""Mixing sources to target weights by fitting word budgets.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and
share ``SHARE`` of all words; a target stops at ``MAX_EPOCHS`` times its
source, the excess going to the others by weight (water filling).

Selection of a source with target T and S words: every document is taken
floor(T / S) times; what is left, R = T mod S, is fitted on the source's
histogram of document lengths:

1. of each length the share R / S of its documents, rounded down;
2. one more of the lengths with the largest remainders, while over
   ``TABLE`` words are left;
3. a bounded-knapsack dynamic program over what is left (a bit set of
   reachable sums, lengths with their remaining counts split in powers of two)
   finds the sum nearest to it.

Step 2 ends with over ``TABLE`` words left only where every length that could
still be taken is longer than what is left; so the program's table is twice
the greater of TABLE and the longest document, and no case is left out.

The chosen count of each (source, length) is filled with the documents of
least seeded hash, so reruns agree and no document goes over 2 times its size.

Defined results: a null or empty text has size 0 and takes 0; the null source
is a source like any other; a source without words has target 0.  Rows that
repeat an id within a source and length are taken or left together.  An empty
table gives an empty result.

Scale: documents travel as (id, source, size).  Histograms are aggregated
map-side; a source's histogram has a row for each length.  The cut inside a
(source, length) group is found on counts of hash slices of about
``SLICE_ROWS`` rows, so a group with a third of all rows is never sorted in
one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.common import NOT_SPACE, Words, growing, out_batches, row_ranges, text_bytes, unused, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
TABLE = 1 << 16      # words that the dynamic program is given at most
SLICE_ROWS = 1000


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, mark) of every row; mark: hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(2))
            size = np.zeros(b.num_rows, np.int64)
            for lo, hi in row_ranges(off):
                size[lo:hi] = Words(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], NOT_SPACE).counts
            yield from out_batches({"id": b.column(0), "source": b.column(1), "size": pa.array(size), "mark": b.column(3)})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("mark")).mapInArrow(run, "id long, source string, size long, mark long")


def targets(histogram: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target).  The windows run over the sources only."""
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")) \
        .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)) \
        .withColumn("full", F.lit(epochs).cast("double") * F.col("source_size")).withColumn("ratio", F.col("full") / F.col("w"))
    filling = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("rank", F.row_number().over(filling)) \
        .withColumn("level", (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
                    / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("rank", "level"))).over(every)
    return s.withColumn("at", first.getField("level")) \
        .select("source", "source_size", F.least("full", F.coalesce(F.col("at") * F.col("w"), F.col("full"))).alias("target"))


def fit(size: np.ndarray, n: np.ndarray, budget: float, table: int = TABLE) -> np.ndarray:
    """How many of the n documents of each size to take, for a sum near ``budget``."""
    total = int((size * n).sum())
    if budget <= 0 or not total:
        return np.zeros(len(n), np.int64)
    if budget >= total:
        return np.where(size > 0, n, 0)
    exact = n * (budget / total)
    taken = np.minimum(np.floor(exact).astype(np.int64), n)
    taken[size <= 0] = 0
    left = budget - float((taken * size).sum())
    for i in np.lexsort((size, -(exact - taken))):
        if left <= table:
            break
        if 0 < size[i] <= left and taken[i] < n[i]:
            taken[i] += 1
            left -= size[i]
    return taken + _knapsack(size, n - taken, round(left))


def _knapsack(size: np.ndarray, free: np.ndarray, goal: int) -> np.ndarray:
    """Counts, within ``free``, whose sum of sizes is nearest to ``goal``."""
    out = np.zeros(len(size), np.int64)
    if goal <= 0:
        return out
    limit = 2 * goal  # a sum beyond is farther away than none
    mask, reach = (1 << (limit + 1)) - 1, 1
    by, steps = np.full(limit + 1, -1, np.int32), []
    for i in np.argsort(-size, kind="stable"):
        most, piece = min(int(free[i]), limit // int(size[i])) if size[i] > 0 else 0, 1
        while most > 0 and not reach >> goal & 1:
            piece = min(piece, most)
            new = (reach << (piece * int(size[i]))) & mask & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(limit // 8 + 1, "little"), np.uint8), bitorder="little")
                by[np.flatnonzero(bits)] = len(steps)
                steps.append((int(i), piece))
                reach |= new
            most, piece = most - piece, piece * 2
    sums = np.flatnonzero(by >= 0)
    at = int(min([0, *sums[np.argsort(np.abs(sums - goal), kind="stable")[:1]].tolist()], key=lambda x: abs(x - goal)))
    while at > 0:
        i, piece = steps[by[at]]
        out[i] += piece
        at -= piece * int(size[i])
    return out


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"]) & (a["size"] == b["size"])


def decisions(rows: DataFrame, seed: int = SEED, **shares) -> DataFrame:
    """(source, size, source_size, target, base, extra, n, cut): each document
    of the group is taken ``base`` times, and once more if its (u, id) is no
    greater than ``cut``.  ``rows``: a written table of (id, source, size)."""
    histogram = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    goal = written(targets(histogram, **shares), "targets")

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        size, n, total, target = group["size"].to_numpy(), group["n"].to_numpy(), int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        base = math.floor(target / total) if total else 0
        return group.assign(base=base, extra=fit(size, n, target - base * total))

    kinds = "source string, size long, n long, source_size long, target double, base long, extra long"
    plan = histogram.join(goal, histogram["source"].eqNullSafe(goal["source"])).select(histogram["source"], "size", "n", "source_size", "target")
    plan = written(plan.groupBy("source").applyInPandas(choose, kinds), "plan")
    partly = plan.where("extra > 0 and extra < n").select("source", "size", "extra", F.ceil(F.col("n") / SLICE_ROWS).alias("slices"))
    inside = hashed(rows, seed).join(partly, _same(rows, partly)).select(rows["source"], rows["size"], "id", "u", "extra",
        F.expr("shiftright(shiftright(u, 32) * slices, 31)").alias("slice"))
    run = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = inside.groupBy("source", "size", "slice").agg(F.count("*").alias("m"), F.first("extra").alias("extra")) \
        .withColumn("before", F.coalesce(F.sum("m").over(run), F.lit(0)))
    at = written(counts.where("before < extra and extra <= before + m").select("source", "size", "slice", "before"), "cuts")
    order = Window.partitionBy("source", "size").orderBy("u", "id")
    cut = inside.join(at, _same(inside, at) & (inside["slice"] == at["slice"])).select(inside["source"], inside["size"], "u", "id", "extra", "before") \
        .withColumn("k", F.row_number().over(order) + F.col("before")).where("k = extra").select("source", "size", F.struct("u", "id").alias("cut"))
    return written(plan.join(cut, _same(plan, cut), "left").select(*[plan[c] for c in plan.columns], "cut"), "decisions")


def hashed(rows: DataFrame, seed: int) -> DataFrame:
    return rows.withColumn("u", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 1))


def _times() -> Column:
    """How often a document is taken."""
    more = F.when(F.col("size") <= 0, F.lit(False)).when(F.col("extra") >= F.col("n"), F.lit(True)).when(F.col("extra") <= 0, F.lit(False)) \
        .otherwise(F.struct("u", "id") <= F.col("cut"))
    return F.when(F.col("size") > 0, F.col("base")).otherwise(0) + F.coalesce(more, F.lit(False)).cast("long")


def _taken(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, **shares) -> DataFrame:
    rows = written(word_counts(docs, id_col, text_col, source_col), "sizes")
    plan = decisions(rows, seed, **shares)
    return hashed(rows, seed).join(plan, _same(rows, plan)) \
        .select("id", "mark", rows["source"], rows["size"], "source_size", "target", "u", "base", "extra", "n", "cut").withColumn("times", _times())


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **shares) -> DataFrame:
    """(id, size, source_size, target, taken) of every row of ``docs``."""
    return _taken(docs, id_col, text_col, source_col, seed, **shares) \
        .select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **shares) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    What the mix decides depends on (source, size, id), so rows equal in
    source, id and text hash share one decision, and no others do."""
    tie, none, source, nowhere, mark, times = unused(docs.columns, "tie", "none", "source_", "nowhere", "mark", "times")

    def key(i: Column, s: Column, m: Column) -> dict[str, Column]:
        return {tie: F.coalesce(i, F.lit(0)), none: i.isNull(), source: F.coalesce(s, F.lit("")), nowhere: s.isNull(), mark: m}

    taken = _taken(docs, id_col, text_col, source_col, seed, **shares).where("times > 0").select("id", "source", "mark", "times")
    keys = [c.alias(n) for n, c in key(F.col("id"), F.col("source"), F.col("mark")).items()]
    known = written(taken.groupBy(*keys).agg(F.max("times").cast("int").alias(times)), "times")
    text = F.col(text_col).cast("string")
    own = docs.withColumns(key(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.xxhash64(text)))
    out = own.join(growing(known), [tie, none, source, nowhere, mark])
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
