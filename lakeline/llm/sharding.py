"""Sharding by sampled splitters.

Records are ordered by (CRC-32 of the text, id, salt), so equal texts are
neighbours.  Splitters come from a size-weighted sample: a record is drawn
with a chance in proportion to its share of all bytes and of all rows, by
hash.  Quantile boundaries cut the key space into many more ranges than
shards; exact sizes are then measured, and ranges with over ``OVERFULL`` times
their goal of bytes, or the mean of rows, are sampled and cut again, until none is left that can be
cut (a single record can't).  Ranges in key order fill the shards to equal
bytes; a record's slot is the rank in its range plus what the shard holds
before.

The salt is written once with the sizes, so rows equal in text and id are cut
like any others.

Law: ``bytes``.  Sizes of shards differ by about one range (a shard has
``RANGES`` of them at least) or the largest record.

Defined results: a null text has no bytes (CRC 0) and size 8; a null id sorts
first; repeated rows get slots of their own; an empty table gives an empty
result.

Scale: only (id, size, CRC) are shuffled, once for the slots.  A record finds
its range by bisection in an expression over the sorted bounds, no join.  The
driver gets sampled keys and one row for each range: shards * RANGES, or rows /
``RANGE_ROWS`` if more, times ``DRAWN``; it sends the bounds with the plan and
the ranges' shards as the one broadcast.  Every cut leaves a row of an overfull
range in a range of its own at least, so the rounds end; as samples cut in
proportion, two or three do.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.common import literal_table, written

SHARDS = 24
RANGES = 128           # ranges of a shard, at least
RANGE_ROWS = 2_000_000  # rows of a range, about
DRAWN = 8              # sampled records for each range
OVERFULL = 2.0
SEED = 29
_LOW = -(1 << 63)
KEY = ("crc", "tie", "salt")
Bound = tuple[int, int, int]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, crc, tie, salt): tie orders null ids first.  To be written
    before use: the salt is drawn anew by each evaluation."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc")) \
        .withColumn("tie", F.coalesce("id", F.lit(_LOW))).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))


def _range(bounds: list[Bound]) -> Column:
    """Number of the range that a key lies in: bisection over the lower bounds,
    the first of which is below every key."""
    table = F.from_json(F.lit(json.dumps([dict(zip(KEY, b, strict=True)) for b in bounds])), "array<struct<crc: bigint, tie: bigint, salt: bigint>>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    key = F.struct(*KEY)
    # get() past the end is null, which is no step.
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(table, at + s - 1) <= key, at + s).otherwise(at)) - 1


def _assigned(rows: DataFrame, bounds: list[Bound]) -> DataFrame:
    return rows.withColumn("range", _range(bounds))


def quantiles(sample: list[tuple], pieces: int) -> list[Bound]:
    """Keys at which the sample's weight passes 1/pieces, 2/pieces, ..."""
    total, seen, k, out = sum(w for *_, w in sample), 0.0, 1, []
    for *key, w in sorted(sample):
        if seen * pieces >= k * total:
            out.append(tuple(key))
            k = int(seen * pieces / total) + 1
        seen += w
    return sorted(set(out))


def _measured(rows: DataFrame, bounds: list[Bound]) -> dict[int, tuple]:
    """range -> (size, rows, first key, last key)"""
    key = F.struct(*KEY)
    found = _assigned(rows, bounds).groupBy("range").agg(F.sum("size"), F.count("*"), F.min(key), F.max(key)).collect()
    return {r[0]: (r[1], r[2], tuple(r[3]), tuple(r[4])) for r in found}


def split(rows: DataFrame, shards: int) -> tuple[list[Bound], list[tuple[int, int]]]:
    """(lower bounds, (size, rows) of each range) after all cuts."""
    bounds: list[Bound] = [(-1, _LOW, _LOW)]
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return bounds, [(0, 0)]
    pieces = max(shards * RANGES, count // RANGE_ROWS)
    share = F.greatest(F.col("size") / F.lit(float(total)), F.lit(1.0 / count))  # of all bytes, or of all rows

    def drawn(some: DataFrame, turn: int, rate: Column, *more: str) -> list[tuple]:
        """Sampled (..., key, weight); ``rate``: draws for a share of 1."""
        at = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + turn), *KEY), 11) / float(1 << 53)
        return [tuple(r) for r in some.where(at < share * rate).select(*more, *KEY, F.greatest(share, 1 / rate)).collect()]

    sample = drawn(rows, 0, F.lit(float(DRAWN * pieces)))
    bounds += quantiles(sample, max(1, round(pieces * sum(w for *_, w in sample))))
    goal, turn = total / pieces, 0
    while True:
        found, few = _measured(rows, bounds), count / len(bounds)
        full = {k: max(size / goal, n / few) for k, (size, n, first, last) in found.items() if first != last and (size > OVERFULL * goal or n > OVERFULL * few)}
        if not full:
            return bounds, [found[k][:2] if k in found else (0, 0) for k in range(len(bounds))]
        # Sample the overfull ranges alone, by fresh draws, and cut them again.
        turn += 1
        mine = literal_table(rows.sparkSession, [(k, float(DRAWN * pieces * 2 ** turn)) for k in full], "range int, rate double")
        by: dict[int, list] = {}
        for k, *r in drawn(_assigned(rows, bounds).join(F.broadcast(mine), "range"), turn, F.col("rate"), "range"):
            by.setdefault(k, []).append(tuple(r))
        more = {b for k, s in by.items() for b in quantiles(s, max(2, round(2 * full[k])))}
        more |= {found[k][3] for k in full}  # at the least, the last key leaves
        bounds = sorted(more | set(bounds))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    rows = written(keyed(docs, id_col, text_col), "keys")
    bounds, measured = split(rows, shards)
    total, before, held, placed = max(1, sum(s for s, _ in measured)), 0, [0] * shards, []
    for k, (size, n) in enumerate(measured):
        at = min(shards - 1, int(shards * (before + size / 2) // total))
        placed.append((k, at, held[at]))
        held[at] += n
        before += size
    info = F.broadcast(literal_table(docs.sparkSession, placed, "range int, shard int, offset bigint"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*KEY)) - 1
    return _assigned(rows, bounds).withColumn("rank", rank).join(info, "range") \
        .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                (F.col("offset") + F.col("rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
