"""Token-id output in canonical, length-limited Huffman code.

Steps: encode every text with the given tokenizer, append the end id, count
all ids, build code lengths of at most ``MAX_BITS`` bits by package-merge,
and write the ids in ascending document order as independent blocks.

File format (a Parquet table of blocks, so any store that Spark reads will do)

=============  ==============================================================
part, block    place of the block in the stream
start          ids in the part's blocks before it
n_tokens       ids in the block
doc_ids        one for each document in the block
doc_tokens     its number of ids (a document lies in one block)
bits           the code words end to end, highest bit first, 32-bit words
checkpoints    bit offset of every ``STRIDE``-th id, so decoding can begin there
=============  ==============================================================

``codebook``: (id, bits); canonical code words follow from the lengths alone.

Decoding takes ``MAX_BITS`` bits, looks up (id, length) in a table of
2**MAX_BITS entries and moves on; all checkpoints of a block are decoded side
by side.

Defined results: a null text has no ids but the end id.  Repeated ids of
documents stay as they are, next to each other, in order of a hash of their
token ids; a null id sorts first.  An
empty table gives no blocks and no rows.

Scale: texts are read once and never shuffled; only ids (two bytes each where
the vocabulary allows) are range-partitioned by document id.  To the driver
come the counts of the vocabulary and one total for each partition.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import tasks, written
from lakeline.llm.wordpieces import encoder

END_ID = 1
MAX_BITS = 16          # longest code word; raised where the vocabulary needs it
BLOCK_TOKENS = 1 << 17  # a block closes at so many ids
STRIDE = 128           # ids between checkpoints
BATCH_BYTES = 4 << 20  # of ids in one outgoing batch


def token_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """(id, n, ids binary): little-endian 32-bit ids of each text, end id included.

    16-bit ids are stored where all ids fit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], encode.dtype).tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = [x + end for x in encode(part.column(1).fill_null("").to_pylist())]
                n = np.array([len(x) for x in ids], np.int64) // encode.dtype.itemsize
                yield pa.RecordBatch.from_pydict({"id": part.column(0), "n": pa.array(n), "ids": pa.array(ids, pa.binary())})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, n long, ids binary")


def width_of(tokenizer_path: str) -> np.dtype:
    return encoder(tokenizer_path).dtype


def id_counts(tokens: DataFrame, dtype: np.dtype) -> dict[int, int]:
    """Global count of each id; a task sends one row for each id it has met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for x in _slices(b.column(0)):
                now = np.bincount(np.frombuffer(x, dtype), minlength=len(total))
                now[: len(total)] += total
                total = now
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some), "n": pa.array(total[some])})

    return dict(tuple(r) for r in tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n")).collect())


def _slices(col: pa.Array, most: int = 1 << 22) -> Iterator[memoryview]:
    """The bytes of a binary column in pieces that end between rows."""
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = memoryview(col.buffers()[2] or b"")
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield data[off[lo]: off[hi]]
        lo = hi


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code length of each id, none over ``max_bits`` (package-merge).
    ``max_bits`` is raised to what the number of ids needs."""
    ids = sorted(counts)
    if len(ids) < 2:
        return dict.fromkeys(ids, 1)
    max_bits = max(max_bits, (len(ids) - 1).bit_length())
    weight = np.array([counts[i] for i in ids], np.float64)
    order = np.argsort(weight, kind="stable")
    leaf = weight[order]
    # Level by level: merge the leaves with the pairs of the level before.
    merged, is_leaf = leaf, [np.ones(len(leaf), bool)]
    for _ in range(max_bits - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        at = np.argsort(both, kind="stable")
        merged = both[at]
        is_leaf.append(at < len(leaf))
    # Take 2n - 2 of the last level; what is no leaf stands for two of the level before.
    bits, take = np.zeros(len(leaf), np.int64), 2 * len(leaf) - 2
    for mark in reversed(is_leaf):
        leaves = int(mark[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.zeros(len(ids), np.int64)
    out[order] = bits
    return dict(zip(ids, out.tolist(), strict=True))


class Code:
    """Canonical code words: by length, then by id."""

    def __init__(self, lengths: dict[int, int]):
        ids, n = np.array(list(lengths), np.int64), np.array(list(lengths.values()), np.int64)
        order = np.lexsort((ids, n))
        ids, n = ids[order], n[order]
        self.bits = max(lengths.values(), default=1)
        size = max(lengths, default=0) + 1
        # Code words follow one another: each takes its share of the look-up table.
        share = 1 << (self.bits - n)
        end = np.cumsum(share)
        self.top, self.length = np.zeros(size, np.uint64), np.zeros(size, np.uint8)  # ``top``: the code word as the highest bits of 64
        self.top[ids], self.length[ids] = (end - share).astype(np.uint64) << np.uint64(64 - self.bits), n
        self.table_id, self.table_length = np.zeros(1 << self.bits, np.uint32), np.zeros(1 << self.bits, np.uint8)
        used = int(share.sum())
        self.table_id[:used], self.table_length[:used] = np.repeat(ids, share), np.repeat(n, share)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bits, bit offset of every STRIDE-th id)"""
        n = self.length[ids]
        end = np.cumsum(n, dtype=np.uint64)
        at = end - n
        out = np.zeros((int(end[-1]) + 31) // 32 + 2, np.uint64)
        # A code word lies in its 32-bit word and perhaps the next one; those
        # that begin in one 32-bit word share no bit, so their sum joins them.
        cell = (at >> np.uint64(5)).astype(np.int64)
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        both = np.add.reduceat(self.top[ids] >> (at & np.uint64(31)), first)
        out[cell[first]] += both >> np.uint64(32)
        out[cell[first] + 1] += both & np.uint64(0xFFFFFFFF)
        return out.astype(">u4").tobytes(), at[::STRIDE].astype(np.int64)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n_tokens: int) -> np.ndarray:
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((STRIDE, len(at)), np.uint32)
        last = n_tokens - (len(at) - 1) * STRIDE  # ids after the last checkpoint
        shift = np.uint64(64 - self.bits)
        for k in range(min(STRIDE, n_tokens)):
            if k == last:
                at = at[:-1]
            look = (pairs[at >> 5] << (at & 31).astype(np.uint64)) >> shift
            out[k, : len(at)] = self.table_id[look]
            at = at + self.table_length[look]
        return out.T.reshape(-1)[:n_tokens]


BLOCK_SCHEMA = "part int, block long, start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, bits binary, checkpoints array<long>"


def _blocks(rows: Iterator[tuple[int | None, bytes]], dtype: np.dtype, code: Code) -> Iterator[dict]:
    ids, held, kept, start, number = [], 0, [], 0, 0

    def close() -> dict:
        flat = np.frombuffer(b"".join(kept), dtype)
        bits, marks = code.encode(flat)
        return {"block": number, "start": start, "n_tokens": len(flat), "doc_ids": ids, "doc_tokens": [len(x) // dtype.itemsize for x in kept], "bits": bits, "checkpoints": marks}

    for doc, raw in rows:
        ids.append(doc)
        kept.append(raw)
        held += len(raw) // dtype.itemsize
        if held >= BLOCK_TOKENS:
            yield close()
            start, number = start + held, number + 1
            ids, held, kept = [], 0, []
    if ids:
        yield close()


def encode_blocks(tokens: DataFrame, dtype: np.dtype, lengths: dict[int, int]) -> DataFrame:
    """Blocks of the ids of ``tokens``, a written table, in ascending order of
    document id, then of a hash of its ids: a total order but for equal rows,
    and one that splits the rows of a hot id (or of none)."""
    shared = tokens.sparkSession.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, code = TaskContext.get().partitionId(), Code(shared.value)
        rows = ((i.as_py(), x.as_py()) for b in batches for i, x in zip(b.column(0), b.column(1), strict=True))
        for x in _blocks(rows, dtype, code):
            yield pa.RecordBatch.from_pylist([x | {"part": part}], _ARROW)

    order = [F.col("id").asc_nulls_first(), F.col("mark")]
    return tokens.select("id", "ids", F.xxhash64("ids").alias("mark")).repartitionByRange(tasks(tokens.sparkSession), *order) \
        .sortWithinPartitions(*order).mapInArrow(run, BLOCK_SCHEMA)


_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_tokens", pa.list_(pa.int64())), ("bits", pa.binary()), ("checkpoints", pa.list_(pa.int64()))])


def write_ids(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
              max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(blocks, codebook) as written and read back."""
    spark = docs.sparkSession
    dtype = width_of(tokenizer_path)
    tokens = written(token_table(docs, tokenizer_path, id_col, text_col, end_id), "ids")
    lengths = code_lengths(id_counts(tokens, dtype), max_bits)
    blocks = written(encode_blocks(tokens, dtype, lengths), "blocks")
    rows = pa.table({"id": pa.array(list(lengths), pa.int64()), "bits": pa.array(list(lengths.values()), pa.int64())})
    return blocks, written(spark.createDataFrame(rows), "codebook")


def read_ids(blocks: DataFrame, codebook: DataFrame, each: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """(id, start long, n_tokens long, value) of each document, decoded from the
    blocks; ``value`` is ``each`` of its 32-bit ids, of the SQL type ``kind``."""
    sc = blocks.sparkSession.sparkContext
    lengths = {r[0]: r[1] for r in codebook.collect()}  # no more than the vocabulary
    totals = {r[0]: r[1] for r in blocks.groupBy("part").agg(F.sum("n_tokens")).collect()}
    before, starts = 0, {}
    for part in sorted(totals):
        starts[part] = before
        before += totals[part]
    shared = sc.broadcast((lengths, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, starts = shared.value
        code = Code(lengths)
        for b in batches:
            for k in range(b.num_rows):
                x = {n: b.column(n)[k] for n in b.schema.names}
                n = x["doc_tokens"].values.to_numpy()
                ids = code.decode(x["bits"].as_py(), x["checkpoints"].values.to_numpy(), x["n_tokens"].as_py())
                end = np.cumsum(n)
                value = [each(ids[e - m: e]) for e, m in zip(end.tolist(), n.tolist(), strict=True)]
                first = starts[x["part"].as_py()] + x["start"].as_py()
                yield pa.RecordBatch.from_arrays([x["doc_ids"].values, pa.array(end - n + first), pa.array(n), pa.array(value)], ["id", "start", "n_tokens", "value"])

    return blocks.select("part", "start", "n_tokens", "doc_ids", "doc_tokens", "bits", "checkpoints").mapInArrow(run, f"id long, start long, n_tokens long, value {kind}")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
