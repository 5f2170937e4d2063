"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target
and the raw corpus.

Two multinomials over hashed byte n-grams are counted: the raw corpus (every
document) and the trusted target (documents labelled good and not toxic).  An
n-gram's ratio is log(p_target / p_raw).  A document is judged by the others:
its own n-grams are taken out of the raw counts, and out of the target if it
is trusted, so what is merely new in it counts neither way, and trusted and
unknown documents are on a par.

The score is length-normalised: the mean ratio of ``PASSAGE`` n-grams in a
row, and of a text that of its worst passage.  (A mean over a whole text
hides a few words that trusted texts never use.)  Every document is compared
with one bar: the ``BAR_QUANTILE`` quantile (an order statistic) of the trusted
documents' own scores, whatever their number, so at least 1 - BAR_QUANTILE of
those past the base rules stay.  Ratios are rounded to fixed point once, and
sums are integers, so no score depends on how rows are dealt out.

Base rules beside the score: at least ``MIN_WORDS`` words, and at most 20 % of
the words inside repeated five-word windows.  Words and windows are compared
by 64-bit hashes.

Defined results: a null text has no words and fails the base rules.  A text
without n-grams scores 0; one with fewer than PASSAGE is one passage.  Without
any trusted document past the base rules the method keeps everything that
passes them.  Repeated rows are judged alike (each by the others, its copies
among them); an empty table gives an empty result.

Scale: three narrow scans; the second, for the bar, takes the trusted documents
alone and gives one number for each.  Each task adds its n-grams into
2**BUCKET_BITS counters and sends only those; the counts are the only broadcast
of ours (2 * 2**BUCKET_BITS numbers).  Every document labelled good is trusted:
their ids are a stored table that is joined with the documents, broadcast up to
``BROADCAST_IDS`` of them (so no text moves) and beyond that as the planner
sees fit, with the same result.  The bar is found by position among the sorted scores, in slices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import NOT_SPACE, Words, mix, out_batches, row_ranges, text_bytes, unused, windows
from lakeline.operators.keys import ordinal
from lakeline.session import stored

GRAM = 4                 # bytes of an n-gram
BUCKET_BITS = 16         # 2**16 hash buckets
BROADCAST_IDS = 2_000_000  # trusted ids that are broadcast, at most; more are joined by a shuffle
SMOOTHING = 0.5          # added to every bucket of either multinomial
PASSAGE = 16             # n-grams of a passage
BAR_QUANTILE = 0.01      # share of the trusted documents that the bar may stop
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
SCALE = 1 << 20          # fixed point of a ratio

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte (the last ones are cut)."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    x = np.zeros(n, np.uint32)
    for k in range(GRAM):
        x = (x << np.uint32(8)) | data[k: k + n]
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _own(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, and the range of n-grams wholly inside each text."""
    lo = off[:-1]
    return gram_buckets(data), lo, np.maximum(off[1:] - GRAM + 1, lo)


def marked(docs: DataFrame, id_col: str, trusted: DataFrame, mark: str) -> DataFrame:
    """``docs`` with the boolean ``mark``: is its id in ``trusted`` (column id,
    each once)?"""
    known = trusted.select(F.col("id").alias("__trusted"))
    return docs.join(known, F.col(id_col).cast("long") == F.col("__trusted"), "left") \
        .withColumn(mark, F.col("__trusted").isNotNull()).drop("__trusted")


def ngram_counts(docs: DataFrame, id_col: str, text_col: str, trusted: DataFrame) -> DataFrame:
    """(bucket, target, raw): n-gram counts over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BUCKET_BITS
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            data, off = text_bytes(b.column(1))
            is_good = b.column(0).to_numpy(False)
            for lo, hi in row_ranges(off):
                part, o = data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
                grams, s, e = _own(part, o)
                edge = np.zeros(len(part) + 1, np.int8)
                np.add.at(edge, s, 1)
                np.add.at(edge, e, -1)
                inside = np.cumsum(edge[: len(grams)]) > 0
                raw += np.bincount(grams[inside], minlength=size)
                for k in np.flatnonzero(is_good[lo:hi]):
                    target += np.bincount(grams[s[k]: e[k]], minlength=size)
        some = np.flatnonzero(raw)
        yield from out_batches({"bucket": pa.array(some.astype(np.int32)), "target": pa.array(target[some]), "raw": pa.array(raw[some])})

    per_task = marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", trusted, "good") \
        .select("good", "text").mapInArrow(count, "bucket int, target long, raw long")
    return per_task.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def trusted_ids(labels: DataFrame, id_col: str, good: Column) -> DataFrame:
    """(id long): every document that ``good`` holds for, once; a stored table,
    marked for broadcast while it is small."""
    ids = labels.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    found = stored(ids.where("id IS NOT NULL").distinct(), "trusted-ids")
    return F.broadcast(found) if found.count() <= BROADCAST_IDS else found


def totals(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(target, raw) counts of each bucket; collects 2**BUCKET_BITS rows at most."""
    target, raw = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for bucket, t, r in counts.collect():
        target[bucket], raw[bucket] = t, r
    return target, raw


class Model:
    """Counts of both multinomials."""

    def __init__(self, target: np.ndarray, raw: np.ndarray):
        self.target, self.raw = target, raw
        self.n_target, self.n_raw = float(target.sum()), float(raw.sum())

    def score(self, grams: np.ndarray, trusted: bool) -> int:
        """Fixed-point mean ratio of the worst passage of a text with these n-grams."""
        n, size = len(grams), 1 << BUCKET_BITS
        if not n or self.n_target <= 0:
            return 0
        own = np.bincount(grams, minlength=size)[grams]
        gone = own if trusted else 0
        offset = math.log((self.n_raw - n + SMOOTHING * size) / (self.n_target - n * trusted + SMOOTHING * size))
        ratio = np.rint((np.log((self.target[grams] - gone + SMOOTHING) / (self.raw[grams] - own + SMOOTHING)) + offset) * SCALE).astype(np.int64)
        wide = min(PASSAGE, n)
        total = np.concatenate([[0], np.cumsum(ratio)])
        return int((total[wide:] - total[:-wide]).min()) // wide


def trusted_bar(docs: DataFrame, id_col: str, text_col: str, shared, trusted: DataFrame) -> int | None:
    """The bar, in fixed point; None without a trusted document past the base
    rules.  One score (the least) comes for each trusted id."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = measure(b.column(1), shared.value, np.ones(b.num_rows, bool))
            ok = ~base_failed(m)
            yield from out_batches({"id": b.column(0).filter(pa.array(ok)), "score": pa.array(m["score"][ok])})

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(trusted, "id", "left_semi")
    scores = stored(own.mapInArrow(score, "id long, score long").groupBy("id").agg(F.min("score").alias("score")), "trusted-scores")
    at = int(scores.count() * BAR_QUANTILE) + 1
    found = ordinal(scores, [F.col("score"), F.col("id")], None, "position").where(F.col("position") == at).first()
    return found["score"] if found else None


def _sums(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[hi] - total[lo]


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(words: Words, size: int) -> np.ndarray:
    """Words of each text in ``size``-word windows found twice or more in it."""
    rows = words.rows()
    at, h = windows(words.hashes(), rows, size)
    h = mix(h ^ (rows[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(rows) + 1, np.int64)
    edge[at[twice]] += 1
    edge[at[twice] + size] -= 1
    covered = (np.cumsum(edge)[:-1] > 0).astype(np.int64)
    return _sums(covered, words.first[:-1], words.first[1:])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")


def measure(texts: pa.Array, model: Model | None = None, trusted: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The base measures of each text, and with a model its fixed-point score."""
    data, off = text_bytes(texts)
    out = {k: np.zeros(len(off) - 1, np.int64) for k in MEASURES}
    for lo, hi in row_ranges(off):
        part, o = data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        w = Words(part, o, NOT_SPACE)
        out["n_words"][lo:hi] = w.counts
        out["word_chars"][lo:hi] = _sums(w.inside & ((part & 0xC0) != 0x80), o[:-1], o[1:])
        out["n_symbols"][lo:hi] = _sums(_SYMBOL[part], o[:-1], o[1:])
        out["n_repeat_words"][lo:hi] = repeated_words(w, REPEAT_WINDOW)
        if model is not None:
            grams, s, e = _own(part, o)
            out["score"][lo:hi] = [model.score(grams[x:y], bool(k)) for x, y, k in zip(s.tolist(), e.tolist(), trusted[lo:hi], strict=True)]
    out["n_dup_lines"][:] = [duplicate_lines(t) if t else 0 for t in texts.to_pylist()]
    return out


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def judge(m: dict[str, np.ndarray], bar: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)"""
    failed = base_failed(m)
    return failed, ~failed & (bar is None or m["score"] >= bar)


def _fitted(docs: DataFrame, id_col: str, text_col: str, trusted: DataFrame):
    """(broadcast model, bar)"""
    shared = docs.sparkSession.sparkContext.broadcast(Model(*totals(ngram_counts(docs, id_col, text_col, trusted))))
    return shared, trusted_bar(docs, id_col, text_col, shared, trusted)


def _good() -> Column:
    return (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
            good: Column | None = None) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    llr double, base_failed, kept) of every document; llr: of the worst passage."""
    trusted = trusted_ids(labels, label_id, _good() if good is None else good)
    shared, bar = _fitted(docs, id_col, text_col, trusted)
    source = marked(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", trusted, "good")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = measure(b.column(1), shared.value, b.column(2).to_numpy(False))
            failed, kept = judge(m, bar)
            cols = {"id": b.column(0)} | {k: pa.array(m[k]) for k in MEASURES[:-1]}
            yield from out_batches(cols | {"llr": pa.array(m["score"] / SCALE), "base_failed": pa.array(failed), "kept": pa.array(kept)})

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(score, f"id {kind}, " + ", ".join(f"{k} long" for k in MEASURES[:-1]) + ", llr double, base_failed boolean, kept boolean") \
        .withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    trusted = trusted_ids(labels, id_col, _good())
    shared, bar = _fitted(docs, id_col, text_col, trusted)
    at, number = docs.columns.index(text_col), len(docs.columns)
    (extra,) = unused(docs.columns, "good")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = judge(measure(b.column(at), shared.value, b.column(number).to_numpy(False)), bar)[1]
            yield b.select(list(range(number))).filter(pa.array(kept))

    return marked(docs, id_col, trusted, extra).mapInArrow(keep, docs.schema)
