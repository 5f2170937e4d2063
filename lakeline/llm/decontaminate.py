"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items are put into one automaton (states: classes of
substrings).  Documents stream through it word by word; the state's depth is
the longest item passage that ends at the word.  A passage of ``WINDOW`` words
(or a whole shorter item) inside a document is a hit; ``remove_passages`` cuts
hit words out of the text, and drops a document whose hit share is over
``max_coverage``.

Words: runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z.

Scale: the test items are the only shared data: they are taken in blocks of at
most ``BLOCK_WORDS`` words, each block one broadcast automaton and one pass
over the documents, so memory is bounded for a benchmark of any size.  With one
block documents are not shuffled; with more, each pass writes the hits it
finds, by text hash, and documents meet the merged hits of all blocks once.
Cuts are decided on these; cut texts alone are read again by all blocks, as
many rounds as the most nested document needs.  Before the automaton runs, a vectorised filter keeps
the runs of words whose neighbouring pairs all occur in an item: a longer
passage cannot be anywhere else.  Word lookups use 64-bit hashes; every hit is
then compared byte by byte.

Defined results: a null text has no words and no hits; an item without words
matches nothing; a null item id is reported as an empty string.  Repeated rows
are judged alike.  Without items nothing is hit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import ALNUM, Words, growing, lower, out_batches, row_ranges, text_bytes, unused, written
from lakeline.session import scratch_path

WINDOW = 10
BLOCK_WORDS = 100_000
MAX_COVERAGE = 0.5   # documents with a larger hit share are dropped
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Automaton:
    """Suffix automaton of several word sequences, with the items whose windows
    end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        vocabulary = sorted({w for _, words in items for w in words})
        self.words = vocabulary
        number = {w: k for k, w in enumerate(vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.depth = [-1], [0]
        sequences = [(name, [number[w] for w in words]) for name, words in items if words]
        for _, seq in sequences:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        # Items by the state of each of their windows.
        self.found: dict[int, set[str]] = {}
        self.sizes: dict[int, int] = {}
        for name, seq in sequences:
            size = min(window, len(seq))
            state = depth = 0
            for w in seq:
                state, depth = self.step(state, depth, w)
                if depth >= size:
                    at = self._at_depth(state, size)
                    self.found.setdefault(at, set()).add(name)
                    self.sizes[at] = size
        self.least = min([min(window, len(s)) for _, s in sequences], default=0)
        # The nearest state on the suffix path, itself included, that has items.
        self.near = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.depth.__getitem__):
            self.near[state] = state if state in self.found else (self.near[self.link[state]] if self.link[state] >= 0 else -1)
        pairs = {a * len(vocabulary) + b for _, s in sequences for a, b in zip(s, s[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.hashes, self.by_hash = self._word_hashes()

    def _word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        off = np.concatenate([[0], np.cumsum([len(w) for w in self.words])]).astype(np.int64)
        h = Words(np.frombuffer(b"".join(self.words), np.uint8), off, ALNUM).hashes() if self.words else np.zeros(0, np.uint64)
        order = np.argsort(h)
        return h[order], order

    def _new(self, depth: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.depth.append(depth)
        return len(self.next) - 1

    def _extend(self, last: int, w: int) -> int:
        """Add word ``w`` after state ``last``; gives the state of the whole."""
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.depth[q] == self.depth[last] + 1 else self._clone(last, w, q)
        new, p = self._new(self.depth[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.depth[q] == self.depth[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._new(self.depth[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def step(self, state: int, depth: int, w: int) -> tuple[int, int]:
        """State and matching length after one more word."""
        while state and w not in self.next[state]:
            state = self.link[state]
            depth = self.depth[state]
        if w in self.next[state]:
            return self.next[state][w], depth + 1
        return 0, 0

    def _at_depth(self, state: int, size: int) -> int:
        """The suffix state that holds the last ``size`` words."""
        while self.depth[self.link[state]] >= size:
            state = self.link[state]
        return state

    def hits(self, tokens: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(end, size, items) of every window occurrence that ends in the run."""
        state = depth = 0
        for i, w in enumerate(tokens):
            state, depth = self.step(state, depth, w)
            if depth < self.least:
                continue
            at = self.near[state]
            while at >= 0:
                if self.sizes[at] <= depth:
                    yield i + 1, self.sizes[at], self.found[at]
                at = self.near[self.link[at]]

    def longest(self, tokens: list[int]) -> int:
        state = depth = most = 0
        for w in tokens:
            state, depth = self.step(state, depth, w)
            most = max(most, depth)
        return most


def _runs(a: Automaton, tokens: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """Runs of words in which an item's window may lie."""
    n = len(tokens)
    if not n or not a.least:
        return []
    known = tokens >= 0
    joined = np.zeros(n + 1, bool)  # joined[i]: words i - 1 and i may be in one passage
    if n > 1 and len(a.pairs):
        pair = tokens[:-1] * len(a.words) + tokens[1:]
        at = np.minimum(np.searchsorted(a.pairs, pair), len(a.pairs) - 1)
        joined[1:n] = (a.pairs[at] == pair) & known[:-1] & known[1:] & (rows[:-1] == rows[1:])
    start = np.flatnonzero(known & ~joined[:-1])
    end = np.flatnonzero(known & ~joined[1:]) + 1
    long = end - start >= a.least
    return list(zip(start[long].tolist(), end[long].tolist(), strict=True))


def scan(a: Automaton, data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray, list[set[str]], np.ndarray]:
    """(words, hit mark of each word, items of each text, longest match of each
    text among the runs that can hold a hit)."""
    words = Words(lower(data), off, ALNUM)
    rows, h = words.rows(), words.hashes()
    tokens = np.full(len(h), -1, np.int64)
    if len(a.hashes):
        at = np.minimum(np.searchsorted(a.hashes, h), len(a.hashes) - 1)
        tokens = np.where(a.hashes[at] == h, a.by_hash[at], -1)
    while True:
        hit, longest = np.zeros(len(h), bool), np.zeros(len(off) - 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(off) - 1)]
        for lo, hi in _runs(a, tokens, rows):
            run, row = tokens[lo:hi].tolist(), rows[lo]
            longest[row] = max(longest[row], a.longest(run))
            for end, size, names in a.hits(run):
                hit[lo + end - size: lo + end] = True
                items[row] |= names
        # Exact check of what the hashes have found.
        wrong = [k for k in np.flatnonzero(hit) if words.data[words.start[k]: words.end[k]].tobytes() != a.words[tokens[k]]]
        if not wrong:
            return words, hit, items, longest
        tokens[wrong] = -1


def item_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


def automata(items: DataFrame, item_col: str, text_col: str, window: int, most: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """One automaton for each block of items; the driver holds one block."""
    block, size = [], 0
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    for item, text in rows.toLocalIterator():
        words = item_words(text)
        # An item longer than a block is cut into pieces that share window - 1 words.
        step = max(most, window)
        pieces = [words] if len(words) <= step else [words[k: k + step + window - 1] for k in range(0, len(words) - window + 1, step)]
        for piece in pieces:
            if block and size + len(piece) > most:
                yield Automaton(block, window)
                block, size = [], 0
            block.append((item or "", piece))
            size += len(piece)
    yield Automaton(block, window)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, text, n_words, n_hit, longest, items array<string>, spans
    array<struct<first, last>>) of every document; spans: hit words, numbered
    from 0, merged."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    one = _only(automata(items, item_col, item_text, window, block_words))
    if one is not None:
        marked = _marked(rows, docs.sparkSession.sparkContext.broadcast(one))
    else:
        own = rows.withColumns(_digests(F.col("text")))
        hits = _hits(own, automata(items, item_col, item_text, window, block_words))
        none = {"n_hit": F.lit(0), "longest": F.lit(0), "items": F.array().cast("array<string>"), "spans": F.array().cast(_SPANS)}
        marked = _counted(own).join(growing(hits), ["h1", "h2"], "left").withColumns({c: F.coalesce(c, v) for c, v in none.items()}) \
            .select("id", "text", "n_words", "n_hit", "longest", "items", "spans")
    return marked.withColumnsRenamed({"id": id_col, "text": text_col})


def _only(blocks: Iterator[Automaton]) -> Automaton | None:
    """The block, if there is one alone."""
    first = next(blocks)
    return first if next(blocks, None) is None else None


_SPANS = "array<struct<first:long,last:long>>"
_SPAN_LIST = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _marked(rows: DataFrame, shared) -> DataFrame:
    """(id, text, n_words, n_hit, longest, items, spans) by one block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column("text"))
            n_words, n_hit, longest = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            items, spans = [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
            for lo, hi in row_ranges(off):
                words, hit, names, most = scan(shared.value, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                n_words[lo:hi], longest[lo:hi] = words.counts, most
                for k in range(hi - lo):
                    mine = hit[words.first[k]: words.first[k + 1]]
                    if mine.any():
                        items[lo + k], n_hit[lo + k], spans[lo + k] = sorted(names[k]), mine.sum(), _spans(mine)
            yield from out_batches({"id": b.column("id"), "text": b.column("text"), "n_words": pa.array(n_words), "n_hit": pa.array(n_hit), "longest": pa.array(longest),
                                    "items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, _SPAN_LIST)})

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, text {kinds['text']}, n_words long, n_hit long, longest long, items array<string>, spans {_SPANS}")


# --- more than one block ---------------------------------------------------

def _digests(text: Column) -> dict[str, Column]:
    """Two hashes that stand for a text; a null one is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)}


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, h1, h2) with n_words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column("text"))
            n = np.zeros(b.num_rows, np.int64)
            for lo, hi in row_ranges(off):
                n[lo:hi] = Words(lower(data[off[lo]: off[hi]]), off[lo: hi + 1] - off[lo], ALNUM).counts
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n)], [*b.schema.names, "n_words"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, text {kinds['text']}, h1 long, h2 long, n_words long")


def _hits(rows: DataFrame, blocks: Iterable[Automaton]) -> DataFrame:
    """(h1, h2, n_hit, longest, items, spans) of the texts that any block hits,
    from ``rows`` (h1, h2, text): equal texts are one row.

    A pass for each block writes its hits alone; its broadcast ends with it."""
    spark, base = rows.sparkSession, scratch_path(rows.sparkSession, "hits")
    kinds = f"h1 long, h2 long, longest long, items array<string>, spans {_SPANS}"

    def find(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, off = text_bytes(b.column("text"))
                out = []
                for lo, hi in row_ranges(off):
                    words, hit, names, most = scan(shared.value, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                    out += [(lo + k, int(most[k]), sorted(names[k]), _spans(hit[words.first[k]: words.first[k + 1]])) for k in range(hi - lo) if names[k]]
                if out:
                    at, most, names, spans = zip(*out, strict=True)
                    yield from out_batches({"h1": b.column("h1").take(pa.array(at)), "h2": b.column("h2").take(pa.array(at)), "longest": pa.array(most, pa.int64()),
                                            "items": pa.array(names, pa.list_(pa.string())), "spans": pa.array(spans, _SPAN_LIST)})
        return run

    for k, a in enumerate(blocks):
        shared = spark.sparkContext.broadcast(a)
        found = rows.select("h1", "h2", "text").mapInArrow(find(shared), kinds)
        found.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("longest", "items", "spans")]).write.parquet(f"{base}/block={k}")
        shared.destroy()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [_joined(s) for s in b.column("spans").to_pylist()]
            n = [sum(x["last"] - x["first"] + 1 for x in s) for s in spans]
            yield from out_batches({c: b.column(c) for c in ("h1", "h2", "longest", "items")} | {"spans": pa.array(spans, _SPAN_LIST), "n_hit": pa.array(n, pa.int64())})

    every = spark.read.schema(f"{kinds}, block int").parquet(base).groupBy("h1", "h2").agg(
        F.max("longest").alias("longest"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    return written(every.mapInArrow(merged, f"{kinds}, n_hit long"), "hits")


def _joined(spans: list[dict[str, int]]) -> list[dict[str, int]]:
    """Spans that overlap or touch as one."""
    out: list[dict[str, int]] = []
    for s in sorted(spans, key=lambda x: x["first"]):
        if out and s["first"] <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], s["last"])
        else:
            out.append(dict(s))
    return out


def _spans(marks: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [{"first": s, "last": e - 1} for s, e in edge.reshape(-1, 2).tolist()]


def without(raw: np.ndarray, words: Words, spans: list[dict[str, int]]) -> str:
    """The text without the words of ``spans``."""
    keep = np.ones(len(raw), bool)
    for s in spans:
        keep[words.start[s["first"]]: words.end[s["last"]]] = False
    return raw[keep].tobytes().decode()


def cut(a: Automaton, text: str, max_coverage: float) -> str | None:
    """The text without its hit words; None if too much of it is hit.  What a
    cut brings together is read again, until nothing is hit."""
    first = True
    while True:
        raw = np.frombuffer(text.encode(), np.uint8)
        words, hit, _, _ = scan(a, raw, np.array([0, len(raw)], np.int64))
        if not hit.any():
            return text
        if first and hit.mean() > max_coverage:
            return None
        first = False
        text = without(raw, words, _spans(hit))


def _cut_by_one(docs: DataFrame, at: int, shared, max_coverage: float) -> DataFrame:
    """``cut`` by a single block, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(at))
            texts, keep = {}, np.ones(b.num_rows, bool)
            for lo, hi in row_ranges(off):
                words, hit, _, _ = scan(shared.value, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                for r in np.unique(words.rows()[hit]):
                    row = lo + int(r)
                    texts[row] = cut(shared.value, b.column(at)[row].as_py(), max_coverage)
                    keep[row] = texts[row] is not None
            if texts:
                column = b.column(at).to_pylist()
                for row, t in texts.items():
                    column[row] = t
                b = b.set_column(at, b.schema.field(at), pa.array(column, b.schema.field(at).type))
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _cut_by_all(docs: DataFrame, at: int, blocks: Callable[[], Iterable[Automaton]], max_coverage: float) -> DataFrame:
    """What ``cut`` gives with all blocks in one: each round marks the words
    that any block hits, then cuts; cut texts alone go through a further round."""
    name, now, out = docs.columns[at], docs, []
    h1, h2, spans = unused(docs.columns, "h1", "h2", "spans")
    own_columns = list(range(len(docs.columns)))

    def cutter(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts, keep = [], []
                for text, hit in zip(b.column(at).to_pylist(), b.column(spans).to_pylist(), strict=True):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    words = Words(lower(raw), np.array([0, len(raw)], np.int64), ALNUM)
                    # Coverage is a share of the original text.
                    keep.append(not first or sum(s["last"] - s["first"] + 1 for s in hit) <= max_coverage * len(words.start))
                    texts.append(without(raw, words, hit))
                rows = b.select(own_columns)
                yield rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type)).filter(pa.array(keep))
        return run

    while True:
        digests = _digests(F.col(f"`{name}`"))
        own = now.withColumns({h1: digests["h1"], h2: digests["h2"]})
        hits = _hits(own.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"), F.col(f"`{name}`").alias("text")), blocks()) \
            .select(F.col("h1").alias(h1), F.col("h2").alias(h2), F.col("spans").alias(spans))
        out.append(own.join(growing(hits.select(h1, h2)), [h1, h2], "left_anti").select(*docs.columns))
        hit = own.join(growing(hits), [h1, h2]).select(*docs.columns, spans)
        now = written(hit.mapInArrow(cutter(len(out) == 1), docs.schema), "cut")
        if now.isEmpty():
            return reduce(DataFrame.unionByName, out)


def remove_passages(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", length_col: str | None = None,
                    window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with hit passages cut out of the text and documents over
    ``max_coverage`` dropped; ``length_col``, if given, gets the new length."""
    at = docs.columns.index(text_col)
    blocks = partial(automata, items, item_col, item_text, window, block_words)
    one = _only(blocks())
    out = _cut_by_one(docs, at, docs.sparkSession.sparkContext.broadcast(one), max_coverage) if one is not None else _cut_by_all(docs, at, blocks, max_coverage)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col else out
