"""Document fingerprints by Order MinHash: likeness falls with edit distance.

A text's pieces are its runs of up to 16 characters that aren't white space;
its k-mers are ``K`` pieces in a row.  Each k-mer carries its occurrence
number in the text, so repeats count.  For each of ``ORDERS`` orders of the
hashes of (k-mer, number) the ``CHOSEN`` smallest are selected, put back into
text order and hashed together: an entry is equal in two texts if they share
these k-mers in the same order.  Likeness is the share of equal entries.

All orders come from one hash: order j counts hash values from the probe
j * 2**35 / ORDERS on, round the circle.  Hashes are independent of the texts,
so each such order is a random one, and its smallest elements are the next in
the sorted hashes, found by bisection.  The work on a text is two sorts and
ORDERS bisections, in place of ORDERS hashes of every k-mer.

Defined results: a null text is empty.  A text of fewer than K pieces is one
k-mer; one without pieces has the entries of the empty selection, and two such
texts have likeness 1.  The next document is the next row by (id, hash of the
text), null ids first; after the last comes the first, and a single document
is its own next.  Rows equal in id and text are documents of their own, whose
next is another copy but for the last.  An empty table gives an empty result.
k-mers of a text count as equal at 35 equal bits of their hashes; a text has
fewer than 2**28 pieces.

Scale: a text is shuffled once, with its fingerprint, into slices of the id
order; splitters come from a sample weighted by bytes (``SLICES`` for each
shuffle partition, which the driver holds), and the row at a splitter goes to
the slice before as well.  Rows equal in id and text that fill several slices
are dealt over as many.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.common import tasks

PIECE = r"[^\x20\x09-\x0D]{1,16}"
K = 2
CHOSEN = 2
ORDERS = 64
SLICES = 8             # slices for each shuffle partition
DRAWN = 4              # sampled rows for each slice
SEED = 13
SURE = 2000            # copies of a row for each slice that they are dealt over, at least
_PLACE = 28            # bits of a packed number that hold a place in the text
_HASH = 63 - _PLACE
_LOW = -(1 << 63)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _packed(h: Column, place: Column) -> Column:
    """The first bits of a hash above a place."""
    return F.shiftleft(F.shiftrightunsigned(h, 64 - _HASH), _PLACE).bitwiseOR(place.cast("long"))


def _upto(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def kmers(text: Column, k: int = K) -> Column:
    """Hashes of the k-mers of ``text``, in text order."""
    def of(a: Column) -> Column:
        wide = F.transform(F.sequence(F.lit(0), F.size(a) - k), lambda i: F.xxhash64(*[F.get(a, i + j) for j in range(k)]))
        return F.when(F.size(a) >= k, wide).when(F.size(a) > 0, F.array(F.xxhash64(a))).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda w: F.xxhash64(w)), of)


def _numbered(found: Column) -> Column:
    """Sorted packed hashes of (k-mer, occurrence number) with their places."""
    def runs(p: Column) -> Column:
        kmer = lambda i: F.shiftright(F.get(p, i), _PLACE)
        first = F.filter(_upto(F.size(p)), lambda i: (i == 0) | (kmer(i) != kmer(i - 1)))
        number = _let(first, lambda s: F.flatten(F.transform(s, lambda at, r: F.sequence(F.lit(0), F.coalesce(F.get(s, r + 1), F.size(p)) - at - 1))))
        return _let(number, lambda n: F.sort_array(F.transform(p, lambda x, i: _packed(F.xxhash64(F.shiftright(x, _PLACE), F.get(n, i)), x.bitwiseAND(F.lit((1 << _PLACE) - 1))))))

    return _let(F.sort_array(F.transform(found, lambda h, i: _packed(h, i))), runs)


def _entries(found: Column, order: Column, probes: Column, chosen: int) -> Column:
    """The entry of each order, that is, of each probe."""
    n = F.size(order)
    steps = F.transform(F.sequence(F.floor(F.log2(n.cast("double"))).cast("int"), F.lit(0), F.lit(-1)), lambda s: F.call_function("shiftleft", F.lit(1), s))

    def of(probe: Column, steps: Column) -> Column:
        # Elements below the probe, by bisection: get() past the end is null.
        below = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(order, at + s - 1) < probe, at + s).otherwise(at))
        places = _let(below, lambda at: F.sort_array(F.transform(_upto(F.least(F.lit(chosen), n)), lambda t: F.get(order, (at + t) % n).bitwiseAND(F.lit((1 << _PLACE) - 1)))))
        return F.xxhash64(F.transform(places, lambda x: F.get(found, x.cast("int")))).bitwiseAND(F.lit(0xFFFFFFFF))

    return _let(steps, lambda s: F.transform(probes, lambda p: of(p, s)))


def signature(text: Column, k: int = K, chosen: int = CHOSEN, orders: int = ORDERS) -> Column:
    """The entries of ``text``, an array of ``orders`` numbers below 2**32."""
    probes = F.transform(F.sequence(F.lit(0), F.lit(orders - 1)), lambda j: F.shiftleft(F.floor(j * F.lit(2.0 ** _HASH / orders)), _PLACE))
    empty = F.array_repeat(F.xxhash64(F.array().cast("array<bigint>")).bitwiseAND(F.lit(0xFFFFFFFF)), orders)
    return _let(kmers(text, k), lambda a: F.when(F.size(a) == 0, empty).otherwise(_let(_numbered(a), lambda h: _entries(a, h, probes, chosen))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries of two signatures."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)
    return F.size(same) / F.size(a).cast("double")


def as_text(entries: Column) -> Column:
    """A signature as a string of eight hex digits for each entry."""
    return F.array_join(F.transform(entries, lambda e: F.lower(F.lpad(F.hex(e), 8, "0"))), "")


# --- documents and the next one --------------------------------------------

def _splitters(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(tie, mark, copies): the first key of each slice, and over how many
    slices the rows of that key are dealt."""
    size = F.octet_length("text") + 200.0
    count, total, least = rows.agg(F.count("*"), F.sum(size), F.min(F.struct("tie", "mark"))).first()
    if not count:
        return []
    pieces = SLICES * tasks(rows.sparkSession)
    rate = min(1.0, DRAWN * pieces / total * (total / count))  # of a row of mean size
    drawn = sorted(tuple(r) for r in rows.where(F.rand(SEED) < size * (rate * count / total)).select("tie", "mark").collect())
    step = max(1, round(len(drawn) / pieces))
    times = Counter(drawn[step // 2::step])
    share = Counter(drawn)
    first = {tuple(least): 1} | {key: max(1, min(n + 1, int(share[key] / rate) // SURE) if n > 1 else 1) for key, n in times.items()}
    return sorted((*key, copies) for key, copies in first.items())


def with_next(rows: DataFrame, carried: list[str]) -> DataFrame:
    """``rows`` (tie, mark, text, ...) with, for each of the columns
    ``carried``, next_<name>: that of the next row by (tie, mark), the first
    after the last."""
    bounds = _splitters(rows)
    if not bounds:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    js = json.dumps([{"t": t, "m": m, "c": c} for t, m, c in bounds])
    table = F.from_json(F.lit(js), "array<struct<t: bigint, m: bigint, c: int>>")
    n = len(bounds)
    steps = [1 << b for b in reversed(range(n.bit_length()))]

    def after(at: Column, s: Column) -> Column:
        b = F.get(table, at + s - 1)
        return F.when((b["t"] < F.col("tie")) | ((b["t"] == F.col("tie")) & (b["m"] <= F.col("mark"))), at + s).otherwise(at)

    slice_ = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), after) - 1
    own = F.get(table, F.col("slice"))
    at_bound = (own["t"] == F.col("tie")) & (own["m"] == F.col("mark"))
    part = F.when((own["c"] > 1) & at_bound, F.pmod(F.xxhash64(F.monotonically_increasing_id()), own["c"]).cast("int")).otherwise(own["c"] - 1)
    before = F.pmod(F.col("slice") - 1, F.lit(n))
    here = F.struct(F.col("slice").alias("slice"), F.col("part").alias("part"), F.lit(0).alias("copy"))
    there = F.struct(before.alias("slice"), (F.get(table, before)["c"] - 1).alias("part"), F.lit(1).alias("copy"))
    sent = rows.withColumn("slice", slice_).withColumn("part", part) \
        .withColumn("to", F.explode(F.when(at_bound & ((F.col("part") == 0) | (own["c"] == 1)), F.array(here, there)).otherwise(F.array(here)))) \
        .select(*rows.columns, "to.*")
    order = Window.partitionBy("slice", "part").orderBy("copy", "tie", "mark")
    # Each column by itself: a struct of them would be shuffled beside them.
    return sent.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).where("copy = 0") \
        .select(*rows.columns, *[F.coalesce(f"next_{c}", c).alias(f"next_{c}") for c in carried])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, chosen: int = CHOSEN, orders: int = ORDERS) -> DataFrame:
    """(id, n_chars, text, entries, next_text, next_entries) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")) \
        .select("id", "text", F.coalesce("id", F.lit(_LOW)).alias("tie"), F.xxhash64("text").alias("mark"))
    # Splitters need no entries: they are worked out on the way to the shuffle.
    return with_next(rows.withColumn("entries", signature(F.col("text"), k, chosen, orders)), ["text", "entries"]) \
        .select(F.col("id").alias(id_col), F.length("text").cast("long").alias("n_chars"), "text", "entries", "next_text", "next_entries")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, chosen: int = CHOSEN, orders: int = ORDERS) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): each text against an edited one, whose last half
    comes from the next document."""
    half = F.expr("cast(n_chars div 2 as int)")
    new = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    rows = fingerprints(docs, id_col, text_col, k, chosen, orders).withColumn("edited", new)
    rows = rows.select(id_col, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "entries", signature(F.col("edited"), k, chosen, orders).alias("again"),
                       "next_entries")
    return rows.select(id_col, "n_chars", "edited_sha256", as_text(F.col("entries")).alias("fingerprint"), as_text(F.col("again")).alias("edited_fingerprint"),
                       likeness(F.col("entries"), F.col("again")).alias("near_edited"), likeness(F.col("entries"), F.col("next_entries")).alias("near_next"))
