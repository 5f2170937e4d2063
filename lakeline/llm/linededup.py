"""Line dedup over windows of three consecutive lines.

Lines with a visible character are numbered; each three in a row are a window
(trailing white space apart).  A window found earlier, by (id, text hash,
position), is a repeat, and all lines from its first to its last are removed
from the later text.  Covered positions of overlapping repeats merge.  All
windows are judged on the original texts, so no order of work matters.

Defined results: a null text stays null, with no lines; a text of fewer than
three visible lines has no window and stays.  Rows equal in id and text count
as one document and get the same result.  A null id sorts first.

Scale: windows travel as two 64-bit hashes with id and position.  Repeated
windows are found by an aggregate (combined map-side, so a line that is
everywhere is a row for each task); the join back reads them as a written
table, so AQE can split a hot window.  Texts are joined once with the repeats
of their document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import growing, written

WINDOW = 3
BLANK = r"[ \t\x0B\f\r]+$"


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(id, mark, first, last, h1, h2): one row for each window; ``mark``: hash
    of the text; ``first`` / ``last``: line positions from 0."""
    text = F.col(text_col).cast("string")
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), F.regexp_replace(x, BLANK, "").alias("line"))),
                     lambda x: F.length(x["line"]) > 0)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), lines.alias("lines")).where(F.size("lines") >= size)
    at = F.sequence(F.lit(1), F.size("lines") - (size - 1))
    wide = rows.select("id", "mark", "lines", F.explode(at).alias("k"))
    line = [F.element_at("lines", F.col("k") + j) for j in range(size)]
    text_of = [x["line"] for x in line]
    return wide.select("id", "mark", line[0]["at"].alias("first"), line[-1]["at"].alias("last"), F.xxhash64(*text_of).alias("h1"),
                       F.xxhash64(F.lit(size), *reversed(text_of)).alias("h2"))


def repeats(windows: DataFrame) -> DataFrame:
    """(id, mark, spans): the covered line ranges of each document, in order."""
    place = F.struct(F.col("id"), F.col("mark"), F.col("first"))
    # Rows equal in id and text are the same place; they make no repeat.
    known = windows.groupBy("h1", "h2").agg(F.min(place).alias("least"), F.max(place).alias("most")).where(~F.col("least").eqNullSafe(F.col("most")))
    later = windows.join(growing(written(known.select("h1", "h2", "least"), "known")), ["h1", "h2"]).where(~place.eqNullSafe(F.col("least")))
    return later.groupBy("id", "mark").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("spans"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(id, text, n_lines, n_removed) of every row of ``docs``."""
    found = written(repeats(line_windows(docs, id_col, text_col, size)), "repeats")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).withColumn("_mark", F.xxhash64("_text"))
    lines = F.split("_text", "\n", -1)
    n = F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines))
    # Kept ranges lie between the spans: spans start and end in the same order.
    start = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["last"] + 1))
    stop = F.concat(F.transform("spans", lambda s: s["first"]), F.array(n))
    kept = F.flatten(F.transform(F.arrays_zip(start.alias("a"), stop.alias("b")),
                                 lambda r: F.when(r["b"] > r["a"], F.slice(lines, r["a"] + 1, r["b"] - r["a"])).otherwise(F.array().cast("array<string>"))))
    joined = rows.join(growing(found), F.col("_id").eqNullSafe(found["id"]) & (F.col("_mark") == found["mark"]), "left")
    clean = joined.select(F.col("_id"), F.col("_text"), n.alias("_n"), F.when(F.col("spans").isNotNull(), kept).alias("_kept"))
    return clean.select(F.col("_id").alias(id_col), F.when(F.col("_kept").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n")).alias(text_col),
                        F.col("_n").cast("long").alias("n_lines"), F.when(F.col("_kept").isNull(), 0).otherwise(F.col("_n") - F.size("_kept")).cast("long").alias("n_removed"))
