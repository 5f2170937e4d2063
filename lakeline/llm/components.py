"""Connected components of a link table by alternating large and small stars.

Each round replaces links by links to the least neighbour, as joins on the
node with its aggregated minimum (aggregated map-side first; the minima are a
written table, so AQE can split a hub's rows over tasks).  Rounds grow with
the logarithm of a component's size.  Nothing is collected but two numbers a
round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import written


def _mark(links: DataFrame) -> tuple[int, int]:
    """Number of links and the sum of their hashes: equal marks, equal tables."""
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], int(r[1] or 0)


def _toward(links: DataFrame, least: DataFrame) -> DataFrame:
    return links.join(written(least, "least"), "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the component's least
    node.  ``links``: (u, v), any direction, repeats and self-links allowed."""
    links = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _toward(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _toward(large, low).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        links = written(small.where("u <> v").distinct(), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    # Every node is a spoke of its root now.
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
