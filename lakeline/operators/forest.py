"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

1. Sampling: for each of ``n_trees`` trees, the ``sample_size`` rows with the
   smallest seeded hash of (key, tree).  A Bernoulli pre-filter on the same
   hash keeps about 4x the needed rows per tree, so only ~4 x 256 x n_trees
   rows are exploded, whatever the table size; the exact top-k per tree is a
   window over that small set.
2. Building: ``groupBy(tree).applyInPandas`` grows one random tree per group
   (seeded by the tree id) and returns its nodes as rows.
3. Scoring: the forest (at most n_trees x (2 x sample_size - 1) nodes) is
   collected and broadcast; ``mapInPandas`` scores Arrow batches with numpy,
   walking all rows of a batch down a tree level by level.

Rows with a missing feature (NULL or NaN) are in no sample and have no score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from lakeline.functions import fixed
from lakeline.functions.exprs import present

EULER = 0.5772156649015329

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()), T.StructField("depth", T.IntegerType()),
])


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _grow(tree_id: int, x: np.ndarray, limit: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed * 1_000_003 + tree_id)
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree_id, me, -1, 0.0, -1, -1, int(len(idx)), depth])
        if depth >= limit or len(idx) <= 1:
            return me
        sub = x[idx]
        spread = sub.max(axis=0) - sub.min(axis=0)
        usable = np.flatnonzero(spread > 0)
        if usable.size == 0:
            return me
        f = int(rng.choice(usable))
        lo, hi = sub[:, f].min(), sub[:, f].max()
        thr = float(rng.uniform(lo, hi))
        go_left = sub[:, f] < thr
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][2], nodes[me][3], nodes[me][4], nodes[me][5] = f, thr, left, right
        return me

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


@dataclass
class Forest:
    features: list[str]
    nodes: pd.DataFrame
    sample_size: int

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Anomaly score 2^(-E[h(x)] / c(ψ)) per row (higher = more isolated)."""
        spark = df.sparkSession
        trees = []
        for _, g in self.nodes.groupby("tree"):
            g = g.sort_values("node")
            # path length credited at a leaf: its depth + c(size) for the unbuilt subtree
            leaf = g["depth"].to_numpy(dtype=float) + np.array([c_factor(s) for s in g["size"]])
            trees.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                          g["right"].to_numpy(), leaf))
        bc = spark.sparkContext.broadcast(trees)
        feats = list(self.features)
        norm = c_factor(self.sample_size)
        schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType())])

        def run(batches):
            forest = bc.value
            for pdf in batches:
                x = pdf[feats].to_numpy(dtype=float)
                total = np.zeros(len(x))
                for feat, thr, left, right, leaf in forest:
                    node = np.zeros(len(x), dtype=np.int64)
                    active = feat[node] >= 0
                    while active.any():
                        f = feat[node[active]]
                        go_left = x[active, f] < thr[node[active]]
                        nxt = np.where(go_left, left[node[active]], right[node[active]])
                        node[active] = nxt
                        active = feat[node] >= 0
                    total += leaf[node]
                score = np.power(2.0, -(total / max(1, len(forest))) / (norm or 1.0))
                pdf[out] = pd.Series(score, pdf.index, dtype="Float64").mask(np.isnan(x).any(axis=1))
                yield pdf

        return df.mapInPandas(run, schema)


def fit(df: DataFrame, key: str, features: list[str], n_trees: int = fixed.FOREST_TREES,
        sample_size: int = fixed.FOREST_SAMPLE,
        seed: int = 42, oversample: float = 4.0) -> Forest:
    for c in features:
        df = df.filter(present(c).isNotNull())
    n = df.count()
    psi = min(sample_size, n)
    p = min(1.0, oversample * psi / max(n, 1))
    limit = int(math.ceil(math.log2(max(psi, 2))))
    u = lambda t: (F.shiftrightunsigned(F.xxhash64(F.col(key), t, F.lit(seed)), 1) / F.lit(float(1 << 63)))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: u(t) < F.lit(p))
    cand = (df.select(key, *features, F.explode(trees).alias("tree"))
            .withColumn("u", F.shiftrightunsigned(F.xxhash64(F.col(key), F.col("tree"), F.lit(seed)), 1)))
    # each tree group holds ~oversample * psi rows: bounded
    pick = cand.withColumn("r", F.row_number().over(Window.partitionBy("tree").orderBy("u", key))).filter(
        F.col("r") <= psi).drop("r", "u")
    feats = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(key)
        rows = _grow(tid, pdf[feats].to_numpy(dtype=float), limit, seed)
        return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])

    nodes = pick.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()  # n_trees x <= 2*psi rows
    return Forest(feats, nodes, psi)


def flag(scored: DataFrame, score: str = "score", contamination: float | None = None) -> DataFrame:
    """Outlier flag: score above 0.5 ('auto'), or above the (1 - contamination)
    quantile of the scores."""
    if contamination is None:
        cut = 0.5
    else:
        from lakeline.operators.keys import exact_quantiles
        found = exact_quantiles(scored, [score], [1.0 - contamination]).first()
        cut = found["value"] if found else None  # no scores, no flags
    return scored.withColumn("is_outlier", F.col(score) > F.lit(cut).cast("double"))


def outlier_share(flagged: DataFrame) -> DataFrame:
    """rows, outliers and their share."""
    g = flagged.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_outlier").alias("outliers"))
    return g.withColumn("share", F.col("outliers") / F.col("rows"))


def inliers(flagged: DataFrame) -> DataFrame:
    """The rows that are no outliers, without the flag."""
    return flagged.filter(~F.col("is_outlier")).drop("is_outlier")
