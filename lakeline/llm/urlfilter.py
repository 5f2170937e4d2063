"""URL filter: rules first, gradient-boosted trees for the rest.

A rule (host and path prefix) fits its host and all subdomains where the url's
path starts with the rule's path; the longest fitting rule decides.  Urls that
a rule decides are the labelled urls.  Trees learn from their lexical features
- lengths, depth, digit ratio, character entropy, parameter counts, and
statistics of suffixes - and judge the urls without a rule.

Suffix statistics: for the last one and two host labels, the first path
segment and the file suffix, the number of labelled urls and the smoothed
share of blocked ones, over all labelled urls, in 2**BUCKET_BITS hash buckets
each, drawn toward the overall share by a prior (taking a row's own label out
would give the label away by the gap it leaves).

Defined results: a null url or one without ``://`` has an empty host and path,
no rule, and the method's verdict.  With no labelled url the method allows;
with labels of one kind it gives that kind.  Repeated urls are judged alike;
an empty table gives an empty result.

Native: DataFrame expressions and Spark ML's JVM trees only.  The trees are
fitted on at most ``TRAIN_ROWS`` different labelled urls, those of least hash
(documented bound), weighed by their rows.  Broadcast are the statistics (4 * 2**BUCKET_BITS rows at
most).  The rule list is a parameter of a handful of rules; it becomes one
expression.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.llm.common import written

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
TRAIN_ROWS = 20_000
BUCKET_BITS = 12
PRIOR = 20.0    # weight of the overall share in a suffix's share
TREES, DEPTH, SEED = 20, 4, 11

SUFFIXES = ("tld", "domain", "segment", "file")


def _host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def parsed(urls: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """(id, _url, host, path)"""
    rows = urls.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("_url"))
    host, path = _host_path(F.col("_url"))
    return rows.withColumn("host", host).withColumn("path", path)


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    own = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
    return own & F.startswith("path", F.lit(slash + path))


def with_rule(rows: DataFrame, rules) -> DataFrame:
    """``rule`` and ``verdict`` of the longest rule that fits, else null."""
    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule = F.coalesce(*[F.when(_fits(r), F.lit(r)) for _, r in longest], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(_fits(r), F.lit(v)) for v, r in longest], F.lit(None).cast("string"))
    return rows.withColumn("rule", rule).withColumn("by_rule", verdict)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.filter(F.split(text, ""), lambda c: F.length(c) > 0)
    n = F.size(letters).cast("double")
    counts = F.transform(F.array_distinct(letters), lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))))
    return F.when(n == 0, 0.0).otherwise(-F.aggregate(counts, F.lit(0.0), lambda a, k: a + (k / n) * F.log2(k / n)))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


LEXICAL = ("length", "host_length", "path_length", "labels", "hyphens", "depth", "digits", "host_digits", "entropy", "params", "query_length", "secure")


def lexical(rows: DataFrame) -> DataFrame:
    url, host, path = F.col("_url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    label = F.split(host, r"\.")
    size = F.greatest(F.length(url), F.lit(1))
    number = {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "labels": F.size(label), "hyphens": _count(host, "-"),
        "depth": _count(path, "/"), "digits": _count(url, "[0-9]") / size, "host_digits": _count(host, "[0-9]"), "entropy": _entropy(url),
        "params": F.when(F.length(query) == 0, 0).otherwise(_count(query, "&") + 1), "query_length": F.length(query), "secure": F.startswith(url, F.lit("https")).cast("int"),
    }
    suffix = {
        "tld": F.element_at(label, -1), "domain": F.array_join(F.slice(label, F.greatest(F.size(label) - 1, F.lit(1)), F.lit(2)), "."),
        "segment": F.regexp_extract(path, r"^/([^/]*)", 1), "file": F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1),
    }
    rows = rows.withColumns({k: v.cast("double") for k, v in number.items()})
    return rows.withColumns({f"k_{k}": F.xxhash64(F.lit(k), v).bitwiseAND((1 << BUCKET_BITS) - 1).cast("int") for k, v in suffix.items()})


def with_statistics(rows: DataFrame, labelled: DataFrame, share: float) -> DataFrame:
    """Count and smoothed blocked share of each suffix."""
    for k in SUFFIXES:
        stat = written(labelled.groupBy(f"k_{k}").agg(F.count("*").alias(f"n_{k}"), F.sum("label").alias(f"b_{k}")), "suffix")
        n, b = F.coalesce(F.col(f"n_{k}"), F.lit(0)), F.coalesce(F.col(f"b_{k}"), F.lit(0.0))
        rows = rows.join(F.broadcast(stat), f"k_{k}", "left").withColumns({f"count_{k}": F.log1p(n.cast("double")), f"share_{k}": (b + PRIOR * share) / (n + PRIOR)}) \
            .drop(f"n_{k}", f"b_{k}")
    return rows


FEATURES = [*LEXICAL, *(f"{s}_{k}" for k in SUFFIXES for s in ("count", "share"))]


def train(labelled: DataFrame, share: float, most: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH):
    """Trees fitted on the ``most`` different labelled urls of least hash, each
    weighed by its number of rows: a hot url takes one place of the sample."""
    h = F.xxhash64("_url")
    own = ["_url", "label", *LEXICAL, *(f"k_{k}" for k in SUFFIXES)]  # all follow from the url
    sample = labelled.groupBy(*own).agg(F.count(F.lit(1)).cast("double").alias("weight")).orderBy(h, "_url", "label").limit(most)
    ready = with_statistics(sample, labelled, share)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(ready)
    ready = written(ready.select("label", "features", "weight", h.alias("h"), "_url").coalesce(1).sortWithinPartitions("h", "_url", "label")
                    .select("label", "features", "weight"), "train")
    return GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, seed=SEED).fit(ready.coalesce(1))


def scored(rows: DataFrame, labelled: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``rows`` with ``guess``: allow or block by the trees."""
    kinds = {r[0]: r[1] for r in labelled.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return rows.withColumn("guess", F.lit("block" if 1.0 in kinds else "allow"))
    share = kinds[1.0] / sum(kinds.values())
    model = train(labelled, share, most)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_statistics(rows, labelled, share))
    return model.transform(ready).withColumn("guess", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))


def filter_urls(urls: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, most: int = TRAIN_ROWS) -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    rows = written(lexical(with_rule(parsed(urls, id_col, url_col), rules)), "urls")
    labelled = rows.where(F.col("by_rule").isNotNull()).withColumn("label", (F.col("by_rule") == "block").cast("double"))
    return scored(rows, labelled, most).select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", "guess").alias("verdict"))
