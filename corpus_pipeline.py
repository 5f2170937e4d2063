"""The corpus pipeline: five stages over the documents table.

quality rules, SimHash near-dedup, benchmark decontamination, mixing sources
to target weights, and token-id output.  Each stage takes (spark, docs,
sf_dir) and returns a DataFrame that is written and read again as the next
one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeline.llm import decontaminate, mixing, quality, simhash
from lakeline.llm.common import prepare, table, written
from lakeline.llm.queries import token_file_digests


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; mostly contaminated documents go."""
    prepare(spark)
    return decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark"), length_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    prepare(spark)
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are written to files; their digests are read back from them."""
    prepare(spark)
    return token_file_digests(docs)


STAGES = [("quality", rules), ("simhash", near_dedup), ("decontaminate", decontamination), ("mix", mix), ("tokens", token_ids)]

# Stages hash, fit and encode with libraries that SQL does not have; tests
# check the pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
