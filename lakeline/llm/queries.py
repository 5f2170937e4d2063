"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm import (chat, decontaminate, editprint, linededup, mixing, negatives, quality, sharding, simhash, tokenid, urlfilter, warc,
                          whitening)
from lakeline.llm.common import prepare, table
from lakeline.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@_query
def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.crawl_of_pages(table(spark, sf_dir, "pages")))
    return found.select(F.expr("record_id div 2").alias("page_id"), "record_id", F.col("curl").alias("canonical_url"), "status", "refers_to", "digest",
                        warc.header_lines(F.col("headers")).alias("headers"))


@_query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def token_file_digests(docs: DataFrame) -> DataFrame:
    """Write the ids of ``docs`` and digest them from the files read back."""
    blocks, codebook = tokenid.write_ids(docs, tokenid.vocabulary())
    return tokenid.read_ids(blocks, codebook, tokenid.ids_crc32, "long") \
        .select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("value").alias("ids_crc32"))


@_query
def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(table(spark, sf_dir, "documents"))


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


@_query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(said).alias("text"))
    path = tokenid.vocabulary("byte_bpe_50k.json")
    return chat.read_chat(chat.format_chat(rows.unionByName(own), path), path).withColumnRenamed("conv", "conv_id")


@_query
def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


@_query
def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@_query
def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return negatives.mine(rows, F.col("id") % 100 == 0)


@_query
def op13_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edited(table(spark, sf_dir, "documents"))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
