"""Access to the input tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazily opened Parquet tables; each access is a fresh scan so Catalyst
    can prune columns and push filters per query.  ``apart``: the handle of one
    run of a query, which makes every table that it derives, and reads none
    that another handle made."""

    def __init__(self, spark: SparkSession, sf_dir: str, apart: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.apart = apart

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
