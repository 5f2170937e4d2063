"""Named queries: each has a Spark form and, where SQL can say it, the
equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeline.plans.tables import Tables
from lakeline.session import apply_runtime_conf


@dataclass
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    note: str = ""

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return self.build(Tables(spark, sf_dir, apart=True))  # each call does its whole job


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, note)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from lakeline.plans import (  # noqa: F401
        features, layouts, loads, profiles, regression, reports, streams, warehouse,
    )
    return REGISTRY
