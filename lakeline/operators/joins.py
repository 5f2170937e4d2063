"""Join helpers.  Broadcasting is left to the planner and AQE, which go by size in bytes."""


from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def role_copy(dim: DataFrame, prefix: str, mapping: dict[str, str]) -> DataFrame:
    """One role of a role-playing dimension: select + alias with a prefix."""
    return dim.select(*[F.col(src).alias(f"{prefix}_{dst}") for src, dst in mapping.items()])
