"""Declarative data tests: one output row per test, ``(test, failures)``.

All column-level tests of one table run in a single aggregate pass; the
relationship test is an anti-join; the uniqueness test a grouped count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class NotNull:
    column: str

    @property
    def name(self):
        return f"not_null:{self.column}"


@dataclass
class AcceptedValues:
    column: str
    values: list

    @property
    def name(self):
        return f"accepted_values:{self.column}"


@dataclass
class Relationship:
    column: str
    to: DataFrame
    field: str

    @property
    def name(self):
        return f"relationships:{self.column}->{self.field}"


@dataclass
class Unique:
    columns: list = field(default_factory=list)

    @property
    def name(self):
        return "unique:" + ",".join(self.columns)


def run_tests(df: DataFrame, tests: list) -> DataFrame:
    spark = df.sparkSession
    col_aggs = []
    parts: list[DataFrame] = []
    for t in tests:
        if isinstance(t, NotNull):
            col_aggs.append(F.count_if(F.col(t.column).isNull()).alias(t.name))
        elif isinstance(t, AcceptedValues):
            # NULL is not a failure here; not_null covers it.
            col_aggs.append(F.count_if(F.col(t.column).isNotNull() & ~F.col(t.column).isin(t.values)).alias(t.name))
        elif isinstance(t, Relationship):
            orphans = df.select(t.column).filter(F.col(t.column).isNotNull()).join(
                t.to.select(F.col(t.field).alias(t.column)), t.column, "left_anti")
            parts.append(orphans.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(t.name).alias("test"), "failures"))
        elif isinstance(t, Unique):
            # A key with a NULL part is no duplicate, as in a SQL unique rule.
            dup = df.dropna(subset=list(t.columns)).groupBy(*t.columns).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
            parts.append(dup.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(t.name).alias("test"), "failures"))
        else:
            raise TypeError(t)
    if col_aggs:
        wide = df.agg(*col_aggs)
        names = [a for a in wide.columns]
        parts.insert(0, wide.unpivot([], names, "test", "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test", F.col("failures").cast("bigint").alias("failures"))


def _fails(df: DataFrame, tests: list) -> tuple[DataFrame, dict]:
    """``df`` with what the tests need beside a row, and for each test the
    condition under which a row fails."""
    bad = {}
    for k, t in enumerate(tests):
        if isinstance(t, NotNull):
            bad[t.name] = F.col(t.column).isNull()
        elif isinstance(t, AcceptedValues):
            bad[t.name] = F.col(t.column).isNotNull() & ~F.col(t.column).isin(t.values)
        elif isinstance(t, Relationship):
            known = t.to.select(F.col(t.field).alias(f"__key{k}")).distinct().withColumn(f"__hit{k}", F.lit(True))
            df = df.join(known, F.col(t.column) == F.col(f"__key{k}"), "left")
            bad[t.name] = F.col(t.column).isNotNull() & F.col(f"__hit{k}").isNull()
        else:
            raise TypeError(f"{t} is no test of a single row: run it on the written table")
    return df, bad


def write_checked(df: DataFrame, tests: list, path: str) -> DataFrame:
    """Write ``df`` and test its rows in the same pass over it.

    Rows that pass and rows that don't go to folders of their own under
    ``path`` (``kept``, ``quarantined``), the latter with the names of the tests
    they fail in ``failed``.  Returns (measure, rows): rows
    in, kept and quarantined, and each test's failures, all counted by the
    write itself (an Observation), so the source is read once."""
    rows, bad = _fails(df, tests)
    failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in bad.items()]), lambda n: n.isNotNull())
    flagged = rows.select(*df.columns, failed.alias("failed"))
    seen = Observation()
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(F.size("failed") == 0).alias("rows_kept"),
                              F.count_if(F.size("failed") > 0).alias("rows_quarantined"), *[F.count_if(F.array_contains("failed", n)).alias(n) for n in bad])
    counted.withColumn("__state", F.when(F.size("failed") == 0, "good").otherwise("bad")).write.mode("overwrite").partitionBy("__state").parquet(path)
    return df.sparkSession.createDataFrame(list(seen.get.items()), "measure string, rows long")


def kept(spark, path: str, schema: T.StructType) -> DataFrame:
    """Rows that passed; ``schema``: that of the frame that was written."""
    return _state(spark, path, schema, "good").drop("failed")


def quarantined(spark, path: str, schema: T.StructType) -> DataFrame:
    """Rows that failed, with the tests they failed."""
    return _state(spark, path, schema, "bad")


def _state(spark, path: str, schema: T.StructType, state: str) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("failed", T.ArrayType(T.StringType())), T.StructField("__state", T.StringType())])
    return spark.read.schema(whole).parquet(path).filter(F.col("__state") == state).drop("__state")


def schema_contract(df: DataFrame, expected: T.StructType, check_nullability: bool = False) -> list[str]:
    """Differences between a frame's schema and the expected one (T5)."""
    problems = []
    got = {f.name: f for f in df.schema.fields}
    for f in expected.fields:
        g = got.get(f.name)
        if g is None:
            problems.append(f"missing {f.name}")
            continue
        if g.dataType != f.dataType:
            problems.append(f"type {f.name}: {g.dataType.simpleString()} != {f.dataType.simpleString()}")
        if check_nullability and not f.nullable and g.nullable:
            problems.append(f"nullable {f.name}")
    return problems
