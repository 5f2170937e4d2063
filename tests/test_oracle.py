"""A representative slice of registered queries against their DuckDB SQL at
sf0.001 (the full sweep at sf0.01 is ``python tests/oracle_check.py``)."""

import duckdb
import pytest

from oracle_check import compare, duck
from lakeline.plans.registry import load_all

KEYS = ["revenue_by_zone_month", "silver_joined", "star_fact", "star_q2", "upsert_raw", "test_unique",
        "layout_hash", "describe_numeric", "prep_mixed", "ols_normal", "stream_ingest",
        "incremental_zone_fact", "corr_rank"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, load_all()[key], SF)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["exact"], r
