"""Edge rows: NULLs in rule columns, zero denominators, text sentinels."""

from decimal import Decimal

from pyspark.sql import functions as F

from lakeline.operators import checks, profile, silver
from lakeline.functions.exprs import safe_ratio


def test_null_fails_quality_rule(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (None, 1.0, 1.0), (-1.0, 1.0, 1.0)],
                               "trip_distance double, total_amount double, trip_duration_min double")
    assert silver.apply_rules(df, silver.trip_rules()).count() == 1
    row = silver.quality_rejects(df, silver.trip_rules()).first()
    assert (row["rows_in"], row["rows_kept"], row["rows_rejected"], row["fail_trip_distance"]) == (3, 1, 2, 2)


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("0.00"))], "a decimal(14,2), b decimal(14,2)")
    assert df.select(safe_ratio("a", "b").alias("r")).first()["r"] is None


def test_left_join_keeps_unmatched_and_text_sentinels(spark):
    trips = spark.createDataFrame([(1, 264), (2, 999)], "PULocationID long, DOLocationID long")
    zones = spark.createDataFrame([(264, "Unknown", "N/A", "N/A")], "LocationID long, Borough string, Zone string, service_zone string")
    out = silver.enrich_zones(trips, zones).orderBy("PULocationID").collect()
    assert out[0]["DO_zone"] == "N/A" and out[1]["DO_zone"] is None and out[0]["PU_zone"] is None


def test_data_tests_count_failures(spark):
    df = spark.createDataFrame([(1, 0), (None, 9), (3, 1)], "k int, n int")
    dim = spark.createDataFrame([(1,)], "k int")
    out = dict(checks.run_tests(df, [checks.NotNull("k"), checks.AcceptedValues("n", list(range(9))),
                                     checks.Relationship("k", dim, "k"), checks.Unique(["n"])]).collect())
    assert out == {"not_null:k": 1, "accepted_values:n": 1, "relationships:k->k": 1, "unique:n": 0}


def test_duplicates_count_null_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "t string")
    r = profile.duplicate_count(df).first()
    assert (r["rows"], r["distinct_rows"], r["duplicate_rows"]) == (5, 3, 2)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    got = {r["bin"]: r["count"] for r in profile.histogram(df, "x", 2).collect()}
    assert got == {0: 1, 1: 2}


def test_schema_contract_reports_type_and_missing_columns(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "a")], "order_id int, region string")
    want = T.StructType([T.StructField("order_id", T.LongType(), False),
                         T.StructField("region", T.StringType()), T.StructField("total_amount", T.DecimalType(12, 2))])
    assert checks.schema_contract(df, want) == ["type order_id: int != bigint", "missing total_amount"]
    assert checks.schema_contract(df.withColumn("order_id", F.col("order_id").cast("bigint")),
                                  T.StructType(want.fields[:2]), check_nullability=True) == ["nullable order_id"]


def test_ordinal_codes_any_number_of_categories(spark):
    from lakeline.operators import prepare
    df = spark.range(0, 12_000).select(F.format_string("%05d", F.col("id")).alias("c"))
    got = prepare.fit_ordinal(df, "c").transform(df.union(spark.sql("SELECT 'unseen' AS c")), "code")
    assert got.filter("code = try_cast(c AS int)").count() == 12_000 and got.filter("code IS NULL").count() == 1


def test_nan_is_missing_everywhere(spark):
    from lakeline.operators import prepare, profile
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert sorted(r.x for r in prepare.fit_median(df, ["x"]).transform(df).collect()) == [1.0, 2.0, 2.0, 3.0]
    assert prepare.fit_minmax(df, ["x"], 0.0, 1.0).params["x"][:2] == (1.0, 0.5)
    assert prepare.fit_standard(df, ["x"]).params["x"][:2] == (2.0, 1.0)
    row = profile.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (2, 2.0, 1.0, 3.0)
    assert sum(r["count"] for r in profile.histogram(df, "x", 2).collect()) == 2
    assert profile.boxplot_stats(df, ["x"]).first()["outliers"] == 0
    assert sorted(r.zscore for r in prepare.zscore_flags(df, "x").collect() if r.zscore is not None) == [-1.0, 1.0]


def test_duplicates_differ_by_microseconds_and_null_keys_are_unique(spark):
    from lakeline.operators import profile
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.000001' AS t UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:00.000002'")
    assert profile.duplicate_count(df).first()["duplicate_rows"] == 0
    keyed = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    assert checks.run_tests(keyed, [checks.Unique(["k"])]).first()["failures"] == 1


def test_constant_column_has_no_correlation(spark):
    from lakeline.operators import profile
    df = spark.range(5).selectExpr("cast(id AS double) AS a", "1.0D AS b")
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix(df, ["a", "b"]).collect()}
    assert got["a", "a"] == 1.0 and got["b", "b"] is None


def test_capped_load_below_the_table_size(tables):
    from lakeline.sources import files
    keys = [r.o_orderkey for r in files.capped(tables.orders, ["o_orderkey"], 100).collect()]
    assert keys == sorted(r.o_orderkey for r in tables.orders.select("o_orderkey").collect())[:100]


def test_outlier_share_and_inliers(spark):
    from lakeline.operators import forest
    flagged = spark.createDataFrame([(1, True), (2, False), (3, False), (4, False)], "k int, is_outlier boolean")
    assert tuple(forest.outlier_share(flagged).first()) == (4, 1, 0.25) and forest.inliers(flagged).count() == 3
