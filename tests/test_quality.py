from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.types import NestedColumnError, nan_to_null
from millrace.operators import frequency, quality
from millrace.operators.summary import column_facts, numeric_summary, presence


def test_profile_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "a int, b string")
    got = {r["column"]: r.asDict() for r in quality.quality_profile(df).collect()}
    assert got["a"]["rows"] == 4 and got["a"]["duplicates"] == 1
    assert (got["a"]["missing"], got["b"]["missing"], got["b"]["missing_total"]) == (1, 3, 4)
    assert quality.duplicate_count(df).first()[0] == 1
    assert quality.drop_duplicate_rows(df).count() == 3


def test_profile_of_empty_table(spark):
    got = quality.quality_profile(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r["rows"], r["duplicates"], r["missing_total"]) for r in got] == [(0, 0, 0)] * 2


def test_profile_is_partition_invariant(spark, rows):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("b"))
    assert rows(quality.quality_profile(df)) == rows(quality.quality_profile(df.repartition(9)))


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double"))
    assert presence(df).first()["missing"] == 2


def test_nested_rejected(spark):
    df = spark.createDataFrame([([1, 2],)], "a array<int>")
    with pytest.raises(NestedColumnError):
        quality.quality_profile(df)


def test_keep_first_and_plan(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 9), (None, 8)], "k string, v int")
    out = quality.keep_first(df, ["k"], ["v"])
    assert rows(out) == [("a", 1), ("b", 2), (None, 8)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize(
    "data, failed",
    [
        ([], {"not_empty"}),
        ([(1, None), (2, None)], {"missing_share"}),
        ([(1, 2), (3, 4)], set()),
    ],
)
def test_validate(spark, data, failed):
    df = spark.createDataFrame(data, "a int, b int")
    assert {r["check"] for r in quality.validate_table(df).collect() if not r["passed"]} == failed


def test_validate_names(spark):
    twice = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "a")
    assert {r["check"] for r in quality.validate_table(twice).collect() if not r["passed"]} == {"unique_names"}
    none = spark.range(3).select()
    assert {r["check"] for r in quality.validate_table(none).collect() if not r["passed"]} == {"not_empty", "has_columns"}


def test_target_gate(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, 5), (1, 4, 6)], "same int, fine int, thin int")

    def failed(target):
        return {r["check"] for r in quality.target_gate(df, target).collect() if not r["passed"]}

    assert failed("fine") == set()
    assert failed("same") == {"target_varies"}
    assert failed("thin") == {"target_null_share"}
    assert failed("absent") == {"target_present"}


@pytest.mark.parametrize(
    "n, distinct, want",
    [
        (100, 9, "classification"), (100, 10, "classification"), (100, 11, "regression"),
        (1000, 30, "classification"), (1000, 31, "regression"), (1000, 11, "classification"),
    ],
)
def test_problem_type(spark, n, distinct, want):
    df = spark.range(n).select((F.col("id") % distinct).alias("y"))
    assert quality.problem_types(df).first()["problem_type"] == want
    assert quality.problem_type(df, "y") == want


def test_problem_type_errors(spark):
    for infer in (quality.problem_types, lambda df: quality.problem_type(df, "y")):
        with pytest.raises(ValueError):
            infer(spark.createDataFrame([], "y int"))
    text = spark.range(50).select(F.col("id").cast("string").alias("y"))
    assert quality.problem_types(text).first()["problem_type"] == "classification"


def test_summary_edges(spark):
    one = numeric_summary(spark.createDataFrame([(5,)], "x int"), skew=True).first()
    assert one["mean"] == 5.0 and one["std"] is None and one["skew"] is None and one["std_pop"] == 0.0
    flat = numeric_summary(spark.createDataFrame([(5.0,)] * 5, "x double"), skew=True).first()
    assert flat["skew"] == 0.0 and flat["std"] == 0.0
    skewed = numeric_summary(spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 10.0)], "x double"), skew=True).first()
    assert skewed["skew"] == pytest.approx(1.7635, abs=1e-3)
    empty = numeric_summary(spark.createDataFrame([(None,)], "x double"), skew=True).first()
    assert empty["mean"] is None and empty["present"] == 0


def test_wide_table_blocks(spark):
    df = spark.range(3).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(130)])
    assert numeric_summary(df).count() == 130
    assert len(column_facts(df, df.columns)) == 130


def test_roles(spark):
    data = [
        (i, i % 2, None, "x" * 31 + str(i % 3), f"c{i % 3}", datetime(2020, 1, 1 + i), bool(i % 2)) for i in range(10)
    ]
    df = spark.createDataFrame(
        data, "k int, flag int, void string, long string, cat string, at timestamp_ntz, truth boolean"
    )
    got = {}
    for r in quality.column_roles(df).collect():
        got.setdefault(r["column"], set()).add(r["role"])
    assert got == {
        "k": {"numeric", "id"}, "flag": {"numeric", "boolean"}, "void": {"boolean"}, "long": {"text"},
        "cat": {"categorical"}, "at": {"datetime", "id"}, "truth": {"boolean"},
    }


def test_outliers(spark):
    df = spark.createDataFrame([(float(v), 1) for v in [1, 2, 3, 4, 5, 100]] + [(None, 1)], "x double, c int")
    got = quality.iqr_outliers(df).collect()
    assert [(r["column"], r["cnt"]) for r in got] == [("x", 1)]
    assert got[0]["pct"] == pytest.approx(100 / 7)


def test_insights(spark, rows):
    assert rows(quality.insights(spark.range(9).toDF("x")), "insight") == [("no_anomalies",)]
    df = spark.createDataFrame([(1.0, None), (1.0, "a"), (1.0, "a"), (50.0, "a")], "x double, s string")
    assert rows(quality.insights(df), "column", "insight") == [("*", "missing_values"), ("x", "highly_skewed")]


def test_delta(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    got = {r["metric"]: (r["before"], r["after"], r["change"]) for r in quality.quality_delta(df, df.dropDuplicates()).collect()}
    assert got == {"rows": (3, 2, 1), "duplicates": (1, 0, 1), "missing": (2, 1, 1)}


def test_top_values_ties_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "s string")
    top = frequency.top_values(df, ["s"], 2).orderBy("rank").collect()
    assert [(r["value"], r["cnt"]) for r in top] == [("a", 2), ("b", 2)]
    kept = frequency.top_values(df, ["s"], 1, keep_null=True).first()
    assert kept["value"] is None and kept["cnt"] == 3
    assert "WindowGroupLimit" in frequency.top_values(df, ["s"], 2)._jdf.queryExecution().sparkPlan().toString()


def test_distinct_counts_all_types(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a", True, datetime(2020, 1, 1)), (1, 2.0, None, True, None), (2, 2.0, "a", None, None)],
        "i int, d double, s string, b boolean, t timestamp_ntz",
    )
    assert frequency.distinct_map(df, df.columns) == {"i": 2, "d": 2, "s": 1, "b": 1, "t": 1}
    assert frequency.distinct_map(df.limit(0), ["i"]) == {"i": 0}


def test_columns_named_like_working_ones(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "copies int, rank int")
    assert quality.duplicate_count(df).first()["duplicates"] == 1
    assert {r["column"]: r["missing"] for r in quality.quality_profile(df).collect()} == {"copies": 1, "rank": 0}
    kept = quality.keep_first(df, ["rank"], [F.desc_nulls_last("copies")])
    assert kept.columns == ["copies", "rank"] and [tuple(r) for r in kept.collect()] == [(1, 2)]
