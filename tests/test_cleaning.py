from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning as cl


def test_names():
    assert cl.clean_name("  Order  ID ") == "order_id"
    assert cl.clean_name("Price ($)") == "price_"


def test_name_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["` Order  ID `", "Order ID"]).toDF(" Order  ID ", "Order ID")
    with pytest.raises(ValueError, match="order_id"):
        cl.normalize_names(df)


def test_schema_keeps_null_and_skips_absent(spark):
    df = spark.createDataFrame([("1", "2020-01-02", 7), ("x", "bad", None)], "a string, b string, c int")
    out = cl.apply_schema(
        df, {"a": {"dtype": "numeric"}, "b": {"dtype": "datetime"}, "c": {"dtype": "text"}, "z": {"dtype": "text"}}
    )
    assert out.dtypes == [("a", "double"), ("b", "timestamp_ntz"), ("c", "string")]
    assert [tuple(r) for r in out.collect()] == [(1.0, datetime(2020, 1, 2), "7"), (None, None, None)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-02-29", datetime(2024, 2, 29)), ("2023-02-29", None), ("2024", None), ("20240229", None),
        ("2024/03/01 10:11", datetime(2024, 3, 1, 10, 11)), ("03/04/2024", datetime(2024, 3, 4)),
        ("2024-01-02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)), ("tomorrow", None),
    ],
)
def test_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cl.to_time("t")).first()[0] == want


@pytest.mark.parametrize(
    "text, want", [("1.5", 1.5), (" -2e3 ", -2000.0), ("1d", None), ("", None), ("NaN", None), (".5", 0.5), ("1,5", None)]
)
def test_numbers(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cl.to_number("t")).first()[0] == want


def test_detect_boundaries(spark, rows):
    half = [("2020-01-01", "1")] * 5 + [("x", "y")] * 5
    over = [("2020-01-01", "1")] * 9 + [("x", "y")] * 1
    at = cl.detect_types(spark.createDataFrame(half, "d string, n string"))
    assert rows(at, "column", "suggestion") == [("d", "text"), ("n", "text")]
    past = cl.detect_types(spark.createDataFrame(over, "d string, n string"))
    assert rows(past, "column", "suggestion") == [("d", "datetime"), ("n", "numeric")]
    assert cl.correct_types(spark.createDataFrame(over, "d string, n string")).dtypes == [
        ("d", "timestamp_ntz"), ("n", "double")
    ]


def test_text(spark):
    df = spark.createDataFrame([("  A\t\tb \n C ",), (None,)], "t string")
    assert [r[0] for r in cl.standardize_text(df).collect()] == ["a b c", None]


def test_impute_boundary_and_ties(spark):
    data = [(1.0, "a", None, 1), (None, "a", None, 2), (3.0, "b", None, 3), (None, "b", "q", 4), (None, None, "q", 5), (8.0, None, None, 6)]
    out = cl.impute_missing(spark.createDataFrame(data, "x double, m string, gone string, k int"))
    assert out.columns == ["x", "m", "k"]  # x is exactly half empty and stays
    assert [tuple(r) for r in out.orderBy("k").select("x", "m").collect()] == [
        (1.0, "a"), (3.0, "a"), (3.0, "b"), (3.0, "b"), (3.0, "a"), (8.0, "a")
    ]


def test_impute_timestamp_and_boolean(spark):
    data = [(datetime(2020, 1, 1), True), (datetime(2020, 1, 1), True), (None, None), (datetime(2021, 1, 1), False)]
    out = cl.impute_missing(spark.createDataFrame(data, "t timestamp_ntz, b boolean")).collect()
    assert {r["t"] for r in out} == {datetime(2020, 1, 1), datetime(2021, 1, 1)}
    assert [r["b"] for r in out].count(True) == 3


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (None, None, "b")], "c int, n string, v string")
    assert cl.drop_constant(df).columns == ["v"]


def test_encode_target_sorted_and_filled(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "k int, y string")
    out = {r["k"]: r["y"] for r in cl.encode_target(df, "y").table.collect()}
    assert out == {1: 1, 2: 0, 3: 1, 4: 1}


def test_encode_numbers_in_number_order(spark):
    df = spark.createDataFrame([(v,) for v in (10, 9, 2, 10)], "y int")
    assert sorted(r[0] for r in cl.encode_target(df, "y").table.collect()) == [0, 1, 2, 2]
    many = spark.createDataFrame([(float(v),) for v in range(10)], "y double")
    assert cl.encode_target(many, "y").classes is None


@pytest.mark.parametrize("limit", [cl.BROADCAST_CODES, 1])
def test_encode_many_classes(spark, monkeypatch, limit):
    monkeypatch.setattr(cl, "BROADCAST_CODES", limit)
    data = [(i, "hot" if i % 3 == 0 else f"v{i:03d}") for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(data, "k int, y string")
    small = {r["k"]: r["y"] for r in cl.encode_target(df, "y").table.collect()}
    large = {r["k"]: r["y"] for r in cl.encode_target(df, "y", max_literal=5).table.collect()}
    assert small == large and len(large) == 61 and large[60] == large[0]


def test_one_hot_null_is_all_false(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    out = cl.one_hot(df)
    assert out.columns == ["c_y", "c_z"]
    assert [tuple(r) for r in out.collect()] == [(False, False), (True, False), (False, True), (False, False)]


def test_one_hot_vector_has_same_content(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None), (5, "y")], "k int, c string")
    got = {r["k"]: r["c_onehot"].toArray().tolist() for r in cl.one_hot(df, ["c"], max_categories=2).collect()}
    # position 0 is the last category
    assert got == {1: [0, 0], 2: [0, 1], 3: [1, 0], 4: [0, 0], 5: [0, 1]}


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5, 0), (2.0, 5, 1), (3.0, 5, 2)], "x double, c int, t int")
    std = cl.scale(df, target="t").collect()
    assert [r["x"] for r in std] == pytest.approx([-1.224744871, 0.0, 1.224744871])
    assert [r["c"] for r in std] == [0.0, 0.0, 0.0] and [r["t"] for r in std] == [0, 1, 2]
    flat = cl.scale(df, ["x", "c"], "minmax").collect()
    assert [r["x"] for r in flat] == [0.0, 0.5, 1.0] and [r["c"] for r in flat] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        cl.scale(df, ["x"], "other")


def test_scaled_sample_deviation_identity(spark):
    n = 4881
    df = spark.range(n).select((F.col("id") * 1.5).alias("x"))
    got = cl.scale(df, ["x"]).agg(F.stddev_samp("x")).first()[0]
    assert got == pytest.approx((n / (n - 1)) ** 0.5, rel=1e-12)


def test_rules_and_null(spark, rows):
    df = spark.createDataFrame([(1, -1.0), (2, 5.0), (3, None), (4, 12.0)], "k int, x double")
    rules = [
        {"column": "x", "op": ">=", "value": 0, "action": "clip"},
        {"column": "x", "op": "<", "value": 12, "action": "drop"},
        {"column": "x", "op": "==", "value": 5, "action": "flag"},
        {"column": "x", "op": "??", "value": 5},
        {"column": "nope", "op": ">", "value": 1},
    ]
    assert rows(cl.apply_rules(df, rules)) == [(1, 0.0), (2, 5.0), (3, None)]
    counts = [r["violations"] for r in cl.rule_violations(df, rules).collect()]
    assert counts == [1, 1, 2, 0, None]


def test_excluded(spark):
    n = 1000
    base = spark.range(n)
    df = base.select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") < 951, F.col("id")).otherwise(0).alias("int951"),
        F.when(F.col("id") < 950, F.col("id")).otherwise(0).alias("int950"),
        F.col("id").cast("double").alias("wide"),
        F.format_string("%08x", F.col("id")).alias("hex"),
        F.lit("word").alias("plain"),
        F.lit(1).alias("y"),
    )
    got = {r["column"]: r["reason"] for r in cl.excluded_columns(df, "y", ["order_id"]).collect()}
    assert got == {"order_id": "id_name", "int951": "id_share", "hex": "id_values", "y": "target"}


def test_require_encoded(spark):
    df = spark.createDataFrame([("a", 1)], "t string, y int")
    with pytest.raises(ValueError, match="t"):
        cl.require_encoded(df)
    cl.require_encoded(df, "t")


def test_times_to_seconds(spark):
    df = spark.createDataFrame([(datetime(1970, 1, 2),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in cl.times_to_seconds(df).collect()] == [86400.0, None]


def test_codes_by_first_appearance(spark):
    rows = [(i, "cab"[i % 3] if i != 4 else None) for i in range(30)]
    df = spark.createDataFrame(rows, "position long, kind string").repartition(5)
    for most in (100, 1):
        encoded = cl.encode_target(df, "kind", most, position="position")
        assert {r["value"]: r["code"] for r in encoded.classes.collect()} == {"c": 0, "a": 1, "b": 2}
        got = {r["position"]: r["kind"] for r in encoded.table.collect()}
        assert [got[i] for i in range(4)] == [0, 1, 2, 0]


def test_unicode_blanks_are_blanks(spark):
    df = spark.createDataFrame([("A\u00a0\u2003b ",)], "s string")
    assert cl.standardize_text(df).first()["s"] == "a b"
