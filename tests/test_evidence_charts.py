from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import charts, quality
from millrace.operators import evidence as ev
from millrace.operators import screening as sc


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 300
    return pd.DataFrame(
        {"y": rng.integers(0, 2, n), "amount": rng.random(n) * 50, "level": rng.integers(0, 3, n), "kind": rng.choice(list("uv"), n)}
    )


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf)


def test_kinds(df):
    assert ev.driver_kinds(df.withColumn("k", F.lit(1)), ["amount", "level", "kind", "k", "zz"]) == {
        "amount": "numeric", "level": "categorical", "kind": "categorical", "k": "constant", "zz": "not_found"
    }


def test_only_six_drivers(df):
    assert len(ev.driver_kinds(df, [f"d{i}" for i in range(9)])) == 6


def test_quartiles_like_qcut(spark, pdf):
    got = {r["bucket"]: r["mean"] for r in ev.quartile_means(spark.createDataFrame(pdf), "amount", ["level"]).collect()}
    want = pdf.groupby(pd.qcut(pdf.amount, 4, labels=ev.QUARTILE_LABELS), observed=True)["level"].mean()
    assert got == pytest.approx(want.to_dict())


def test_quartiles_with_repeated_edges(df, pdf):
    got = ev.quartile_means(df, "y", ["amount"]).collect()
    assert [(r["bucket"], r["mean"]) for r in got] == [("all", pytest.approx(pdf.amount.mean()))]


def test_rates_sum_to_one(df, pdf):
    got = ev.category_rates(df, "y", ["kind"]).groupBy("category").agg(F.sum("rate").alias("s")).collect()
    assert [r["s"] for r in got] == pytest.approx([1.0, 1.0])


@pytest.mark.parametrize(
    "values, want", [([0, 1], "1"), ([1, 2], "2"), (["no", "yes"], "no"), ([0, 1, 2], None), ([False, True], "true"), ([5], None)]
)
def test_positive_class(spark, values, want):
    assert ev.positive_class(spark.createDataFrame([(v,) for v in values], ["y"]), "y") == want


def test_financial(df, pdf):
    got = ev.financial_impact(df, "y").first()
    assert got["impact"] == pytest.approx(len(pdf) * pdf.y.mean() * pdf.amount.mean())
    text = ev.financial_impact(df, "kind").first()
    assert text["target_mean"] == 0.2
    assert ev.financial_impact(df.drop("amount"), "y").count() == 0


def test_text_target_is_coded_by_class_order(df, pdf):
    got = ev.driver_correlations(df, "kind", ["amount"]).first()["r"]
    assert got == pytest.approx(np.corrcoef(pdf.amount, (pdf.kind == "v").astype(int))[0, 1])


def test_evidence_covers_every_driver(df):
    drivers = ["amount", "kind", "zz"]
    for problem in ("classification", "regression"):
        got = ev.evidence_table(df, "y", drivers, problem)
        assert {r["feature"] for r in got.collect()} == set(drivers)
    text = ev.formatted_evidence(got).filter("feature = 'zz'").first()
    assert (text["observation"], text["significance"]) == ("not_found", "N/A")


def test_strength_defaults_to_weak(spark):
    none = spark.createDataFrame([("accuracy", 0.912)], "metric string, value double")
    got = ev.model_strength(none).first()
    assert (got["value"], got["strength"]) == (0.91, "Weak")
    for auc, label in ((0.9, "Strong"), (0.8, "Good"), (0.7, "Moderate"), (0.5, "Weak")):
        frame = spark.createDataFrame([("roc_auc", auc)], "metric string, value double")
        assert ev.model_strength(frame).first()["strength"] == label


def test_id_share(spark, rows):
    df = spark.range(1000).select(
        F.when(F.col("id") < 950, F.col("id")).otherwise(0).alias("at95"),
        F.when(F.col("id") < 949, F.col("id")).otherwise(0).alias("under"),
        F.col("id").cast("double").alias("decimal"),
    )
    assert rows(sc.id_columns(df), "column") == [("at95",)]


def test_correlated_even_with_a_dropped_one(spark, rows):
    df = spark.range(50).select(
        F.col("id").alias("a"), (F.col("id") * 2).alias("b"), (F.col("id") * 3 + 1).alias("c"), (F.col("id") % 7).alias("d")
    )
    assert rows(sc.correlated_features(df)) == [("b",), ("c",)]


def test_missing_values_count_alike_at_every_width(spark, rows):
    gap = lambda c: F.when(F.col("id") % 3 != 0, c)
    few = [gap(F.col("id")).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") * 2).alias("b")]
    noise = [(F.hash(F.col("id"), F.lit(i)) % 97).cast("double").alias(f"x{i}") for i in range(45)]
    assert rows(sc.correlated_features(spark.range(400).select(*few))) == [("b",)]
    assert rows(sc.correlated_features(spark.range(400).select(*few, *noise))) == [("b",)]


def test_selection_reasons(spark):
    df = spark.range(200).select(
        F.col("id").alias("row_id"), (F.col("id") % 11).alias("n"), (F.col("id") % 11 * 2).alias("n2"),
        F.lit(4).alias("flat"), F.when(F.col("id") % 2 == 0, "e").otherwise("o").alias("side"),
        (F.col("id") % 2).alias("y"),
    )
    got = sc.select_features(df, "y")
    assert got.features == ["n"]
    assert got.dropped == {"row_id": "id", "flat": "low_variance", "n2": "high_correlation", "side_o": "leakage"}
    assert got.table.columns == ["n", "y"]
    with pytest.raises(ValueError):
        sc.select_features(df, "absent")


def test_histogram_holds_every_row(df, pdf):
    got = charts.histograms(df, ["amount", "level"], bins=7).groupBy("column").agg(F.sum("cnt").alias("n")).collect()
    assert {r["column"]: r["n"] for r in got} == {"amount": 300, "level": 300}
    flat = charts.histograms(df.select(F.lit(2).alias("k")), ["k"]).collect()
    assert [(r["bin"], r["cnt"]) for r in flat] == [(0, 300)]


def test_box(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]] + [(None,)], "x double")
    got = charts.boxes(df, ["x"]).first()
    assert (got["low_whisker"], got["high_whisker"], got["outliers"]) == (1.0, 5.0, 1)


def test_scatter_and_lines(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, datetime(2020, 1, 1, 3)), (2.0, 4.0, datetime(2020, 1, 1, 9)), (None, 1.0, datetime(2020, 1, 2))],
        "a double, b double, t timestamp_ntz",
    )
    assert charts.scatter_grids(df, [("a", "b")]).agg(F.sum("cnt")).first()[0] == 2
    got = charts.lines(df, [("t", "a"), ("t", "b")]).filter("y = 'a'").orderBy("at").collect()
    assert [(r["at"], r["mean"], r["cnt"]) for r in got] == [(datetime(2020, 1, 1), 1.5, 2), (datetime(2020, 1, 2), None, 0)]


def test_chart_cap_and_order(df):
    roles = quality.column_roles(df)
    specs = charts.chart_specs(roles, 4)
    assert len(specs) == 4 and [s[1] for s in specs] == ["histogram", "box", "histogram", "box"]
    batch = charts.chart_batch(df, roles, 12)
    assert {r["kind"] for r in batch.select("kind").distinct().collect()} == {"histogram", "box", "bar", "scatter"}
    assert batch.filter("chart_no is null").count() == 0
