import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import modelling as m


@pytest.fixture(scope="module")
def points(spark):
    a, b = F.col("id") % 17, (F.col("id") * 7) % 23
    return spark.range(2000).select(
        "id", a.cast("double").alias("a"), b.cast("double").alias("b"), F.rand(1).alias("noise"),
        (3 * a - b + F.rand(2)).alias("y"), (a > 8).cast("int").alias("c"),
    )


@pytest.mark.parametrize("n", [1, 7, 1000, 1001])
@pytest.mark.parametrize("limit", [1, 10_000])
def test_split_is_exact(spark, n, limit):
    df = spark.range(n)
    cut = m.split_threshold(df, ["id"], 0.2, 42, rank_limit=limit)
    assert df.filter(m._order_key(["id"], 42) <= cut).count() == math.ceil(0.2 * n)


def test_split_is_stable_and_seeded(spark, rows):
    df = spark.range(500)
    first = rows(m.with_split(df, ["id"]))
    assert rows(m.with_split(df.repartition(7), ["id"])) == first
    assert rows(m.with_split(df, ["id"], seed=1)) != first


def test_split_of_nothing(spark):
    assert m.with_split(spark.range(0), ["id"]).count() == 0


def test_quick_split(spark):
    train, test = m.quick_split(spark.range(1000))
    assert train.count() + test.count() == 1000


def test_metrics_by_hand(spark):
    cells = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(1, 1)] * 4
    df = spark.createDataFrame(cells, "y int, prediction double".replace("double", "int"))
    got = {r["metric"]: r["value"] for r in m.classification_metrics(df, "y").collect()}
    assert got["accuracy"] == pytest.approx(9 / 12)
    assert got["recall"] == pytest.approx(got["accuracy"])
    assert got["precision"] == pytest.approx((7 * 5 / 6 + 5 * 4 / 6) / 12)
    assert got["roc_auc"] == pytest.approx((5 / 7 + 4 / 5) / 2)


def test_metrics_unseen_class_and_multiclass(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2)], "y int, prediction int")
    got = {r["metric"]: r["value"] for r in m.classification_metrics(df, "y").collect()}
    assert "roc_auc" not in got and got["accuracy"] == pytest.approx(2 / 3)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 4.0)], "y double, prediction double")
    got = {r["metric"]: r["value"] for r in m.regression_metrics(df, "y").collect()}
    assert got["rmse"] == pytest.approx((1 / 3) ** 0.5)
    assert got["r2"] == pytest.approx(1 - 1 / (14 / 3))


def test_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    want = {"a": 4 / 6, "b": 2.0}
    assert {r["class"]: r["weight"] for r in m.class_weights(df, "y").collect()} == pytest.approx(want)
    for limit in (1000, 1):
        got = m.with_class_weights(df, "y", max_classes=limit)
        assert {r["y"]: r["weight"] for r in got.collect()} == pytest.approx(want)


def test_selection_prefers_the_baseline_on_a_tie(spark):
    def pick(rows, problem):
        df = spark.createDataFrame(rows, "model string, score double, is_baseline boolean")
        return m.select_model(df, problem).first()["model"]

    assert pick([("b", 0.5, True), ("f", 0.5, False)], "classification") == "b"
    assert pick([("b", 0.5, True), ("f", 0.6, False)], "classification") == "f"
    assert pick([("b", 0.5, True), ("f", 0.6, False)], "regression") == "b"


def test_sanity(spark):
    frame = spark.createDataFrame([("accuracy", 0.54), ("r2", -0.1)], "metric string, value double")
    assert not m.sanity_check(frame, "classification").first()["passed"]
    assert not m.sanity_check(frame, "regression").first()["passed"]


def test_donors_are_a_permutation(spark):
    df = spark.range(300).select("id", F.array(F.col("id").cast("double")).alias("x"))
    got = m._donor_rows(df, ["id"], 5, 40).select("id", F.col("donor")[0].alias("d")).collect()
    assert sorted(r["d"] for r in got) == [float(i) for i in range(300)]
    assert sum(r["d"] == r["id"] for r in got) < 10


def test_importance_finds_the_signal(points):
    train, test = m.staged_split(points, ["id"])
    fitted = m.train_baseline(train, ["a", "b", "noise"], "y", "regression")
    ranked = m.ranked_importance(fitted, test, ["id"]).collect()
    assert [r["feature"] for r in ranked][:2] == ["b", "a"] or [r["feature"] for r in ranked][:2] == ["a", "b"]
    assert abs(ranked[-1]["importance"]) < 0.01
    # dropping a feature's signal costs about twice its share of the variance
    assert m.ranked_importance(fitted, test, ["id"], top=1).count() == 1


def test_least_squares_recovers_the_line(points):
    fitted = m.train_baseline(points, ["a", "b"], "y", "regression")
    line = fitted.model.stages[-1]
    assert list(line.coefficients) == pytest.approx([3.0, -1.0], abs=0.02)
    assert dict(m.intrinsic_importance(fitted)) == pytest.approx({"a": 3.0, "b": 1.0}, abs=0.02)


def test_forests_and_tuning(points):
    train, test = m.staged_split(points, ["id"])
    forest = m.train_forest(train, ["a", "noise"], "c", "classification", trees=5)
    got = {r["metric"]: r["value"] for r in m.classification_metrics(m.score(forest, test), "c").collect()}
    assert got["accuracy"] > 0.98
    assert dict(m.intrinsic_importance(forest))["a"] > 0.9
    tuned = m.train_tuned(train, ["a", "b"], "y", "regression")
    fit = {r["metric"]: r["value"] for r in m.regression_metrics(m.score(tuned, test), "y").collect()}
    assert fit["r2"] > 0.9


def test_trees_grow_on_partitions_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(m, "TREE_ROWS", 50, raising=False)
    given = {}
    monkeypatch.setattr(m, "_fit", lambda name, est, train, *rest: given.setdefault("train", train))
    train = spark.range(400).select("id", (F.col("id") % 2).cast("double").alias("y")).coalesce(1)
    for problem in ("regression", "classification"):
        given.clear()
        m.train_forest(train, ["id"], "y", problem, trees=2)
        sizes = [r["count"] for r in given["train"].groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 400 and max(sizes) <= 60, sizes
    monkeypatch.setattr(m, "TREE_ROWS", 400)
    given.clear()
    m.train_forest(train, ["id"], "y", "regression", trees=2)
    assert given["train"].rdd.getNumPartitions() == 1
