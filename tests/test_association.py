import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.types import nan_to_null
from millrace.operators import contingency as ct
from millrace.operators import evidence as ev
from millrace.operators import gram
from millrace.operators import hypothesis as hy
from millrace.operators import moments as mo
from millrace.operators import profiling as pr


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(11)
    n = 400
    x = rng.normal(size=n)
    out = pd.DataFrame({"x": x, "y": 2 * x + rng.normal(size=n), "z": rng.random(n) * 1e6, "one": 3.0})
    out.loc[rng.random(n) < 0.3, "y"] = np.nan
    out["cat"] = rng.choice(list("abc"), n)
    out["two"] = rng.choice(["p", "q"], n)
    return out


@pytest.fixture(scope="module")
def df(spark, pdf):
    return nan_to_null(spark.createDataFrame(pdf)).repartition(3)


def test_matrix_against_pandas(df, pdf):
    want = pdf[["x", "y", "z"]].corr()
    got = {(r["col_a"], r["col_b"]): r["r"] for r in mo.correlation_matrix(df).collect()}
    assert len(got) == 16
    for a in ("x", "y", "z"):
        for b in ("x", "y", "z"):
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-12)
    assert got["one", "x"] is None and got["one", "one"] is None


def test_constant_within_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (1.0, 3.0)], "a double, b double")
    assert mo.pair_correlation(df, [("a", "b")]).first().asDict() == {"col_a": "a", "col_b": "b", "n": 2, "r": None}


def test_boolean_counts_as_number(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 0.0), (True, 1.0)], "a boolean, b double")
    assert mo.pair_correlation(df, [("a", "b")]).first()["r"] == pytest.approx(1.0)


def test_threshold(df, rows):
    assert rows(mo.correlation_pairs(df), "col_a", "col_b") == [("x", "y")]


def test_many_pairs_split_into_passes(spark):
    df = spark.range(20).select(*[(F.col("id") * (i + 1) % 17).alias(f"c{i}") for i in range(20)])
    assert mo.pair_correlation(df, mo.all_pairs(df.columns)).count() == 190


def _two_by_two(spark, cells):
    rows = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b string")


def test_yates(spark):
    df = _two_by_two(spark, {("x", "p"): 10, ("x", "q"): 5, ("y", "p"): 4, ("y", "q"): 11})
    got = ct.chi_square(ct.contingency(df, [("a", "b")])).first()
    assert got["chi2"] == pytest.approx(3.3482, abs=1e-4) and got["dof"] == 1


def test_yates_with_an_empty_cell(spark):
    df = _two_by_two(spark, {("x", "p"): 6, ("y", "p"): 2, ("y", "q"): 4})
    got = ct.chi_square(ct.contingency(df, [("a", "b")])).first()
    # |o - e| = 2 in each cell, less one half
    assert got["chi2"] == pytest.approx(1.5**2 * (1 / 4 + 1 / 2 + 1 / 4 + 1 / 2))


def test_chi_square_degenerate(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("x", None)], "a string, b string")
    got = ct.chi_square(ct.contingency(df, [("a", "b")])).first()
    assert (got["n"], got["chi2"], got["dof"]) == (2, 0.0, 0)
    assert ct.cramers_v(df, [("a", "b")]).first()["v"] == 0.0


def test_chi_square_sparse_grid(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 60).astype(str), "b": rng.integers(0, 7, 60).astype(str)})
    o = pd.crosstab(pdf.a, pdf.b).to_numpy().astype(float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    got = ct.chi_square(ct.contingency(spark.createDataFrame(pdf), [("a", "b")])).first()
    assert got["chi2"] == pytest.approx(((o - e) ** 2 / e).sum())


@pytest.mark.parametrize("bucket", [1, 2, 1000])
def test_crosstab_grid(df, pdf, bucket):
    want = pd.crosstab(pdf["cat"], pdf["two"])
    got = {(r["v1"], r["v2"]): r["cnt"] for r in ct.crosstab(df, "cat", "two", bucket).collect()}
    assert got == {(a, b): int(want.loc[a, b]) for a in want.index for b in want.columns}


def test_group_moments(df, pdf):
    want = pdf.groupby("cat")["y"].agg(["count", "mean", "var"])
    for r in ct.group_moments(df, ["cat"], ["y"]).collect():
        w = want.loc[r["key"]]
        assert (r["cnt"], r["mean"], r["var"]) == (int(w["count"]), pytest.approx(w["mean"]), pytest.approx(w["var"]))


def test_first_keys(df, rows):
    got = pr.category_number_stats(df, ["cat"], ["x"], top_k=2)
    assert rows(got, "key") == [("a",), ("b",)]


def test_welch_by_hand(df, pdf):
    p, q = (pdf.loc[pdf.two == v, "x"] for v in "pq")
    a, b = p.var() / len(p), q.var() / len(q)
    got = hy.welch_tests(df, "x", ["two"]).first()
    assert got["t"] == pytest.approx((p.mean() - q.mean()) / np.sqrt(a + b))
    assert got["dof"] == pytest.approx((a + b) ** 2 / (a**2 / (len(p) - 1) + b**2 / (len(q) - 1)))
    assert 0 <= got["p_value"] <= 1


def test_anova_of_two_groups_would_be_t_squared(df, pdf, rows):
    groups = [g["x"] for _, g in pdf.groupby("cat")]
    grand = pdf["x"].mean()
    ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    got = hy.anova_tests(df, "x").collect()
    assert [r["feature"] for r in got] == ["cat"]
    assert got[0]["f"] == pytest.approx((ssb / 2) / (ssw / (len(pdf) - 3)))


def test_no_group_columns_to_test(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("s"), F.col("id").alias("y"))
    assert hy.group_columns(df, "y") == []


def test_few_valued_boundaries(spark):
    df = spark.range(1000).select(*[(F.col("id") % k).alias(f"m{k}") for k in (1, 2, 9, 10, 300)])
    assert hy.few_valued(df, df.columns, 10) == ["m2", "m9"]


def test_class_distribution_ratio(spark):
    df = spark.range(4881).select(F.when(F.col("id") < 946, "b").otherwise("a").alias("y"))
    got = hy.class_distribution(df, "y").collect()
    assert {r["cnt"] for r in got} == {3935, 946}
    assert got[0]["imbalance"] == pytest.approx(4.159619, abs=1e-6)


@pytest.mark.parametrize("k, label", [(50, "Balanced"), (30, "Moderately Imbalanced"), (10, "Highly Imbalanced")])
def test_balance_labels(spark, k, label):
    df = spark.range(100).select((F.col("id") < k).alias("y"))
    assert {r["label"] for r in ev.class_balance(df, "y").collect()} == {label}


def test_leakage(spark, rows):
    df = spark.createDataFrame(
        [(float(i), float(i), float(-i), float(i * i % 7), i) for i in range(20)],
        "y double, twin double, neg double, noise double, whole int",
    ).withColumn("late", F.lit("2999-01-01").cast("timestamp_ntz"))
    got = rows(hy.leakage_report(df, "y"), "column", "issue")
    assert got == [
        ("late", "future_timestamp"), ("neg", "high_correlation"), ("twin", "high_correlation"),
        ("twin", "identical"), ("whole", "high_correlation"),
    ]
    assert rows(hy.leakage_report(df.drop("late"))) == []


def test_pearson_perfect_line(spark):
    df = spark.range(10).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    got = hy.pearson_tests(df, "y", ["x"]).first()
    assert got["r"] == pytest.approx(1.0) and got["p_value"] < 1e-12 and got["direction"] == "POSITIVE"


def test_mutual_information(spark):
    df = spark.range(4000).select(
        (F.col("id") % 4).alias("y"), (F.col("id") % 4 * 10).alias("same"), (F.floor(F.col("id") / 4) % 2).alias("free"),
    )
    for method in ("width", "quantile"):
        got = {r["feature"]: r["mi"] for r in pr.mutual_information(df, "y", method=method).collect()}
        assert got["free"] == pytest.approx(0.0, abs=1e-9)
    assert {r["feature"]: r["mi"] for r in pr.mutual_information(df, "y").collect()}["same"] == pytest.approx(np.log(4))
    with pytest.raises(ValueError):
        pr.mutual_information(df, "y", method="other")


def test_gram_products_give_the_sums_of_the_plain_pass(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({f"c{i}": rng.normal(1e6 * (i % 3), 1 + i, 300) for i in range(9)})
    pdf["flag"] = rng.random(300) < 0.4
    pdf["same"], pdf["copy"], pdf["none"] = 7.5, pdf["c1"] * 2, np.nan
    values = [tuple(None if (r * 7 + k * 3) % 11 == 0 or v != v else v for k, v in enumerate(row)) for r, row in enumerate(pdf.itertuples(index=False))]
    df = spark.createDataFrame(values, ", ".join(f"{c} {'boolean' if c == 'flag' else 'double'}" for c in pdf.columns))
    pairs = mo.all_pairs(df.columns) + [(c, c) for c in df.columns] + [("c5", "c2")]
    plain = {(r["col_a"], r["col_b"]): (r["n"], r["r"]) for r in mo.pair_correlation(df, pairs).collect()}
    monkeypatch.setattr(mo, "PAIRS_IN_SQL", 0)
    monkeypatch.setattr(gram, "BLOCK_COLUMNS", 5)
    wide = {(r["col_a"], r["col_b"]): (r["n"], r["r"]) for r in mo.pair_correlation(df, pairs).collect()}
    assert wide.keys() == plain.keys()
    for pair, (n, r) in plain.items():
        assert wide[pair][0] == n and wide[pair][1] == (None if r is None else pytest.approx(r, abs=1e-9)), pair


def test_gram_rows_are_made_by_methods_the_jvm_compiles(spark, capsys):
    """Many long column expressions in one generated method run uncompiled beyond 8,000 bytes."""
    made = [F.when((F.col("id") + k) % 7 != 0, F.col("id") * 0.5 + k * F.sqrt(F.col("id") % (k + 2))).alias(f"f{k}") for k in range(60)]
    wide = spark.range(50).select(*made)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        gram.pair_moments(wide, wide.columns).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8_000
