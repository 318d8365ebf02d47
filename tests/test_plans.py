import pytest
from pyspark.sql import functions as F

from millrace.plans import analyze, clean, model, profile
from millrace.plans.analyze import TargetError, source_columns
from millrace.plans.clean import GateError
from millrace.sources import sinks


@pytest.fixture(scope="module")
def patients(spark):
    """Numbers in natural units, four categories, gaps, repeats, noise."""
    i = F.col("id")
    base = spark.range(400).select(
        i.alias(" Patient ID "),
        (F.lit(30) + i % 50).alias("Age"),
        (F.hash(i) % 500 / 7.0).alias("Cost"),
        F.when(i % 9 == 0, None).otherwise((i * 7 % 23).cast("double")).alias("Risk"),
        F.element_at(F.array(*map(F.lit, ["  Male", "female ", "Other"])), (i % 3 + 1).cast("int")).alias("Gender"),
        F.when(i % 11 > 0, F.element_at(F.array(*map(F.lit, ["UK", "USA", "India"])), (i % 3 + 1).cast("int"))).alias("Country"),
        F.when(i % 10 < 6, None).otherwise("x").alias("Mostly Gone"),
        F.lit(7).alias("Same"),
        F.date_add(F.lit("2020-01-01"), (i % 300).cast("int")).cast("string").alias("Seen"),
        F.when(i % 50 > 19, "late").otherwise("early").alias("Stage"),
    )
    return base.unionByName(base.filter(" ` Patient ID ` % 40 = 0"))


@pytest.fixture(scope="module")
def cleaned(patients):
    return clean(patients, "Stage", keys=[" Patient ID "])


def test_clean_tables(cleaned):
    assert cleaned.readable.columns == [
        "patient_id", "age", "cost", "risk", "gender", "country", "seen", "stage"
    ]
    assert {r[0] for r in cleaned.readable.select("gender").distinct().collect()} == {"male", "female", "other"}
    assert dict(cleaned.readable.dtypes)["seen"] == "timestamp_ntz"
    assert cleaned.metrics["rows_before"] == 410 and cleaned.metrics["rows_after"] == 400
    assert cleaned.metrics["duplicates_after"] == 0 and cleaned.metrics["missing_after"] == 0
    assert cleaned.table.columns[-1] == "stage" and dict(cleaned.table.dtypes)["stage"] == "bigint"
    kinds = {t for c, t in cleaned.table.dtypes if c not in ("patient_id", "stage")}
    assert kinds == {"double", "boolean"}
    age = cleaned.table.agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s")).first()
    assert abs(age["m"]) < 1e-9 and age["s"] == pytest.approx(1.0)


def test_clean_log(cleaned):
    told = {(r["action"], r["column"]): r["n"] for r in cleaned.log().collect()}
    assert told["drop_mostly_missing", "mostly_gone"] > 205
    assert told["fill_missing", "risk"] > 0
    assert ("drop_constant", "same") in told and ("retype", "Seen") in told
    assert told["remove_duplicates_and_rules", None] == 10
    assert {r["metric"]: r["change"] for r in cleaned.delta().collect()}["rows"] == 10
    assert cleaned.metadata().count() == len(cleaned.table.columns)


def test_clean_gate(spark):
    with pytest.raises(GateError, match="missing_share"):
        clean(spark.createDataFrame([(1, None), (None, None)], "a int, b int"))
    with pytest.raises(GateError, match="not_empty"):
        clean(spark.createDataFrame([], "a int"))


@pytest.mark.parametrize("stage, kept", [("raw", 80), ("scaled", 0)])
def test_rule_stages(spark, stage, kept):
    df = spark.range(100).select((F.col("id") % 50).alias("v"), (F.col("id") * 1.0).alias("w"))
    out = clean(df, rules=[{"column": "v", "op": ">=", "value": 10, "action": "drop"}], rules_stage=stage)
    assert out.table.count() == kept
    assert out.violations.first()["violations"] == 100 - kept


def test_flags(spark, patients):
    plain = clean(patients, "Stage", keys=[" Patient ID "], encode=False)
    assert plain.table.columns == plain.readable.columns
    unscaled = clean(patients, "Stage", keys=[" Patient ID "], scale_method=None)
    assert unscaled.table.agg(F.min("age")).first()[0] == 30


def test_profile_with_both_kinds_of_target(cleaned):
    found = profile(cleaned.readable, "stage", top_k=2, corr_threshold=0.0, max_plots=5)
    assert {r["cnt"] for r in found["class_distribution"].collect()} == {160, 240}
    assert "gender" in {r["feature"] for r in found["chi_square"].collect()}
    assert found["top_categories"].groupBy("column").count().agg(F.max("count")).first()[0] == 2
    assert found["correlation_pairs"].count() == 6
    assert found["charts"].agg(F.max("chart_no")).first()[0] == 4
    number = profile(cleaned.readable, "age")
    assert {r["feature"] for r in number["welch"].collect()} == {"stage"}
    assert {r["feature"] for r in number["anova"].collect()} == {"gender", "country"}
    for name, frame in number.items():
        assert frame.columns, name


def test_profile_of_plain_tables(spark):
    words = spark.createDataFrame([("a",), ("b",)], "w string")
    assert "numeric_summary" not in profile(words)
    assert "correlation_matrix" not in profile(spark.range(5))


def test_model_without_keys(spark):
    df = spark.range(600).select(
        (F.col("id") % 20).alias("a"), (F.hash(F.col("id")) % 5).alias("b"), (F.col("id") % 20 * 2.0 + F.rand(3)).alias("y")
    ).withColumn("b", F.abs("b"))
    got = model(df.drop("a").withColumn("a", F.sqrt(F.col("y"))), "y", trees=3, repeats=1)
    assert got.problem_type == "regression" and got.test.count() == 120
    assert got.best_score <= got.baseline_score
    assert {r["section"] for r in got.rows().collect()} == {"score", "metrics", "sanity", "importance"}
    with pytest.raises(ValueError):
        model(df, "y", challenger="other")


def test_source_columns(spark):
    df = spark.createDataFrame([("a", "b", 1)], "city string, city_area string, n int")
    assert source_columns(["city_area_x", "n", "city_paris", "city_rome", "gone"], df) == ["city_area", "n", "city", "gone"]


def test_analyze_writes_everything(spark, patients, tmp_path):
    out = str(tmp_path / "out")
    source = sinks.save_table(patients, str(tmp_path / "in"), "csv")
    got = analyze(spark, source, "csv", target="Stage", keys=["Patient ID"], output=out, trees=3, max_plots=6)
    assert got.problem_type == "classification" and got.target == "stage"
    report = got.report().toPandas()
    assert {"dataset_summary", "problem_framing", "model_training", "evaluation_metrics", "model_strength",
            "sanity_check", "top_features", "data_quality", "evidence"} == set(report["section"])
    runs = sinks.read_runs(spark, f"{out}/runs").collect()
    assert [(r["status"], r["rows_after"]) for r in runs] == [("SUCCESS", 400)]
    assert sinks.read_contract(spark, f"{out}/contract").first()["target_column"] == "stage"
    again = sinks.load_model(f"{out}/model").transform(got.model.test)
    assert again.count() == got.model.test.count()
    assert spark.read.parquet(f"{out}/readable").count() == 400


def test_analyze_defaults_to_the_last_column(spark, patients):
    got = analyze(spark, patients.drop("Seen"), keys=[" Patient ID "], trees=2)
    assert got.target == "stage"


def test_analyze_rejects_a_poor_target_and_logs(spark, tmp_path):
    df = spark.range(60).select("id", (F.col("id") % 7).alias("a"), F.lit(1).alias("b"))
    with pytest.raises((TargetError, ValueError)):
        analyze(spark, df, target="b", keys=["id"], output=str(tmp_path))
    assert sinks.read_runs(spark, f"{tmp_path}/runs").first()["status"] == "FAILED"
