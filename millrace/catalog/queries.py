"""The registered queries: each runs one operator over whole given tables.

Results are rounded where two engines' float sums may differ in the last
digits; the operators themselves return full precision.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.views import table
from millrace.functions.expressions import rounded, union_all
from millrace.functions.types import ref
from millrace.operators import (
    charts, cleaning, contingency, evidence, frequency, hypothesis, modelling, moments,
    neighbours, ordering, profiling, quality, screening, search,
)
from millrace.operators.summary import numeric_summary
from millrace.plans import clean, model, profile
from millrace.plans.analyze import analyze
from millrace.plans.clean import clean_steps
from millrace.sources.sinks import latest_runs, staging_root
from millrace.sources.tables import load_csv, load_parquet, preview

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def query(name: str, source: str, digits: int | dict[str, int] | None = None):
    """Register ``fn(df)`` over one source table under ``name``."""

    def register(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(table(spark, sf_dir, source))
            return out if digits is None else rounded(out, digits)

        QUERIES[name] = run
        return fn

    return register


def _verdict_text(df: DataFrame) -> DataFrame:
    """Verdicts that may be missing, as text."""
    return df.withColumn("significant", F.col("significant").cast("string"))


def _positive_zero(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: ref(c) + F.lit(0.0) for c in columns})


# --- sources, quality ----------------------------------------------------

query("load_preview", "region")(lambda df: preview(df, ["r_regionkey"], 3))


def _csv_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents from CSV files whose texts hold line breaks, commas and quotes."""
    path = f"{staging_root(spark)}/millrace/csv-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    style = {"header": "true", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    docs.write.options(**style).csv(path)
    return load_csv(spark, path)


def _file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's first order in the order of the files."""
    orders = load_parquet(spark, f"{sf_dir}/orders.parquet", position="position")
    return quality.keep_first(orders, ["o_custkey"], ["position"])


def _first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes numbered by the row that shows them first."""
    orders = load_parquet(spark, f"{sf_dir}/orders.parquet", position="position")
    return cleaning.encode_target(orders, "o_orderpriority", position="position").classes


QUERIES |= {"csv_quoted_breaks": _csv_breaks, "keep_first_in_file": _file_order, "first_seen_codes": _first_seen}
query("quality_profile", "dirty_orders")(quality.quality_profile)
query("duplicate_count", "dirty_orders")(quality.duplicate_count)
query("missing_counts", "dirty_orders")(quality.missing_counts)
query("validate_table", "dirty_orders")(lambda df: quality.validate_table(df).select("check", "passed"))
query("dedup_full", "dirty_orders")(
    lambda df: quality.drop_duplicate_rows(df).withColumn("o_custkey", F.col("o_custkey").cast("double"))
)
query("dedup_keep_first", "orders")(
    lambda df: quality.keep_first(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])
)
query("numeric_summary", "lineitem", 4)(
    lambda df: numeric_summary(df).select("column", "mean", "std", "min", "max")
)
query("univariate", "lineitem", 4)(profiling.univariate)
query("univariate_missing", "dirty_orders", 4)(profiling.univariate)
query("top_categories", "part")(
    lambda df: frequency.top_values(df, ["p_name", "p_brand", "p_type"]).select("column", "value", "cnt")
)
query("value_counts", "dirty_orders")(
    lambda df: frequency.top_values(df, ["o_orderstatus", "mostly_missing"], keep_null=True).select(
        "column", "value", "cnt"
    )
)
query("outliers_iqr", "documents", 4)(quality.iqr_outliers)
query("outliers_events", "events", 4)(quality.iqr_outliers)
query("column_roles", "documents")(quality.column_roles)
query("column_roles_orders", "orders")(quality.column_roles)
query("column_roles_labels", "labels")(quality.column_roles)
query("table_metadata", "orders")(quality.table_metadata)
query("quality_delta", "dirty_orders")(lambda df: quality.quality_delta(df, df.dropDuplicates()))
query("insights", "documents", 4)(quality.insights)
query("insights_missing", "dirty_orders", 4)(quality.insights)
query("target_gate", "labels", 6)(lambda df: quality.target_gate(df, "quality"))
query("problem_type", "lineitem")(quality.problem_types)

# --- cleaning ------------------------------------------------------------

query("normalize_columns", "customer")(
    lambda df: cleaning.normalize_names(df.toDF(" Cust Key ", "C-Name!", "Nation\tKey", "AcctBal ($)", "MKT  Segment"))
)
query("apply_schema", "raw_orders")(
    lambda df: cleaning.apply_schema(
        df,
        {
            "o_orderkey": {"dtype": "numeric"}, "o_totalprice": {"dtype": "numeric"},
            "o_orderdate": {"dtype": "datetime"}, "o_orderpriority": {"dtype": "text"},
            "absent": {"dtype": "numeric"},
        },
    )
)
query("detect_types", "raw_orders", 6)(cleaning.detect_types)
query("correct_types", "raw_orders")(cleaning.correct_types)
query("standardize_text", "dirty_customer")(
    lambda df: cleaning.standardize_text(df).select("c_custkey", "c_mktsegment")
)
query("exclude_columns", "orders")(lambda df: cleaning.excluded_columns(df, "o_orderstatus", ["o_orderkey"]))
query("exclude_columns_documents", "documents")(lambda df: cleaning.excluded_columns(df, None, ["doc_id"]))
query("drop_id_named", "labelled_documents")(cleaning.drop_id_named)
query("drop_constant", "dirty_orders")(cleaning.constant_columns)
query("drop_constant_wide", "wide_lineitem")(cleaning.constant_columns)
query("encode_target", "orders")(
    lambda df: cleaning.encode_target(df, "o_orderpriority").table.select(
        "o_orderkey", F.col("o_orderpriority").alias("target")
    )
)
query("encode_target_missing", "dirty_orders")(
    lambda df: cleaning.encode_target(df, "o_orderstatus").table.select(
        "o_orderkey", F.col("o_orderstatus").alias("target")
    )
)
query("one_hot", "orders")(
    lambda df: cleaning.one_hot(df.select("o_orderkey", "o_orderstatus"), ["o_orderstatus"])
)
query("one_hot_missing", "dirty_orders")(
    lambda df: cleaning.one_hot(df.select("o_orderkey", "o_orderstatus"), ["o_orderstatus"])
)
query("scale_standard", "customer", 6)(
    lambda df: cleaning.scale(df, ["c_acctbal"]).select("c_custkey", F.col("c_acctbal").alias("c_acctbal_scaled"))
)
query("scale_minmax", "customer", 6)(
    lambda df: cleaning.scale(df, ["c_acctbal"], "minmax").select(
        "c_custkey", F.col("c_acctbal").alias("c_acctbal_scaled")
    )
)

RULES = [
    {"column": "c_acctbal", "op": ">=", "value": 0.0, "action": "flag"},
    {"column": "c_acctbal", "op": "<", "value": 9000.0, "action": "clip"},
    {"column": "c_acctbal", "op": ">", "value": 500.0, "action": "drop"},
    {"column": "c_acctbal", "op": "<=", "value": 8000.0, "action": "flag"},
    {"column": "c_acctbal", "op": "==", "value": 9000.0, "action": "flag"},
]
query("business_rules_flag", "dirty_customer")(lambda df: cleaning.rule_violations(df, RULES))
query("business_rules_drop", "dirty_customer")(
    lambda df: cleaning.apply_rules(df, [{"column": "c_acctbal", "op": ">=", "value": 0.0, "action": "drop"}])
)
query("business_rules_clip", "dirty_customer")(
    lambda df: cleaning.apply_rules(df, [{"column": "c_acctbal", "op": ">=", "value": 0.0, "action": "clip"}])
)
query("impute_missing", "dirty_orders", {"o_totalprice": 4, "o_custkey": 4})(cleaning.impute_missing)
query("fill_ordered", "sparse_orders")(lambda df: ordering.fill_ordered(df, ["o_custkey", "o_orderstatus"], "o_orderkey"))
query("fill_zero", "dirty_orders")(lambda df: cleaning.fill_zero(df).select("o_orderkey", "o_custkey", "o_totalprice"))

# --- association ---------------------------------------------------------

query("corr_pairs", "wide_lineitem", 6)(moments.correlation_pairs)
query("corr_wide", "gappy_lineitem", 6)(
    lambda df: _positive_zero(rounded(moments.pair_correlation(df, moments.all_pairs(df.columns)), 6), "r")
)
query("corr_matrix", "lineitem", 6)(lambda df: _positive_zero(rounded(moments.correlation_matrix(df), 6), "r"))
query("corr_matrix_missing", "dirty_orders", 6)(
    lambda df: _positive_zero(rounded(moments.correlation_matrix(df), 6), "r")
)
query("target_correlations", "wide_lineitem", 3)(lambda df: profiling.feature_correlations(df, "l_extendedprice"))
query("cat_num_stats", "orders", 4)(profiling.category_number_stats)
query("crosstab", "lineitem")(lambda df: contingency.crosstab(df, "l_returnflag", "l_linestatus"))
query("crosstab_sparse", "documents")(lambda df: contingency.crosstab(df, "lang", "source"))
query("contingency_cells", "part")(
    lambda df: contingency.contingency(df, [("p_brand", "p_type"), ("p_name", "p_brand"), ("p_name", "p_type")])
)
query("cramers_v", "orders", 6)(lambda df: contingency.cramers_v(df, [("o_orderstatus", "o_orderpriority")]))
query("cramers_v_lineitem", "lineitem", 6)(
    lambda df: contingency.cramers_v(
        df, [("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber"), ("l_linestatus", "l_linenumber")]
    )
)
query("cramers_v_documents", "documents", 6)(lambda df: contingency.cramers_v(df, [("lang", "source")]))
query("mutual_info", "lineitem", 6)(
    lambda df: profiling.mutual_information(df, "l_extendedprice", LINE_FEATURES)
)
query("mutual_info_neighbours", "lineitem", 6)(
    lambda df: neighbours.neighbour_information(df, "l_extendedprice", LINE_FEATURES)
)
query("mutual_info_quantile", "lineitem", 6)(
    lambda df: profiling.mutual_information(df, "l_extendedprice", LINE_FEATURES, bins=8, method="quantile")
)
query("target_numeric_profile", "orders", 4)(lambda df: profiling.target_number_profile(df, "o_totalprice"))

# --- tests ---------------------------------------------------------------

query("welch_ttest", "lineitem", 6)(lambda df: hypothesis.welch_tests(df, "l_extendedprice", ["l_linestatus"]))
query("welch_by_target", "wide_lineitem", 6)(
    lambda df: evidence.welch_by_target(df, "target", ["l_quantity", "l_discount", "l_tax"])
)
query("anova", "orders", 6)(lambda df: hypothesis.anova_tests(df, "o_totalprice"))
query("class_balance", "events", 6)(lambda df: evidence.class_balance(df, "event_type"))
query("chi2_independence", "lineitem", 6)(
    lambda df: hypothesis.chi2_tests(
        df.select("l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_orderkey"), "l_returnflag"
    )
)
query("chi2_labels", "labels", 6)(lambda df: hypothesis.chi2_tests(df, "toxic", ["quality"]))
query("leakage_report", "wide_lineitem", 6)(lambda df: hypothesis.leakage_report(df, "l_quantity"))
query("pearson_pvalue", "lineitem", 6)(lambda df: hypothesis.pearson_tests(df, "l_extendedprice", LINE_FEATURES))

# --- evidence ------------------------------------------------------------

query("driver_correlations", "lineitem", 6)(
    lambda df: evidence.driver_correlations(df, "l_returnflag", LINE_FEATURES)
)
query("quartile_means", "lineitem", 4)(lambda df: evidence.quartile_means(df, "l_extendedprice", LINE_FEATURES))
query("driver_quartiles", "lineitem", 4)(lambda df: evidence.driver_quartiles(df, ["l_quantity", "l_extendedprice"]))
query("class_means", "lineitem", 4)(lambda df: evidence.class_means(df, "l_returnflag", LINE_FEATURES))
query("category_rates", "labelled_documents", 6)(lambda df: evidence.category_rates(df, "quality", ["lang", "source"]))
query("category_target_means", "labelled_documents", 4)(
    lambda df: evidence.category_target_means(df, "n_chars", ["lang", "source"])
)
query("financial_impact", "priced_orders", {"target_mean": 6, "avg_value": 4, "impact": 1})(
    lambda df: evidence.financial_impact(df, "finished")
)
query("evidence_table", "lineitem", 4)(
    lambda df: _verdict_text(
        evidence.evidence_table(
            df.withColumn("same", F.lit(1)), "l_extendedprice",
            ["l_quantity", "l_discount", "l_returnflag", "absent", "same"], "regression",
        )
    )
)
query("evidence_classes", "labelled_documents", 4)(
    lambda df: _verdict_text(
        evidence.evidence_table(df, "quality", ["n_chars", "lang", "toxic"], "classification")
    )
)
query("evidence_text", "labelled_documents")(
    lambda df: evidence.formatted_evidence(
        evidence.evidence_table(df, "quality", ["lang", "toxic"], "classification")
    )
)

# --- screening -----------------------------------------------------------

query("id_columns", "orders")(screening.id_columns)
query("low_variance", "wide_lineitem", 4)(
    lambda df: screening.feature_variance(df, ["l_linenumber", "l_quantity", "l_discount", "l_tax", "zero_col"])
)
query("high_corr_drop", "wide_lineitem")(screening.correlated_features)
query("leak_features", "wide_lineitem")(lambda df: screening.leaking_features(df, "l_quantity"))
query("feature_selection", "wide_lineitem")(lambda df: screening.select_features(df, "target").report())
query("feature_selection_mixed", "orders")(
    lambda df: screening.select_features(
        df.withColumn("late", (F.col("o_orderstatus") == "O").cast("int")), "late"
    ).report()
)

# --- models --------------------------------------------------------------

query("train_test_split", "orders")(
    lambda df: modelling.with_split(df, ["o_orderkey"]).groupBy("split").agg(F.count(F.lit(1)).alias("cnt"))
)
query("train_test_rows", "orders")(lambda df: modelling.with_split(df, ["o_orderkey"]).select("o_orderkey", "split"))
query("clf_metrics", "labels", 6)(lambda df: modelling.classification_metrics(df, "quality", "toxic"))
query("clf_metrics_multi", "lineitem", 6)(
    lambda df: modelling.classification_metrics(
        df.withColumn("guess", F.pmod(F.col("l_linenumber") + F.col("l_orderkey"), F.lit(5))), "l_linenumber", "guess"
    )
)
query("reg_metrics", "forecast_lineitem", 4)(lambda df: modelling.regression_metrics(df, "actual", "forecast"))
query("model_strength", "labels")(
    lambda df: evidence.model_strength(modelling.classification_metrics(df, "quality", "toxic"))
)
query("sanity_check", "labels", 6)(
    lambda df: modelling.sanity_check(modelling.classification_metrics(df, "quality", "toxic"), "classification")
)
query("balanced_weights", "orders", 6)(lambda df: modelling.class_weights(df, "o_orderstatus"))


@query("model_select", "labels", 6)
def _model_select(df: DataFrame) -> DataFrame:
    """Always guessing class 1 against guessing by the toxic flag."""
    guesses = {"Baseline Model": F.lit(1), "Flag Model": 1 - F.col("toxic")}
    scores = [
        modelling.classification_metrics(df.withColumn("guess", g), "quality", "guess")
        .filter("metric = 'f1_weighted'")
        .select(F.lit(n).alias("model"), F.col("value").alias("score"), F.lit(n == "Baseline Model").alias("is_baseline"))
        for n, g in guesses.items()
    ]
    return modelling.select_model(union_all(scores), "classification")


def _line_features(df: DataFrame) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_returnflag")


@query("linear_baseline", "lineitem", 3)
def _linear(df: DataFrame) -> DataFrame:
    fitted = modelling.train_baseline(df, ["l_quantity"], "l_extendedprice", "regression")
    line = fitted.model.stages[-1]
    return df.sparkSession.createDataFrame(
        [(float(line.coefficients[0]), float(line.intercept))], "slope double, intercept double"
    )


@query("logistic_baseline", "wide_lineitem")
def _logistic(df: DataFrame) -> DataFrame:
    train, test = modelling.staged_split(df, ["l_orderkey", "l_linenumber", "l_extendedprice"])
    fitted = modelling.train_baseline(train, ["l_quantity", "l_discount", "l_tax"], "target", "classification")
    return modelling.classification_metrics(modelling.score(fitted, test), "target")


def _flat_documents(df: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    flat = cleaning.one_hot(df, ["lang", "source"])
    return flat, [c for c in flat.columns if c not in ("doc_id", label)]


@query("forest_classifier", "labelled_documents")
def _forest_classifier(df: DataFrame) -> DataFrame:
    flat, feats = _flat_documents(df, "quality")
    train, test = modelling.staged_split(flat, ["doc_id"])
    fitted = modelling.train_forest(train, feats, "quality", "classification")
    return modelling.classification_metrics(modelling.score(fitted, test), "quality")


@query("forest_regressor", "labelled_documents")
def _forest_regressor(df: DataFrame) -> DataFrame:
    flat, feats = _flat_documents(df, "n_chars")
    train, test = modelling.staged_split(flat, ["doc_id"])
    fitted = modelling.train_forest(train, feats, "n_chars", "regression")
    return modelling.regression_metrics(modelling.score(fitted, test), "n_chars")


@query("tuned_model", "labelled_documents")
def _tuned(df: DataFrame) -> DataFrame:
    flat, feats = _flat_documents(df, "quality")
    train, test = modelling.staged_split(flat, ["doc_id"])
    fitted = modelling.train_tuned(train, feats, "quality", "classification")
    return modelling.classification_metrics(modelling.score(fitted, test), "quality")


@query("budgeted_search", "labelled_documents")
def _searched(df: DataFrame) -> DataFrame:
    flat, feats = _flat_documents(df, "quality")
    settings = [("forest", 10, 5), ("forest", 30, 8), ("boosted", 5, 3)]
    return search.successive_halving(flat, feats, "quality", "classification", 2 * flat.count(), settings).rounds


@query("score_batch", "lineitem", {"prediction": 2})
def _score(df: DataFrame) -> DataFrame:
    flat = _line_features(df)
    fitted = modelling.train_baseline(flat, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "regression")
    return modelling.score(fitted, flat).select("l_orderkey", "l_linenumber", "prediction")


@query("perm_importance", "lineitem")
def _permuted(df: DataFrame) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    train, test = modelling.staged_split(_line_features(df), keys)
    fitted = modelling.train_baseline(train, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "regression")
    return modelling.ranked_importance(fitted, test, keys)


@query("intrinsic_importance", "labelled_documents")
def _intrinsic(df: DataFrame) -> DataFrame:
    flat, feats = _flat_documents(df, "quality")
    fitted = modelling.train_forest(flat, feats, "quality", "classification")
    return df.sparkSession.createDataFrame(modelling.intrinsic_importance(fitted), "feature string, importance double")


# --- charts --------------------------------------------------------------

query("chart_histogram", "lineitem", {"lower": 4, "upper": 4})(
    lambda df: charts.histograms(df, ["l_quantity", "l_extendedprice"])
)
query("chart_box", "documents", 4)(lambda df: charts.boxes(df, ["n_chars"]))
query("chart_bar", "part")(lambda df: charts.bars(df, ["p_brand", "p_type"]))
query("chart_scatter_grid", "lineitem")(lambda df: charts.scatter_grids(df, [("l_quantity", "l_extendedprice")]))
query("chart_line_day", "events", 4)(lambda df: charts.lines(df, [("ts", "value")]))
query("chart_batch", "orders", 7)(lambda df: charts.chart_batch(df, quality.column_roles(df)))

# --- run log, pipelines --------------------------------------------------

query("run_log_latest", "event_runs")(
    lambda df: latest_runs(df, tie=("event_id",)).select("run_id", "status")
)
query("clean_readable", "dirty_orders", {"o_totalprice": 4, "o_custkey": 4})(clean_steps)
query("clean_pipeline", "dirty_orders")(lambda df: clean(df, "o_orderstatus", keys=["o_orderkey"]).table)
query("clean_log", "dirty_orders")(lambda df: clean(df, "o_orderstatus", keys=["o_orderkey"]).log())


@query("profile_pipeline", "orders", 6)
def _profile(df: DataFrame) -> DataFrame:
    """The profile's numeric results as (section, item, value)."""
    found = profile(df, "o_totalprice")
    parts = [
        found["univariate"].select(
            F.lit("n_unique").alias("section"), F.col("column").alias("item"), F.col("n_unique").cast("double").alias("value")
        ),
        found["correlation_matrix"].select(
            F.lit("pearson").alias("section"), F.concat_ws("__", "col_a", "col_b").alias("item"), F.col("r").alias("value")
        ),
        found["cramers_v"].select(
            F.lit("cramers_v").alias("section"), F.concat_ws("__", "col_a", "col_b").alias("item"), F.col("v").alias("value")
        ),
        found["anova"].select(F.lit("anova").alias("section"), F.col("feature").alias("item"), F.col("p_value").alias("value")),
    ]
    return _positive_zero(union_all(parts), "value")


query("model_pipeline", "wide_lineitem")(
    lambda df: model(
        df, "l_extendedprice", "regression", trees=20,
    ).rows()
)


@query("report_rows", "labelled_documents")
def _report(df: DataFrame) -> DataFrame:
    return analyze(df.sparkSession, df, target="quality", keys=["doc_id"]).report()
