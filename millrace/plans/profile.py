"""The full profile of a table, with or without a target."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.functions import types as ty
from millrace.operators import charts, contingency, frequency, hypothesis, moments, profiling, quality
from millrace.operators.summary import numeric_summary


def profile(
    df: DataFrame, target: str | None = None, top_k: int = 20, corr_threshold: float = 0.3,
    max_plots: int = 30,
) -> dict[str, DataFrame]:
    """Named tidy tables; the flags hold for every one of them.

    A table too plain for an operator (no numbers, one category) leaves that
    entry out.
    """
    ty.require_flat(df)
    nums, texts = ty.number_columns(df), ty.text_columns(df)
    roles = quality.column_roles(df)
    categorical = [r["column"] for r in roles.filter("role = 'categorical'").collect()]
    out = {
        "roles": roles,
        "metadata": quality.table_metadata(df),
        "univariate": profiling.univariate(df),
        "insights": quality.insights(df),
    }
    if nums:
        out["numeric_summary"] = numeric_summary(df)
    plain = [c for c in df.columns if c not in nums]
    if plain:
        out["top_categories"] = frequency.top_values(df, plain, top_k)
    if categorical:
        out["value_counts"] = frequency.top_values(df, categorical, top_k, keep_null=True)
    if len(nums) > 1:
        out["correlation_pairs"] = moments.correlation_pairs(df, nums, corr_threshold)
        out["correlation_matrix"] = moments.correlation_matrix(df, nums)
        out["mutual_information"] = profiling.mutual_information(df)
    if texts and nums:
        out["category_number"] = profiling.category_number_stats(df, texts, nums, top_k)
    if len(texts) > 1:
        pairs = moments.all_pairs(texts)
        out["contingency"] = contingency.contingency(df, pairs)
        out["cramers_v"] = contingency.cramers_v(df, pairs)
    if target is not None:
        out.update(supervised(df, target))
    if any(r["role"] in ("numeric", "categorical") for r in roles.collect()):
        out["charts"] = charts.chart_batch(df, roles, max_plots)
    return out


def supervised(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """Target profile: moments and group tests, or classes and chi-square."""
    ty.require_column(df, target)
    if ty.is_number(ty.dtype_of(df, target)):
        out = {
            "target_profile": profiling.target_number_profile(df, target),
            "target_correlations": profiling.feature_correlations(df, target),
        }
        groups = hypothesis.group_columns(df, target)
        if groups:
            out["welch"] = hypothesis.welch_tests(df, target, groups)
            out["anova"] = hypothesis.anova_tests(df, target, groups)
        return out
    out = {"class_distribution": hypothesis.class_distribution(df, target)}
    few = hypothesis.few_valued(df, [c for c in df.columns if c != target], hypothesis.CHI2_BELOW)
    if few:
        out["chi_square"] = hypothesis.chi2_tests(df, target, few)
    return out
