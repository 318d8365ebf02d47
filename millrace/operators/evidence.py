"""Evidence about the drivers of a target, for reports.

Everything is computed on values in their natural units, before encoding and
scaling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import ratio, rows_of, union_all
from millrace.functions.types import as_number, ref
from millrace.operators.contingency import contingency, group_moments
from millrace.operators.frequency import fewer_than
from millrace.operators.hypothesis import (
    chi2_tests, class_distribution, pearson_tests, welch_tests,
)
from millrace.operators.moments import pair_correlation
from millrace.operators.profiling import edge_index
from millrace.operators.quantiles import column_quantiles

# Limits and names that results must agree on.
MAX_DRIVERS = 6
NUMERIC_ABOVE = 5
BALANCED = (0.45, 0.55)
MODERATE = (0.20, 0.45)
STRONG_AUC, GOOD_AUC, WEAK_AUC, DEFAULT_AUC = 0.85, 0.75, 0.60, 0.5
VALUE_COLUMNS = ("MonthlyCharges", "Amount", "Fare", "Price", "Cost", "Value", "Revenue")
NON_NUMERIC_TARGET_MEAN = 0.2
QUARTILE_LABELS = ("Q1 (Low)", "Q2", "Q3", "Q4 (High)")


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """(class, cnt, share, imbalance, label): label by the smallest share."""
    shares = class_distribution(df, target)
    low = shares.agg(F.min("share")).scalar()
    label = (
        F.when(low.between(*BALANCED), "Balanced")
        .when((low >= MODERATE[0]) & (low < MODERATE[1]), "Moderately Imbalanced")
        .otherwise("Highly Imbalanced")
    )
    return shares.withColumn("label", label)


def driver_kinds(df: DataFrame, drivers: Sequence[str]) -> dict[str, str]:
    """numeric (over five distinct values), categorical, constant or not_found."""
    drivers = list(drivers)[:MAX_DRIVERS]
    here = [d for d in drivers if d in df.columns]
    few = fewer_than(df, here, NUMERIC_ABOVE + 1) if here else {}
    kinds = {}
    for d in drivers:
        if d not in here:
            kinds[d] = "not_found"
        elif few.get(d, NUMERIC_ABOVE) <= 1:
            kinds[d] = "constant"
        elif ty.is_number_like(ty.dtype_of(df, d)) and d not in few:
            kinds[d] = "numeric"
        else:
            kinds[d] = "categorical"
    return kinds


def with_target_codes(df: DataFrame, target: str) -> DataFrame:
    """A numeric view of the target: itself, or sorted class codes from 0."""
    from millrace.operators.cleaning import encode_target

    if ty.is_number_like(ty.dtype_of(df, target)):
        return df.withColumn("__y", as_number(df, target))
    coded = encode_target(df.withColumn("__y", ref(target)), "__y").table
    # A missing target has no code of its own here.
    return coded.withColumn("__y", F.when(ref(target).isNotNull(), F.col("__y").cast("double")))


def driver_correlations(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """(feature, r, direction) with the target or its class codes."""
    coded = with_target_codes(df, target)
    r = F.coalesce(F.col("r"), F.lit(0.0))
    return pair_correlation(coded, [(d, "__y") for d in drivers]).select(
        F.col("col_a").alias("feature"), r.alias("r"),
        F.when(r > 0, "POSITIVE").otherwise("NEGATIVE").alias("direction"),
    )


def welch_by_target(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """(feature, t, dof, p_value, significant): drivers between two classes."""
    parts = [
        welch_tests(df, d, [target]).withColumn("feature", F.lit(d)) for d in drivers
    ]
    return union_all(parts)


def quartile_means(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """(feature, bucket, mean) by target quartile.

    Quartile edges are interpolated and right-closed.  With repeated edges
    there are no four buckets, and one overall mean is given.
    """
    cuts = column_quantiles(df, [target], [0.0, 0.25, 0.5, 0.75, 1.0])[target]
    y = as_number(df, target)
    if None in cuts or len(set(cuts)) < len(cuts):
        bucket = F.lit("all")
        base = df
    else:
        names = F.array(*[F.lit(q) for q in QUARTILE_LABELS])
        bucket = F.element_at(names, (edge_index(y, cuts[1:4]) + 1).cast("int"))
        base = df.filter(ref(target).isNotNull())
    return _means_by(base, bucket.alias("bucket"), "bucket", drivers)


def _means_by(df: DataFrame, key: Column, name: str, drivers: Sequence[str]) -> DataFrame:
    wide = df.groupBy(key).agg(
        *[
            F.struct(F.lit(d).alias("feature"), F.avg(as_number(df, d)).alias("mean")).alias(f"d{i}")
            for i, d in enumerate(drivers)
        ]
    )
    rows = wide.select(name, rows_of([F.col(f"d{i}") for i in range(len(drivers))]))
    return rows.select("feature", name, "mean")


def class_means(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """(feature, class, mean): all drivers in one aggregate."""
    base = df.filter(ref(target).isNotNull())
    return _means_by(base, ref(target).cast("string").alias("class"), "class", drivers)


def driver_quartiles(df: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """(feature, q1, q3)."""
    rows = [(d, q1, q3) for d, (q1, q3) in column_quantiles(df, drivers, [0.25, 0.75]).items()]
    return df.sparkSession.createDataFrame(rows, "feature string, q1 double, q3 double")


def category_rates(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """(feature, category, class, rate): class shares within each category.

    Classes that do not occur in a category have no row (rate 0).
    """
    cells = contingency(df, [(d, target) for d in drivers])
    within = Window.partitionBy("col_a", "v1")
    return cells.select(
        F.col("col_a").alias("feature"), F.col("v1").alias("category"), F.col("v2").alias("class"),
        ratio(F.col("cnt"), F.sum("cnt").over(within)).alias("rate"),
    )


def positive_class(df: DataFrame, target: str) -> str | None:
    """The class to report for a two-class target: the second in order if a
    class 1 exists, else the first."""
    got = df.select(ref(target)).filter(ref(target).isNotNull()).distinct().limit(3).collect()
    if len(got) != 2:
        return None
    first, second = sorted(r[0] for r in got)
    chosen = second if 1 in (first, second) else first
    return str(chosen).lower() if isinstance(chosen, bool) else str(chosen)


def category_target_means(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """(feature, category, mean, cnt) of a numeric target per category."""
    return group_moments(df, drivers, [target]).select(
        F.col("cat").alias("feature"), F.col("key").alias("category"), "mean", "cnt"
    )


def financial_impact(df: DataFrame, target: str) -> DataFrame:
    """(value_column, n, target_mean, avg_value, impact): n x mean target x mean value.

    The value column is the first known name the table has, in any case; with
    none there is no row.
    """
    low = {c.lower(): c for c in reversed(df.columns)}
    found = next((low[v.lower()] for v in VALUE_COLUMNS if v.lower() in low), None)
    if found is None:
        return df.sparkSession.createDataFrame(
            [], "value_column string, n bigint, target_mean double, avg_value double, impact double"
        )
    if ty.is_number_like(ty.dtype_of(df, target)):
        mean = F.avg(as_number(df, target))
    else:
        mean = F.lit(NON_NUMERIC_TARGET_MEAN)
    wide = df.agg(
        F.count(F.lit(1)).alias("n"), mean.alias("target_mean"), F.avg(as_number(df, found)).alias("avg_value")
    )
    return wide.select(
        F.lit(found).alias("value_column"), "n", "target_mean", "avg_value",
        (F.col("n") * F.col("target_mean") * F.col("avg_value")).alias("impact"),
    )


_EVIDENCE = "feature string, kind string, statistic string, value double, p_value double, significant boolean"


def evidence_table(
    df: DataFrame, target: str, drivers: Sequence[str], problem_type: str
) -> DataFrame:
    """(feature, kind, statistic, value, p_value, significant) per driver.

    Numeric drivers: correlation, tested by Welch (two classes) or Pearson
    (regression).  Categorical drivers: chi-square (classification) or the
    spread of target means (regression).
    """
    kinds = driver_kinds(df, drivers)
    spark = df.sparkSession
    nums = [d for d, k in kinds.items() if k == "numeric"]
    cats = [d for d, k in kinds.items() if k == "categorical"]
    none = F.lit(None).cast("double")
    unknown = F.lit(None).cast("boolean")
    parts = []

    def add(frame: DataFrame, kind: str, stat: str, value: Column, p: Column, sig: Column) -> None:
        parts.append(
            frame.select(
                "feature", F.lit(kind).alias("kind"), F.lit(stat).alias("statistic"),
                value.cast("double").alias("value"), p.alias("p_value"), sig.alias("significant"),
            )
        )

    def labelled(frame: DataFrame, kind: str, prefix: str, by: str, value: str) -> None:
        """One untested row per group, the group named in the statistic."""
        parts.append(
            frame.select(
                "feature", F.lit(kind).alias("kind"),
                F.concat(F.lit(prefix), F.col(by), F.lit("]")).alias("statistic"),
                F.col(value).alias("value"), none.alias("p_value"), unknown.alias("significant"),
            )
        )

    if nums:
        if problem_type == "regression":
            tests = pearson_tests(df, target, nums)
            add(tests, "numeric", "pearson_r", F.col("r"), F.col("p_value"), F.col("significant"))
            labelled(quartile_means(df, target, nums), "numeric", "mean[", "bucket", "mean")
        else:
            r = driver_correlations(df, target, nums)
            add(r, "numeric", "correlation", F.col("r"), none, unknown)
            if fewer_than(df, [target], 3).get(target) == 2:
                w = welch_by_target(df, target, nums)
                add(w, "numeric", "welch_t", F.col("t"), F.col("p_value"), F.col("significant"))
            labelled(class_means(df, target, nums), "numeric", "mean[", "class", "mean")
    if cats:
        if problem_type == "regression":
            labelled(category_target_means(df, target, cats), "categorical", "target_mean[", "category", "mean")
        else:
            c = chi2_tests(df, target, cats)
            add(c, "categorical", "chi2", F.col("chi2"), F.col("p_value"), F.col("significant"))
            positive = positive_class(df, target)
            if positive is not None:
                rates = category_rates(df, target, cats).filter(F.col("class") == positive)
                labelled(rates, "categorical", f"rate[{positive}|", "category", "rate")
    odd = [(d, k, k, None, None, None) for d, k in kinds.items() if k in ("constant", "not_found")]
    if odd or not parts:
        parts.append(spark.createDataFrame(odd, _EVIDENCE))
    return union_all(parts)


def formatted_evidence(evidence: DataFrame) -> DataFrame:
    """(feature, observation, significance) as report text."""
    p = F.col("p_value")
    text = F.when(p < 0.001, "p < 0.001").otherwise(F.format_string("p=%.4f", p))
    verdict = F.when(F.col("significant"), "SIGNIFICANT").otherwise("NOT SIGNIFICANT")
    observation = F.when(F.col("value").isNull(), F.col("statistic")).otherwise(
        F.concat("statistic", F.lit(": "), F.format_string("%.2f", F.col("value")))
    )
    return evidence.select(
        "feature", observation.alias("observation"),
        F.when(p.isNull(), "N/A").otherwise(F.concat(verdict, F.lit(" ("), text, F.lit(")"))).alias("significance"),
    )


def model_strength(metrics: DataFrame) -> DataFrame:
    """(metric, value, strength): values to two digits, and a label by ROC AUC."""
    auc = F.coalesce(metrics.agg(F.max(F.when(F.col("metric") == "roc_auc", F.col("value")))).scalar(), F.lit(DEFAULT_AUC))
    label = (
        F.when(auc > STRONG_AUC, "Strong").when(auc > GOOD_AUC, "Good")
        .when(auc < WEAK_AUC, "Weak").otherwise("Moderate")
    )
    return metrics.select("metric", F.round("value", 2).alias("value"), label.alias("strength"))
