"""Statistical tests and leakage checks.

Every test is an aggregate over the table followed by arithmetic and one tail
probability on one row per test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, ratio, rows_of, union_all
from millrace.functions.tails import chi2_pvalue, f_pvalue, t_pvalue
from millrace.functions.types import ref
from millrace.operators.contingency import chi_square, contingency, group_moments
from millrace.operators.frequency import fewer_than
from millrace.operators.moments import pair_correlation, target_correlations

# Thresholds that results must agree on.
SIGNIFICANCE = 0.05
GROUPS_BELOW = 10
CHI2_BELOW = 50
LEAK_CORRELATION = 0.95


def few_valued(df: DataFrame, columns: Sequence[str], below: int) -> list[str]:
    """Columns with more than one and fewer than ``below`` distinct values."""
    counts = fewer_than(df, columns, below)
    return [c for c in columns if counts.get(c, 0) > 1]


def group_columns(df: DataFrame, target: str) -> list[str]:
    names = [c for c in ty.text_columns(df) + ty.boolean_columns(df) if c != target]
    return few_valued(df, names, GROUPS_BELOW)


def _with_verdict(df: DataFrame) -> DataFrame:
    return df.withColumn("significant", F.col("p_value") < SIGNIFICANCE)


def welch_from_groups(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Welch's test per ``keys`` from two rows (key, cnt, mean, var) each."""
    side = Window.partitionBy(*keys).orderBy("key")
    sided = groups.withColumn("side", F.row_number().over(side))

    def pick(which: int, col: str):
        return F.max(F.when(F.col("side") == which, F.col(col)))

    two = sided.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("groups"),
        *[pick(s, c).alias(f"{c}{s}") for s in (1, 2) for c in ("cnt", "mean", "var")],
    ).filter("groups = 2")
    a, b = ratio(F.col("var1"), F.col("cnt1")), ratio(F.col("var2"), F.col("cnt2"))
    dof = ratio((a + b) * (a + b), ratio(a * a, F.col("cnt1") - 1) + ratio(b * b, F.col("cnt2") - 1))
    t = ratio(F.col("mean1") - F.col("mean2"), F.sqrt(a + b))
    scored = two.select(*keys, t.alias("t"), dof.alias("dof"))
    return _with_verdict(scored.withColumn("p_value", t_pvalue(F.col("t"), F.col("dof"))))


def welch_tests(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, t, dof, p_value, significant) for two-valued columns."""
    names = list(columns) if columns is not None else group_columns(df, target)
    groups = group_moments(df, names, [target]).withColumnRenamed("cat", "feature")
    return welch_from_groups(groups, ["feature"])


def anova_tests(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, f, df1, df2, p_value, significant) for three to nine groups."""
    names = list(columns) if columns is not None else group_columns(df, target)
    groups = group_moments(df, names, [target]).filter("cnt > 0")
    n, mean, var = F.col("cnt").cast("double"), F.col("mean"), F.coalesce("var", F.lit(0.0))
    whole = Window.partitionBy("cat")
    centred = groups.withColumn("grand", F.sum(n * mean).over(whole) / F.sum(n).over(whole))
    sums = centred.groupBy(F.col("cat").alias("feature")).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("cnt").alias("n"),
        F.sum(n * (mean - F.col("grand")) * (mean - F.col("grand"))).alias("between"),
        F.sum(var * (n - 1)).alias("within"),
    ).filter(f"groups > 2 and groups < {GROUPS_BELOW}")
    df1, df2 = F.col("groups") - 1, F.col("n") - F.col("groups")
    scored = sums.select(
        "feature",
        ratio(ratio(F.col("between"), df1), ratio(F.col("within"), df2)).alias("f"),
        df1.alias("df1"), df2.alias("df2"),
    )
    return _with_verdict(scored.withColumn("p_value", f_pvalue(F.col("f"), F.col("df1"), F.col("df2"))))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """(class, cnt, share, imbalance): shares and max/min class ratio."""
    ty.require_column(df, target)
    counts = (
        df.filter(ref(target).isNotNull())
        .groupBy(ref(target).cast("string").alias("class"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    total = counts.agg(F.sum("cnt")).scalar()
    spread = counts.agg(ratio(F.max("cnt"), F.min("cnt"))).scalar()
    return counts.select(
        "class", "cnt", ratio(F.col("cnt"), total).alias("share"), spread.alias("imbalance")
    )


def chi2_tests(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, chi2, dof, p_value, significant) against the target, for
    columns with two to 49 values."""
    names = (
        list(columns) if columns is not None
        else few_valued(df, [c for c in df.columns if c != target], CHI2_BELOW)
    )
    stats = chi_square(contingency(df, [(c, target) for c in names]))
    scored = stats.select(F.col("col_a").alias("feature"), "chi2", "dof")
    return _with_verdict(scored.withColumn("p_value", chi2_pvalue(F.col("chi2"), F.col("dof"))))


def pearson_tests(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(feature, r, n, p_value, direction, significant) over complete pairs."""
    base = pair_correlation(df, [(c, target) for c in columns])
    r, n = F.col("r"), F.col("n")
    # r = +-1 leaves no residual; an infinite t has tail probability 0.
    t = F.when(r * r >= 1.0, F.lit(float("inf"))).otherwise(r * F.sqrt(ratio(n - 2, 1.0 - r * r)))
    scored = base.select(
        F.col("col_a").alias("feature"), "r", "n",
        F.when(r > 0, "POSITIVE").otherwise("NEGATIVE").alias("direction"),
        F.when(n > 2, t).alias("t"), (n - 2).alias("dof"),
    )
    p = F.when(n == 2, 1.0).otherwise(t_pvalue(F.col("t"), F.col("dof")))
    return _with_verdict(scored.withColumn("p_value", p)).select(
        "feature", "r", "n", "p_value", "direction", "significant"
    )


def identical_columns(df: DataFrame, target: str) -> DataFrame:
    """(column): columns of the target's type that equal it in every row."""
    kind = ty.dtype_of(df, target)
    names = [c for c in df.columns if c != target and ty.dtype_of(df, c) == kind]
    if not names:
        return df.sparkSession.createDataFrame([], "column string")
    frames = []
    for block in chunks(names, 100):
        wide = df.agg(*[F.bool_and(ref(c).eqNullSafe(ref(target))).alias(f"e{i}") for i, c in enumerate(block)])
        frames.append(
            wide.select(
                rows_of([F.struct(F.lit(c).alias("column"), F.col(f"e{i}").alias("same")) for i, c in enumerate(block)])
            )
        )
    return union_all(frames).filter("same").select("column")


def leakage_report(df: DataFrame, target: str | None = None) -> DataFrame:
    """(column, issue, value): identical, high_correlation, future_timestamp."""
    found = []
    none = F.lit(None).cast("double")
    if target is not None and target in df.columns:
        found.append(
            identical_columns(df, target).select("column", F.lit("identical").alias("issue"), none.alias("value"))
        )
        nums = [c for c in ty.number_columns(df) if c != target]
        if ty.is_number_like(ty.dtype_of(df, target)) and nums:
            found.append(
                target_correlations(df, target, nums)
                .filter(F.abs("r") >= LEAK_CORRELATION)
                .select("column", F.lit("high_correlation").alias("issue"), F.col("r").alias("value"))
            )
    times = ty.time_columns(df)
    if times:
        now = F.current_timestamp().cast("timestamp_ntz")
        wide = df.agg(*[(F.max(ref(c)).cast("timestamp_ntz") > now).alias(f"f{i}") for i, c in enumerate(times)])
        found.append(
            wide.select(
                rows_of([F.struct(F.lit(c).alias("column"), F.col(f"f{i}").alias("late")) for i, c in enumerate(times)])
            )
            .filter("late")
            .select("column", F.lit("future_timestamp").alias("issue"), none.alias("value"))
        )
    if not found:
        return df.sparkSession.createDataFrame([], "column string, issue string, value double")
    return union_all(found)
