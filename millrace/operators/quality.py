"""Data quality: profile, gates, duplicates, outliers, roles, deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, ratio, rows_of
from millrace.functions.sqltext import aggregate_rows, double_sql, name_sql, number_sql, text_sql
from millrace.functions.types import free_name, ref
from millrace.operators.frequency import distinct_counts, fewer_than
from millrace.operators.quantiles import column_quantiles
from millrace.operators.summary import numeric_summary, presence

# Thresholds that results must agree on.
MISSING_CELLS_LIMIT = 0.30
TARGET_NULL_LIMIT = 0.40
IQR_FACTOR = 1.5
TEXT_MEAN_LENGTH = 30
ROLE_ID_SHARE = 0.90
SKEW_LIMIT = 1.0


def _row_groups(df: DataFrame) -> DataFrame:
    """One row per distinct row with its count, under names of their own; NULLs compare equal."""
    ty.require_flat(df)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("copies"))


def quality_profile(df: DataFrame) -> DataFrame:
    """(column, rows, duplicates, missing, missing_total), one job, one shuffle.

    Duplicates and missing counts are both sums over the distinct rows.
    """
    aggregates = {
        "rows": "coalesce(sum(copies), 0L)",
        "duplicates": "coalesce(sum(copies - 1), 0L)",
        **{
            f"m{i}": f"coalesce(sum(CASE WHEN c{i} IS NULL THEN copies END), 0L)"
            for i in range(len(df.columns))
        },
    }
    total = " + ".join(f"m{i}" for i in range(len(df.columns)))
    records = [
        {
            "column": text_sql(c), "rows": "rows", "duplicates": "duplicates",
            "missing": f"m{i}", "missing_total": total,
        }
        for i, c in enumerate(df.columns)
    ]
    return aggregate_rows(_row_groups(df), [(aggregates, records)])


def duplicate_count(df: DataFrame) -> DataFrame:
    """(duplicates): rows beyond the first of each group of equal rows."""
    return _row_groups(df).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates")
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing)."""
    return presence(df).select("column", "missing")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    ty.require_flat(df)
    return df.dropDuplicates()


def keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each ``subset`` group in the given order.

    Spark limits each group to one row per task before the shuffle, so a
    group holding a third of all rows does not land in one task.
    """
    order = Window.partitionBy(*[ref(c) for c in subset]).orderBy(*order_by)
    rank = free_name(df, "rank")
    return df.withColumn(rank, F.row_number().over(order)).filter(ref(rank) == 1).drop(rank)


def _checks(spark: SparkSession, wide: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    return wide.select(
        rows_of(
            [
                F.struct(
                    F.lit(name).alias("check"), ok.alias("passed"),
                    detail.cast("double").alias("detail"),
                )
                for name, ok, detail in checks
            ]
        )
    )


def validate_table(df: DataFrame) -> DataFrame:
    """(check, passed, detail): the load gate.

    Fails on an empty table, no columns, over 30 % missing cells, or repeated
    column names.
    """
    spark, names = df.sparkSession, df.columns
    repeated = len(names) - len(set(names))
    # Positional names keep the pass valid when two columns share a name.
    plain = df.toDF(*[f"c{i}" for i in range(len(names))]) if names else df
    wide = plain.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(f"c{i}").alias(f"p{i}") for i in range(len(names))],
    )
    cells = F.col("rows") * len(names)
    present = sum((F.col(f"p{i}") for i in range(len(names))), F.lit(0))
    share = F.coalesce(ratio(cells - present, cells), F.lit(0.0))
    return _checks(
        spark,
        wide,
        [
            ("not_empty", (F.col("rows") > 0) & F.lit(bool(names)), F.col("rows")),
            ("has_columns", F.lit(bool(names)), F.lit(len(names))),
            ("missing_share", share <= MISSING_CELLS_LIMIT, share),
            ("unique_names", F.lit(repeated == 0), F.lit(repeated)),
        ],
    )


def target_gate(df: DataFrame, target: str) -> DataFrame:
    """(check, passed, detail): present, varies, at most 40 % missing.

    More than one distinct value is the same as min < max, so the gate needs
    no distinct count.
    """
    if target not in df.columns:
        wide = df.sparkSession.range(1)
        return _checks(df.sparkSession, wide, [("target_present", F.lit(False), F.lit(0))])
    c = ref(target)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(c).alias("present"),
        F.coalesce(F.min(c) < F.max(c), F.lit(False)).alias("varies"),
    )
    null_share = F.coalesce(ratio(F.col("rows") - F.col("present"), F.col("rows")), F.lit(0.0))
    return _checks(
        df.sparkSession,
        wide,
        [
            ("target_present", F.lit(True), F.lit(1)),
            ("target_varies", F.col("varies"), F.col("varies").cast("int")),
            ("target_null_share", null_share <= TARGET_NULL_LIMIT, null_share),
        ],
    )


def problem_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique, problem_type) for each candidate target.

    Numeric targets: under 10 distinct values classify; over 30, or over 10
    making up more than 5 % of the rows, regress; the rest classify.
    """
    names = list(columns) if columns is not None else df.columns
    for c in names:
        ty.require_column(df, c)
    numeric = [c for c in names if ty.is_number(ty.dtype_of(df, c))]
    rows = df.count()
    if rows == 0:
        raise ValueError("cannot infer a problem type from an empty table")
    u = F.col("n_unique")
    many = (u > 30) | ((u > 10) & (u / F.lit(rows) > 0.05))
    kind = F.when(
        F.col("column").isin(numeric) & (u >= 10) & many, "regression"
    ).otherwise("classification")
    return distinct_counts(df, names).select("column", "n_unique", kind.alias("problem_type"))


def problem_type(df: DataFrame, target: str) -> str:
    """The problem type of one target, without counting many distinct values.

    Over 30 values settle it, so only a target of fewer is counted exactly.
    """
    ty.require_column(df, target)
    if df.isEmpty():
        raise ValueError("cannot infer a problem type from an empty table")
    if not ty.is_number(ty.dtype_of(df, target)):
        return "classification"
    u = fewer_than(df, [target], 31).get(target)
    if u is None or (u > 10 and u / df.count() > 0.05):
        return "regression"
    return "classification"


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, cnt, pct, lower_bound, upper_bound) for columns with outliers."""
    names = list(columns) if columns is not None else ty.number_columns(df)
    bounds = {}
    for c, (q1, q3) in column_quantiles(df, names, [0.25, 0.75]).items():
        if q1 is not None:
            reach = IQR_FACTOR * (q3 - q1)
            bounds[c] = (q1 - reach, q3 + reach)
    if not bounds:
        schema = "column string, cnt bigint, pct double, lower_bound double, upper_bound double"
        return df.sparkSession.createDataFrame([], schema)
    blocks = []
    for block in chunks(bounds, 100):
        aggregates, records = {"rows": "count(1)"}, []
        for i, c in enumerate(block):
            x, low, high = number_sql(df, c), *map(double_sql, bounds[c])
            aggregates[f"o{i}"] = f"count_if({x} < {low} OR {x} > {high})"
            records.append(
                {
                    "column": text_sql(c), "cnt": f"o{i}", "pct": f"try_divide(100.0D * o{i}, rows)",
                    "lower_bound": low, "upper_bound": high,
                }
            )
        blocks.append((aggregates, records))
    return aggregate_rows(df, blocks).filter("cnt > 0")


def column_roles(df: DataFrame) -> DataFrame:
    """(column, role), roles overlapping: numeric, datetime, boolean,
    categorical, text, id.

    id: distinct values make up at least 90 % of the rows, any type.
    """
    ty.require_flat(df)
    aggregates, records = {"rows": "count(1)"}, []
    for i, c in enumerate(df.columns):
        kind, x = ty.dtype_of(df, c), name_sql(c)
        zero_one = f"{x} IS NULL"
        if ty.is_number(kind):
            zero_one = f"{x} IS NULL OR {x} IN (0, 1)"
        elif ty.is_boolean(kind):
            zero_one = "true"
        aggregates[f"b{i}"] = f"coalesce(bool_and({zero_one}), true)"
        aggregates[f"l{i}"] = f"avg(length({x}))" if ty.is_text(kind) else "max(cast(NULL AS double))"
        records.append(
            {
                "column": text_sql(c), "rows": "rows", "zero_one": f"b{i}", "mean_length": f"l{i}",
                "is_number": str(ty.is_number(kind)), "is_time": str(ty.is_time(kind)),
                "is_text": str(ty.is_text(kind)),
            }
        )
    facts = aggregate_rows(df, [(aggregates, records)])
    # One row per column on both sides.
    known = facts.join(F.broadcast(distinct_counts(df)), "column", "left")
    wordy = F.col("is_text") & ~F.col("zero_one") & (F.coalesce("mean_length", F.lit(0.0)) > TEXT_MEAN_LENGTH)
    unique = F.coalesce("n_unique", F.lit(0)) >= F.col("rows") * F.lit(ROLE_ID_SHARE)
    plain = F.col("is_text") & ~F.col("zero_one") & ~wordy & ~unique
    roles = {
        "numeric": F.col("is_number"), "categorical": plain, "datetime": F.col("is_time"),
        "boolean": F.col("zero_one"), "text": wordy, "id": unique,
    }
    named = F.array_compact(F.array(*[F.when(test, F.lit(r)) for r, test in roles.items()]))
    return known.select("column", F.explode(named).alias("role"))


def table_metadata(df: DataFrame) -> DataFrame:
    """(column, dtype, missing, rows, columns)."""
    kinds = dict(df.dtypes)
    label = F.create_map(*[F.lit(x) for c in df.columns for x in (c, kinds[c])])
    return presence(df).select(
        "column", label[F.col("column")].alias("dtype"), "missing", "rows",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
    )


def _totals(df: DataFrame) -> DataFrame:
    return quality_profile(df).agg(
        F.max("rows").alias("rows"), F.max("duplicates").alias("duplicates"),
        F.max("missing_total").alias("missing"),
    ).select(
        rows_of(
            [
                F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(m), F.lit(0)).alias("value"))
                for m in ("rows", "duplicates", "missing")
            ]
        )
    )


def quality_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(metric, before, after, change) for rows, duplicates, missing."""
    b = _totals(before).withColumnRenamed("value", "before")
    a = _totals(after).withColumnRenamed("value", "after")
    return b.join(F.broadcast(a), "metric").select(
        "metric", "before", "after", (F.col("before") - F.col("after")).alias("change")
    )


def insights(df: DataFrame) -> DataFrame:
    """(column, insight, value): missing cells in all, and skewed columns.

    With nothing to say, one row says so.
    """
    lack = presence(df).agg(F.coalesce(F.sum("missing"), F.lit(0)).cast("double").alias("value")).select(
        F.lit("*").alias("column"), F.lit("missing_values").alias("insight"), "value"
    ).filter("value > 0")
    found = lack
    if ty.number_columns(df):
        skewed = numeric_summary(df, skew=True).filter((F.col("std") > 0) & (F.abs("skew") > SKEW_LIMIT))
        found = lack.unionByName(
            skewed.select("column", F.lit("highly_skewed").alias("insight"), F.col("skew").alias("value"))
        )
    # At most one row per column plus one, so this is a small aggregate.
    said = found.agg(F.collect_list(F.struct("column", "insight", "value")).alias("said"))
    nothing = F.array(
        F.struct(
            F.lit("*").alias("column"), F.lit("no_anomalies").alias("insight"),
            F.lit(None).cast("double").alias("value"),
        )
    )
    return said.select(F.inline(F.when(F.size("said") > 0, F.col("said")).otherwise(nothing)))
