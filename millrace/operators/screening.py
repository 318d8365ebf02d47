"""Feature screening: ids, constant features, correlated features, leakage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, rows_of, union_all
from millrace.functions.types import as_number, ref
from millrace.operators.cleaning import one_hot, times_to_seconds
from millrace.operators.frequency import distinct_counts
from millrace.operators.hypothesis import LEAK_CORRELATION, identical_columns
from millrace.operators.moments import all_pairs, pair_correlation, target_correlations

# Thresholds that results must agree on.
ID_SHARE = 0.95
VARIANCE_FLOOR = 0.0
CORRELATION_LIMIT = 0.9


def id_columns(df: DataFrame, share: float = ID_SHARE, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique): non-float columns, distinct values >= share of rows."""
    names = [
        c for c in (columns if columns is not None else df.columns)
        if not ty.is_float(ty.dtype_of(df, c))
    ]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, n_unique bigint")
    rows = df.agg(F.count(F.lit(1))).scalar()
    return distinct_counts(df, names).filter(F.col("n_unique") >= rows * F.lit(share))


def feature_variance(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, variance, kept): population variance, kept above zero."""
    names = list(columns) if columns is not None else ty.number_like_columns(df)
    frames = []
    for block in chunks(names, 100):
        wide = df.agg(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.when(F.min(ref(c)) == F.max(ref(c)), 0.0).otherwise(F.var_pop(as_number(df, c))).alias("variance"),
                ).alias(f"v{i}")
                for i, c in enumerate(block)
            ]
        )
        frames.append(wide.select(rows_of([F.col(f"v{i}") for i in range(len(block))])))
    return union_all(frames).withColumn("kept", F.coalesce(F.col("variance") > VARIANCE_FLOOR, F.lit(False)))


def correlated_features(
    df: DataFrame, columns: Sequence[str] | None = None, limit: float = CORRELATION_LIMIT
) -> DataFrame:
    """(column): columns with abs(r) > limit with any earlier column."""
    names = list(columns) if columns is not None else ty.number_like_columns(df)
    pairs = all_pairs(names)
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string")
    return (
        pair_correlation(df, pairs)
        .filter(F.abs("r") > limit)
        .select(F.col("col_b").alias("column"))
        .distinct()
    )


def leaking_features(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column): identical to the target, or abs(r) >= 0.95 with it."""
    names = [c for c in (columns if columns is not None else df.columns) if c != target]
    found = [identical_columns(df.select(*[ref(c) for c in names], ref(target)), target)]
    nums = [c for c in names if ty.is_number_like(ty.dtype_of(df, c))]
    if nums and ty.is_number_like(ty.dtype_of(df, target)):
        found.append(
            target_correlations(df, target, nums).filter(F.abs("r") >= LEAK_CORRELATION).select("column")
        )
    return union_all(found).distinct()


@dataclass
class Selection:
    """The encoded table, the features to use, and why others were dropped."""

    table: DataFrame
    features: list[str]
    dropped: dict[str, str]

    def report(self) -> DataFrame:
        """(feature, status, reason)."""
        rows = [(f, "used", None) for f in self.features]
        rows += [(f, "dropped", why) for f, why in self.dropped.items()]
        return self.table.sparkSession.createDataFrame(rows, "feature string, status string, reason string")


def _names(df: DataFrame) -> list[str]:
    return [r["column"] for r in df.select("column").collect()]


def select_features(
    df: DataFrame, target: str, keep: Sequence[str] = (), max_categories: int = 1000
) -> Selection:
    """Ids out, one-hot, zero fill, then constant, correlated, leaking out.

    ``keep`` names row keys that stay in the table but are never features.
    Each step collects column names only.
    """
    ty.require_column(df, target)
    df = times_to_seconds(df)
    dropped: dict[str, str] = {}
    candidates = [c for c in df.columns if c != target and c not in keep]
    for c in _names(id_columns(df, columns=candidates)):
        dropped[c] = "id"
    candidates = [c for c in candidates if c not in dropped]
    base = df.select(*[ref(c) for c in [*keep, *candidates, target]])
    texts = [c for c in ty.text_columns(base) if c in candidates]
    wide = one_hot(base, texts, max_categories)
    feats = [c for c in wide.columns if c != target and c not in keep]
    scalars = [c for c in feats if ty.is_number_like(ty.dtype_of(wide, c))]
    vectors = [c for c in feats if c not in scalars]
    filled = wide.withColumns(
        {c: F.coalesce(as_number(wide, c), F.lit(0.0)) for c in scalars}
    )
    if scalars:
        for r in feature_variance(filled, scalars).filter("not kept").collect():
            dropped[r["column"]] = "low_variance"
    scalars = [c for c in scalars if c not in dropped]
    if len(scalars) > 1:
        for c in _names(correlated_features(filled, scalars)):
            dropped[c] = "high_correlation"
    scalars = [c for c in scalars if c not in dropped]
    if scalars:
        for c in _names(leaking_features(filled, target, scalars)):
            dropped[c] = "leakage"
    used = [c for c in scalars if c not in dropped] + vectors
    table = filled.select(*[ref(c) for c in [*keep, *used, target]])
    if target in used:
        raise AssertionError("the target must not be among the features")
    return Selection(table, used, dropped)
