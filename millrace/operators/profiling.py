"""Column profiles and bivariate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, rows_of
from millrace.functions.sqltext import aggregate_rows, name_sql, number_sql, text_sql
from millrace.functions.types import as_number, ref
from millrace.operators.contingency import group_moments
from millrace.operators.frequency import distinct_counts
from millrace.operators.moments import target_correlations
from millrace.operators.quantiles import column_quantiles
from millrace.operators.summary import BLOCK, column_facts, sample_skew_sql


def univariate(df: DataFrame) -> DataFrame:
    """(column, missing_pct, n_unique, mean, std, min, max, skew).

    missing_pct is a fraction; the moments are NULL for non-numeric columns.
    Both sides of the join hold one row per column.
    """
    ty.require_flat(df)
    known = distinct_counts(df)
    return (
        _column_moments(df)
        .join(F.broadcast(known), "column", "left")
        .select(
            "column", "missing_pct", F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"),
            "mean", "std", "min", "max", "skew",
        )
    )


def _column_moments(df: DataFrame) -> DataFrame:
    """(column, missing_pct, mean, std, min, max, skew), one scan per block."""
    blocks = []
    for block in chunks(df.columns, BLOCK):
        aggregates, records = {"rows": "count(1)"}, []
        for i, c in enumerate(block):
            aggregates[f"p{i}"] = f"count({name_sql(c)})"
            row = {"column": text_sql(c), "missing_pct": f"try_divide(cast(rows - p{i} AS double), rows)"}
            parts = dict.fromkeys(("mean", "std", "min", "max", "skew"), "cast(NULL AS double)")
            if ty.is_number(ty.dtype_of(df, c)):
                x = number_sql(df, c)
                found = {
                    "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})",
                    "max": f"max({x})", "skew": sample_skew_sql(x),
                }
                aggregates.update({f"{k}{i}": v for k, v in found.items()})
                parts = {k: f"{k}{i}" for k in found}
            records.append({**row, **parts})
        blocks.append((aggregates, records))
    return aggregate_rows(df, blocks)


def category_number_stats(
    df: DataFrame, cats: Sequence[str] | None = None, nums: Sequence[str] | None = None,
    top_k: int | None = 20,
) -> DataFrame:
    """(cat, key, num, mean, cnt): the first ``top_k`` keys in key order."""
    cats = list(cats) if cats is not None else ty.text_columns(df)
    nums = list(nums) if nums is not None else ty.number_columns(df)
    groups = group_moments(df, cats, nums).select("cat", "key", "num", "mean", "cnt")
    if top_k is None:
        return groups
    order = Window.partitionBy("cat", "num").orderBy("key")
    return groups.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= top_k).drop("__rank")


def bin_index(x: Column, low: float, high: float, bins: int) -> Column:
    """0-based equal-width bin; the maximum falls in the last bin."""
    if not high > low:
        return F.when(x.isNotNull(), F.lit(0).cast("bigint"))
    width = (high - low) / bins
    at = F.floor((x - F.lit(low)) / F.lit(width)).cast("bigint")
    # least() passes over NULL, so a missing value needs its own case.
    return F.when(x.isNotNull(), F.least(F.lit(bins - 1).cast("bigint"), at))


def edge_index(x: Column, edges: Sequence[float]) -> Column:
    """Number of inner edges strictly below x: right-closed bins."""
    over = [(x > F.lit(e)).cast("bigint") for e in edges]
    return sum(over[1:], over[0]) if over else F.lit(0).cast("bigint")


def mutual_information(
    df: DataFrame, target: str | None = None, columns: Sequence[str] | None = None,
    bins: int = 16, method: str = "width",
) -> DataFrame:
    """(feature, mi): binned mutual information in nats with ``target``.

    The target defaults to the first numeric column; missing values count as
    0.  At most bins x bins cells per feature leave the map side.
    """
    nums = ty.number_columns(df)
    target = target or nums[0]
    feats = [c for c in (columns if columns is not None else nums) if c != target]
    filled = df.select(*[F.coalesce(as_number(df, c), F.lit(0.0)).alias(c) for c in [*feats, target]])
    if method == "width":
        facts = column_facts(filled, [*feats, target])
        binned = {c: bin_index(ref(c), facts[c]["min"] or 0.0, facts[c]["max"] or 0.0, bins) for c in facts}
    elif method == "quantile":
        probs = [i / bins for i in range(1, bins)]
        cuts = column_quantiles(filled, [*feats, target], probs)
        binned = {c: edge_index(ref(c), sorted({v for v in e if v is not None})) for c, e in cuts.items()}
    else:
        raise ValueError(f"unknown binning {method!r}")
    records = [
        F.struct(F.lit(c).alias("feature"), binned[c].alias("bx"), binned[target].alias("by")) for c in feats
    ]
    cells = filled.select(rows_of(records)).groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).alias("c"))
    one = Window.partitionBy("feature")
    joint = cells.select(
        "feature", "c",
        F.sum("c").over(one).alias("n"),
        F.sum("c").over(Window.partitionBy("feature", "bx")).alias("cx"),
        F.sum("c").over(Window.partitionBy("feature", "by")).alias("cy"),
    )
    c, n, cx, cy = (F.col(v).cast("double") for v in ("c", "n", "cx", "cy"))
    return joint.groupBy("feature").agg(F.sum(c / n * F.log(c * n / (cx * cy))).alias("mi"))


def target_number_profile(df: DataFrame, target: str) -> DataFrame:
    """(target, dtype, missing_pct, n_unique, mean, std, min, max, skew)."""
    ty.require_column(df, target)
    return univariate(df.select(ref(target))).select(
        F.col("column").alias("target"), F.lit(dict(df.dtypes)[target]).alias("dtype"),
        "missing_pct", "n_unique", "mean", "std", "min", "max", "skew",
    )


def feature_correlations(df: DataFrame, target: str, digits: int = 3) -> DataFrame:
    """(column, r): numeric columns against a numeric target, itself included."""
    return target_correlations(df, target).select("column", F.round("r", digits).alias("r"))
