"""Cells, group moments and chi-square of categorical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import ratio
from millrace.functions.sqltext import inline, name_sql, number_sql, record, text_sql


def contingency(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, v1, v2, cnt): observed cells of every pair, no NULLs.

    Each row yields one record per pair; the map-side combine folds them into
    cells, so what is shuffled is cells per task, not rows.
    """
    pairs = list(pairs)
    if not pairs:
        raise ValueError("no column pairs given")
    records = [
        record(
            {
                "pair": str(i), "v1": f"cast({name_sql(a)} AS string)", "v2": f"cast({name_sql(b)} AS string)",
            }
        )
        for i, (a, b) in enumerate(pairs)
    ]
    cells = (
        df.selectExpr(inline(records))
        .filter("v1 IS NOT NULL AND v2 IS NOT NULL")
        .groupBy("pair", "v1", "v2")
        .agg(F.expr("count(1) AS cnt"))
    )
    labels = [
        f"element_at(array({', '.join(text_sql(p[side]) for p in pairs)}), pair + 1) AS {name}"
        for side, name in ((0, "col_a"), (1, "col_b"))
    ]
    return cells.selectExpr(*labels, "v1", "v2", "cnt")


def crosstab(df: DataFrame, a: str, b: str, bucket: int = 1000) -> DataFrame:
    """(v1, v2, cnt) with a zero for every combination that does not occur.

    The second column's values are packed into lists of about ``bucket``
    values; each first value meets every list by an equi-join on its number.
    The lists are broadcast only when their checked total is small.
    """
    cells = contingency(df, [(a, b)]).select("v1", "v2", "cnt")
    seconds = cells.select("v2").distinct()
    n_second = seconds.count()
    lists = max(1, -(-n_second // bucket))
    packed = seconds.groupBy(F.pmod(F.hash("v2"), F.lit(lists)).alias("list")).agg(
        F.collect_list("v2").alias("values")
    )
    if n_second <= 100 * bucket:
        packed = F.broadcast(packed)
    grid = (
        cells.select("v1")
        .distinct()
        .select("v1", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list"))
        .join(packed, "list")
        .select("v1", F.explode("values").alias("v2"))
    )
    return grid.join(cells, ["v1", "v2"], "left").select(
        "v1", "v2", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")
    )


def chi_square(cells: DataFrame, keys: Sequence[str] = ("col_a", "col_b")) -> DataFrame:
    """(*keys, n, r, k, chi2, dof) from observed cells.

    Empty cells add their expected count, obtained as the total minus the
    expected counts of the seen cells.  Yates' correction applies at dof 1;
    with one row or column the statistic is 0.
    """
    keys = list(keys)
    totals = cells.groupBy(*keys, "v1").agg(F.sum("cnt").alias("rt"), F.count(F.lit(1)).alias("rc"))
    sides = cells.groupBy(*keys, "v2").agg(F.sum("cnt").alias("ct"), F.count(F.lit(1)).alias("cc"))
    whole = totals.groupBy(*keys).agg(F.sum("rt").alias("n"))
    n, rt, ct = (F.col(c).cast("double") for c in ("n", "rt", "ct"))
    expected = rt * ct / n
    gap = F.abs(F.col("cnt") - expected)
    joined = cells.join(totals, [*keys, "v1"]).join(sides, [*keys, "v2"]).join(whole, keys)
    folded = joined.groupBy(*keys, "n").agg(
        F.count(F.lit(1)).alias("seen"),
        F.sum(gap * gap / expected).alias("seen_chi2"),
        F.sum(expected).alias("seen_expected"),
        F.max(gap).alias("gap"),
        F.sum(1.0 / (rt * F.col("rc"))).alias("inv_r"),
        F.sum(1.0 / (ct * F.col("cc"))).alias("inv_c"),
        F.sum(1.0 / F.col("rc")).alias("r_sum"),
        F.sum(1.0 / F.col("cc")).alias("k_sum"),
    )
    r, k = F.round("r_sum").cast("bigint"), F.round("k_sum").cast("bigint")
    out = folded.withColumns({"r": r, "k": k}).withColumn("dof", (F.col("r") - 1) * (F.col("k") - 1))
    unseen = F.when(F.col("seen") == F.col("r") * F.col("k"), 0.0).otherwise(
        F.greatest(F.lit(0.0), F.col("n") - F.col("seen_expected"))
    )
    shrunk = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    yates = shrunk * shrunk * F.col("n") * F.col("inv_r") * F.col("inv_c")
    chi2 = (
        F.when(F.col("dof") == 0, 0.0)
        .when(F.col("dof") == 1, yates)
        .otherwise(F.col("seen_chi2") + unseen)
    )
    return out.select(*keys, "n", "r", "k", chi2.alias("chi2"), "dof")


def cramers_v(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, v) = sqrt(chi2 / n / max(1, min(r-1, k-1)))."""
    smaller = F.least(F.col("k") - 1, F.col("r") - 1)
    v = F.sqrt(ratio(F.col("chi2"), F.col("n")) / F.greatest(F.lit(1), smaller))
    return chi_square(contingency(df, pairs)).select("col_a", "col_b", v.alias("v"))


def group_moments(df: DataFrame, cats: Sequence[str], nums: Sequence[str]) -> DataFrame:
    """(cat, key, num, cnt, mean, var) per group, var with divisor n-1.

    Each row is repeated once per categorical column and carries all numeric
    columns, so the blow-up does not grow with their number.
    """
    cats, nums = list(cats), list(nums)
    keys = [
        record({"cat": text_sql(c), "key": f"cast({name_sql(c)} AS string)"}) for c in cats
    ]
    spread = df.selectExpr(
        *[f"{number_sql(df, m)} AS n{i}" for i, m in enumerate(nums)], inline(keys)
    ).filter("key IS NOT NULL")
    grouped = spread.groupBy("cat", "key").agg(
        *[
            F.expr(f"{f}(n{i}) AS {f}{i}")
            for i in range(len(nums)) for f in ("count", "avg", "var_samp")
        ]
    )
    records = [
        record({"num": text_sql(m), "cnt": f"count{i}", "mean": f"avg{i}", "var": f"var_samp{i}"})
        for i, m in enumerate(nums)
    ]
    return grouped.selectExpr("cat", "key", inline(records))
