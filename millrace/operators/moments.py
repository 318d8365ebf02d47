"""Pairwise-complete linear association between numeric columns.

Two passes: column means and ranges, then sums of centred products.  Columns
without missing values share their single-column sums across pairs, so ``c``
columns cost ``c(c-1)/2`` product sums plus ``2c`` others, in one scan per
``PAIRS_PER_PASS`` pairs.  Beyond ``PAIRS_IN_SQL`` pairs Gram products give the
same sums in one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, ratio
from millrace.functions.sqltext import aggregate_rows, double_sql, number_sql, text_sql
from millrace.operators.gram import pair_moments
from millrace.operators.summary import column_facts

PAIRS_PER_PASS, PAIRS_IN_SQL = 150, 600
#: A side whose squares about its mean are a smaller share than this of its squares
#: about the whole column's mean doesn't vary (Gram products only; else minima decide).
FLAT_SHARE = 1e-12


def all_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


def pair_correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, n, r): Pearson r over rows where both are present.

    r is NULL when either side does not vary over those rows.
    """
    pairs = list(pairs)
    if not pairs:
        raise ValueError("no column pairs given")
    used = list(dict.fromkeys(c for p in pairs for c in p))
    if len(pairs) > PAIRS_IN_SQL:
        return _by_products(df, pairs, used)
    facts = column_facts(df, used)
    full = {c for c in used if facts[c]["present"] == facts[c]["rows"]}
    slot = {c: f"c{i}" for i, c in enumerate(used)}
    centred = df.selectExpr(
        *[f"{number_sql(df, c)} - {double_sql(facts[c]['mean'] or 0.0)} AS {slot[c]}" for c in used]
    )
    return _correlations(
        aggregate_rows(centred, [_pair_sums(block, slot, full) for block in chunks(pairs, PAIRS_PER_PASS)])
    )


def _by_products(df: DataFrame, pairs: Sequence[tuple[str, str]], used: Sequence[str]) -> DataFrame:
    """The correlations of many pairs; which pairs were asked for is one row each."""
    place = {c: i for i, c in enumerate(used)}
    wanted = [(min(place[a], place[b]), max(place[a], place[b]), a, b) for a, b in pairs]
    asked = df.sparkSession.createDataFrame(wanted, "a int, b int, col_a string, col_b string")

    def varies(squares: str, total: str) -> Column:
        return F.col(squares) - ratio(F.col(total) * F.col(total), F.col("n")) > F.lit(FLAT_SHARE) * F.col(squares)

    sums = pair_moments(df, used).withColumn("n", F.col("n").cast("long"))
    sums = sums.withColumn("vx", varies("sxx", "sx")).withColumn("vy", varies("syy", "sy"))
    return _correlations(sums.join(asked, ["a", "b"]))


def _pair_sums(
    pairs: Sequence[tuple[str, str]], slot: dict[str, str], full: set[str]
) -> tuple[dict[str, str], list[dict[str, str]]]:
    """Aggregates and records for a block of pairs of centred columns.

    A pair with missing values sums each side over rows where the other side
    is present; complete pairs share their single-column sums.
    """
    aggregates: dict[str, str] = {"n_all": "count(1)"}
    records = []
    for i, (a, b) in enumerate(pairs):
        x, y = slot[a], slot[b]
        plain = a in full and b in full
        aggregates[f"xy_{i}"] = f"sum({x} * {y})"
        parts = {"col_a": text_sql(a), "col_b": text_sql(b), "n": "n_all", "sxy": f"xy_{i}"}
        if not plain:
            aggregates[f"n_{i}"] = f"count({x} * {y})"
            parts["n"] = f"n_{i}"
        for side, me, other in (("x", x, y), ("y", y, x)):
            key = me if plain else f"{i}{side}"
            z = me if plain else f"CASE WHEN {other} IS NOT NULL THEN {me} END"
            aggregates.update(
                {f"s_{key}": f"sum({z})", f"q_{key}": f"sum({z} * {z})", f"v_{key}": f"min({z}) < max({z})"}
            )
            parts.update({f"s{side}": f"s_{key}", f"s{side}{side}": f"q_{key}", f"v{side}": f"v_{key}"})
        records.append(parts)
    return aggregates, records


def _correlations(moments: DataFrame) -> DataFrame:
    n = F.col("n")

    def about_mean(product: str, a: str, b: str) -> Column:
        return F.col(product) - ratio(F.col(a) * F.col(b), n)

    scale = F.sqrt(about_mean("sxx", "sx", "sx")) * F.sqrt(about_mean("syy", "sy", "sy"))
    r = F.when(F.col("vx") & F.col("vy"), ratio(about_mean("sxy", "sx", "sy"), scale))
    bounded = F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return moments.select("col_a", "col_b", "n", bounded.alias("r"))


def correlation_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.3
) -> DataFrame:
    """(col_a, col_b, r) for unordered pairs with abs(r) >= threshold."""
    names = list(columns) if columns is not None else ty.number_columns(df)
    return (
        pair_correlation(df, all_pairs(names))
        .filter(F.abs("r") >= threshold)
        .select("col_a", "col_b", "r")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_a, col_b, r) for every ordered pair, the diagonal included.

    Each unordered pair is computed once and mirrored.
    """
    names = list(columns) if columns is not None else ty.number_columns(df)
    pairs = all_pairs(names) + [(c, c) for c in names]
    half = pair_correlation(df, pairs).select("col_a", "col_b", "r")
    return half.select(
        F.inline(
            F.when(
                F.col("col_a") == F.col("col_b"),
                F.array(F.struct("col_a", "col_b", "r")),
            ).otherwise(
                F.array(
                    F.struct("col_a", "col_b", "r"),
                    F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), F.col("r")),
                )
            )
        )
    )


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n, r) of every numeric column against the target, itself too."""
    ty.require_column(df, target)
    names = list(columns) if columns is not None else ty.number_columns(df)
    return pair_correlation(df, [(c, target) for c in names]).select(
        F.col("col_a").alias("column"), "n", "r"
    )
