"""One-pass column summaries.

All columns share one global aggregate per block of ``BLOCK`` columns, so a
table is scanned once however many columns are asked for.  The block keeps the
generated aggregate code within the JVM method limits on wide tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row

from millrace.functions import types as ty
from millrace.functions.expressions import chunks
from millrace.functions.sqltext import aggregate_rows, name_sql, number_sql, record, text_sql

BLOCK = 100


def sample_skew_sql(x: str) -> str:
    """Bias-corrected skewness: 0 for a constant, NULL below three values."""
    n = f"cast(count({x}) as double)"
    return (
        f"CASE WHEN count({x}) >= 3 THEN CASE WHEN min({x}) = max({x}) THEN 0.0D "
        f"ELSE skewness({x}) * try_divide(sqrt({n} * ({n} - 1)), {n} - 2) END END"
    )


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, skew: bool = False
) -> DataFrame:
    """(column, rows, present, mean, std, std_pop, min, max[, skew])."""
    names = list(columns) if columns is not None else ty.number_columns(df)
    if not names:
        raise ValueError("no numeric columns to summarise")
    blocks = []
    for block in chunks(names, BLOCK):
        aggregates = {"rows": "count(1)"}
        records = []
        for i, c in enumerate(block):
            x = number_sql(df, c)
            parts = {
                "present": f"count({x})", "mean": f"avg({x})", "std": f"stddev_samp({x})",
                "std_pop": f"CASE WHEN count({x}) = 1 THEN 0.0D ELSE stddev_samp({x}) * sqrt((count({x}) - 1) / count({x})) END", "min": f"min({x})", "max": f"max({x})",
            }
            if skew:
                parts["skew"] = sample_skew_sql(x)
            aggregates.update({f"{p}{i}": sql for p, sql in parts.items()})
            records.append({"column": text_sql(c), "rows": "rows", **{p: f"{p}{i}" for p in parts}})
        blocks.append((aggregates, records))
    return aggregate_rows(df, blocks)


def presence(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, missing) for every column, of any type."""
    names = list(columns) if columns is not None else df.columns
    blocks = []
    for block in chunks(names, BLOCK):
        aggregates = {"n": "count(1)", **{f"p{i}": f"count({name_sql(c)})" for i, c in enumerate(block)}}
        records = [
            {"column": text_sql(c), "rows": "n", "missing": f"n - p{i}"} for i, c in enumerate(block)
        ]
        blocks.append((aggregates, records))
    return aggregate_rows(df, blocks)


def column_facts(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """Collect per-column scalars: rows, present, varies, and numeric moments.

    One row per column reaches the driver, never table rows.
    """
    facts: dict[str, Row] = {}
    for block in chunks(columns, BLOCK):
        exprs = []
        for i, name in enumerate(block):
            c = name_sql(name)
            parts = {"rows": "count(1)", "present": f"count({c})", "varies": f"min({c}) < max({c})"}
            if ty.is_number_like(ty.dtype_of(df, name)):
                x = number_sql(df, name)
                parts.update(
                    mean=f"avg({x})", std_pop=f"stddev_pop({x})", min=f"min({x})", max=f"max({x})"
                )
            exprs.append(f"{record(parts)} AS s{i}")
        row = df.selectExpr(*exprs).first()
        facts.update({name: row[i] for i, name in enumerate(block)})
    return facts
