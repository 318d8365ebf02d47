"""Aggregate lists as SQL text.

An operator over many columns or pairs needs hundreds of expressions.  Each
Column call from Python costs a round trip to the JVM; one expression text is
parsed in a single call, and gives the same plan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from millrace.functions import types as ty
from millrace.functions.expressions import union_all


def name_sql(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_sql(value: float) -> str:
    value = float(value)
    if math.isnan(value) or math.isinf(value):
        return f"double('{value}')"
    return f"{value!r}D"


def number_sql(df: DataFrame, column: str) -> str:
    """The column as double; booleans become 0/1."""
    inner = name_sql(column)
    if ty.is_boolean(ty.dtype_of(df, column)):
        inner = f"cast({inner} as int)"
    return f"cast({inner} as double)"


def record(fields: Mapping[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{text_sql(k)}, {v}" for k, v in fields.items()) + ")"


def inline(records: Sequence[str]) -> str:
    """A generator that turns same-shaped records into rows."""
    return f"inline(array({', '.join(records)}))"


def aggregate_rows(
    df: DataFrame, blocks: Sequence[tuple[Mapping[str, str], Sequence[Mapping[str, str]]]]
) -> DataFrame:
    """One global aggregate per block, each turned into rows.

    A block is (aggregates by name, records over those names).
    """
    frames = []
    for aggregates, records in blocks:
        wide = df.selectExpr(*[f"{sql} AS {name_sql(n)}" for n, sql in aggregates.items()])
        frames.append(wide.selectExpr(inline([record(r) for r in records])))
    return union_all(frames)
