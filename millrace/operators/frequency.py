"""Value frequencies: distinct counts, modes and top values.

Columns are turned into (column, value) rows and grouped once.  The map-side
combine means a value holding a third of all rows reaches the reducers as one
partial row per task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import types as ty
from millrace.functions.expressions import chunks, union_all
from millrace.functions.sqltext import name_sql
from millrace.functions.types import ref


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as string, cnt), NULL kept as a value of its own."""
    shaped = df.select(*[ref(c).cast("string").alias(c) for c in columns])
    return (
        shaped.unpivot([], [ref(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _storage_key(dtype: T.DataType) -> str:
    """Columns with the same key can share one unpivoted value column."""
    if isinstance(dtype, T.IntegralType):
        return "bigint"
    if ty.is_float(dtype):
        return "double"
    if ty.is_text(dtype):
        return "string"
    return dtype.simpleString()


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique), exact, NULL not counted.

    Columns of one type are unpivoted together, so values stay in their own
    type and each scan reads only the columns of that type.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for c in columns if columns is not None else df.columns:
        groups[_storage_key(ty.dtype_of(df, c))].append(c)
    frames = []
    for kind, names in groups.items():
        values = (
            df.select(*[ref(c).cast(kind).alias(c) for c in names])
            .unpivot([], [ref(c) for c in names], "column", "value")
            .groupBy("column", "value")
            .agg(F.lit(1).alias("seen"))
        )
        frames.append(
            values.groupBy("column").agg(F.count("value").alias("n_unique"))
        )
    return union_all(frames)


def distinct_map(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Collected ``distinct_counts``: one number per column; an empty table
    has no (column, value) rows, so its columns count zero."""
    found = {r["column"]: r["n_unique"] for r in distinct_counts(df, columns).collect()}
    return {c: found.get(c, 0) for c in columns}


def fewer_than(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, int]:
    """Exact distinct counts of the columns with fewer than ``limit`` values.

    A sketch first sets aside the clearly large columns so that they are never
    grouped: fewer than ``limit`` values fill fewer than ``limit`` registers,
    so their estimate cannot reach twice ``limit``.
    """
    maybe: list[str] = []
    for block in chunks(columns, 100):
        sketches = [f"approx_count_distinct({name_sql(c)}) AS a{i}" for i, c in enumerate(block)]
        maybe += [c for c, n in zip(block, df.selectExpr(*sketches).first()) if n < 2 * limit + 8]
    if not maybe:
        return {}
    return {c: n for c, n in distinct_map(df, maybe).items() if n < limit}


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, cnt): most frequent value, the smallest on a tie."""
    best = F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value")))
    return (
        value_frequencies(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(best.alias("best"))
        .select("column", F.col("best.value").alias("value"), (-F.col("best.neg")).alias("cnt"))
    )


def top_values(
    df: DataFrame, columns: Sequence[str], k: int | None = 20, keep_null: bool = False
) -> DataFrame:
    """(column, value, cnt, rank) ordered by count, then value.

    The rank filter becomes a per-task group limit before the shuffle, so a
    column with very many values sends at most ``k`` rows per task.  With
    ``k=None`` all values come back, unranked.
    """
    freq = value_frequencies(df, columns)
    if not keep_null:
        freq = freq.filter(F.col("value").isNotNull())
    if k is None:
        return freq
    order = Window.partitionBy("column").orderBy(F.desc("cnt"), F.asc_nulls_last("value"))
    return freq.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
