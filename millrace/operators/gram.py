"""Moments of all pairs among many numeric columns, by Gram products.

Every task multiplies its rows' centred values and presence marks, block by block, and
returns one row a pair; Spark adds the rows up.  Missing values take no part in a pair,
as in the pass for few pairs: both give the same sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import chunks, union_all
from millrace.functions.types import as_number
from millrace.session import ship_package

#: Columns of a block, and rows that are multiplied at once: a task holds six matrices of
#: a block's pairs (48 MB).
BLOCK_COLUMNS, SLICE_ROWS = 1_000, 1_000
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _packed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(v): each row's values as one array, NaN for missing ones.

    Whole-stage code would evaluate all columns in one method, which the JVM doesn't
    compile beyond 8,000 bytes; Spark leaves a projection with a lambda out of it and
    cuts the expressions into short methods.
    """
    values = F.array(*[as_number(df, c) for c in names])
    return df.select(F.transform(values, lambda v: F.coalesce(v, F.lit(float("nan")))).alias("v"))


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        values = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        yield from (values[i : i + SLICE_ROWS] for i in range(0, len(values), SLICE_ROWS))


def _matrix(values: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centred values with 0 for missing ones, and where there are any."""
    there = ~np.isnan(values)
    return np.where(there, values - means, 0.0), there.astype(np.float64)


def _totals(columns: list[int]) -> Callable:
    """(a, n, s): each column's present values and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(columns), np.int64), np.zeros(len(columns))
        for values in _slices(batches, len(columns)):
            there = ~np.isnan(values)
            n += there.sum(0)
            total += np.where(there, values, 0.0).sum(0)
        yield pa.record_batch({"a": pa.array(columns, pa.int32()), "n": pa.array(n), "s": pa.array(total)})

    return run


def _means(df: DataFrame, names: list[str], blocks: Sequence[list[int]]) -> np.ndarray:
    """Each column's mean, 0 without values; one row a column reaches the driver."""
    found = [_packed(df, [names[k] for k in block]).mapInArrow(_totals(block), "a int, n long, s double") for block in blocks]
    means = np.zeros(len(names))
    for row in union_all(found).groupBy("a").agg((F.try_divide(F.sum("s"), F.sum("n"))).alias("mean")).collect():
        means[row["a"]] = row["mean"] or 0.0
    return means


def _products(left: list[int], right: list[int], means: np.ndarray) -> Callable:
    """Sums of each pair of a left and a right column, over rows that hold both.

    Rows hold the left columns, then the right ones if those are others.
    """
    rows, columns = np.array(left), np.array(right)
    same, used = left == right, left if left == right else left + right
    centre, cut = means[used], len(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {name: np.zeros((len(left), len(right))) for name in _SUMS}
        for values in _slices(batches, len(used)):
            x, in_x = _matrix(values[:, :cut], centre[:cut])
            y, in_y = (x, in_x) if same else _matrix(values[:, cut:], centre[cut:])
            sums["n"] += in_x.T @ in_y
            sums["sx"] += x.T @ in_y
            sums["sxx"] += (x * x).T @ in_y
            sums["sxy"] += x.T @ y
            if not same:
                sums["sy"] += in_x.T @ y
                sums["syy"] += in_x.T @ (y * y)
        if same:
            sums["sy"], sums["syy"] = sums["sx"].T, sums["sxx"].T
        # Each pair once.
        a, b = np.nonzero(rows[:, None] <= columns[None, :])
        made = {"a": pa.array(rows[a], pa.int32()), "b": pa.array(columns[b], pa.int32())}
        yield pa.record_batch(made | {name: pa.array(sums[name][a, b]) for name in _SUMS})

    return run


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, sx, sy, sxx, syy, sxy) by places a <= b of the columns, about each column's mean."""
    names = list(columns)
    ship_package(df.sparkSession)
    blocks = list(chunks(list(range(len(names))), BLOCK_COLUMNS))
    means = _means(df, names, blocks)
    schema = "a int, b int, " + ", ".join(f"{s} double" for s in _SUMS)
    found = []
    for i, left in enumerate(blocks):
        for right in blocks[i:]:
            used = left if left == right else left + right
            found.append(_packed(df, [names[k] for k in used]).mapInArrow(_products(left, right, means), schema))
    sums = [F.sum(s).alias(s) for s in _SUMS]
    return union_all([f.groupBy("a", "b").agg(*sums) for f in found])
