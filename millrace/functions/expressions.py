"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import ref


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, NULL where the divisor is zero or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def rows_of(structs: Sequence[Column]) -> Column:
    """Turn same-shaped structs into rows; use it in ``select``."""
    return F.inline(F.array(*structs))


def chunks(items: Iterable, size: int) -> Iterator[list]:
    block: list = []
    for item in items:
        block.append(item)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rounded(df: DataFrame, digits: int | dict[str, int]) -> DataFrame:
    """Round the named columns (or every double column) for reports."""
    if isinstance(digits, int):
        digits = {n: digits for n, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.round(ref(c), d) for c, d in digits.items()})
