"""Values carried along the order of rows.

Rows lie in blocks of bounded size by their position; a window fills within a block,
and one row for each block tells the next blocks what the last value was.  That table
is carried on the same way, until one block is left, so no window ever holds more
than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Positions in a block.
BLOCK_ROWS = 65_536


def fill_ordered(df: DataFrame, columns: Sequence[str], position: str, back: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fill NULLs with the last value before, and a leading gap with the first one after if ``back``.

    ``position`` holds distinct whole numbers, with or without gaps, as the loaders'
    ``position=`` gives them.  Rows without a position stay as they are and give
    nothing to others; a column without values stays NULL.
    """
    chosen = [c for c in dict.fromkeys(columns) if c != position]
    missing = [c for c in [*chosen, position] if c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing[0]!r}")
    if block_rows < 2:
        raise ValueError("a block holds two positions at least")
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    short = dict(zip(df.columns, plain.columns, strict=True))
    at, values = short[position], [short[c] for c in chosen]
    # The first value of each column fills a leading gap.
    firsts = [F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(at))) for v in values]
    low, high, *first = plain.agg(F.min(at), F.max(at), *firsts).first()
    if low is None or not values:
        return df
    placed = plain.filter(F.col(at).isNotNull()).withColumn("place", F.col(at).cast("long") - F.lit(low))
    rows = _before(placed, values, "place", high - low, block_rows)
    kinds = dict(plain.dtypes)
    lead = {v: F.lit(x).cast(kinds[v]) if back else F.lit(None).cast(kinds[v]) for v, x in zip(values, first, strict=True)}
    rows = rows.withColumns({v: F.coalesce(v, f"{v}_met", lead[v]) for v in values})
    whole = rows.select(*plain.columns).unionByName(plain.filter(F.col(at).isNull()))
    return whole.toDF(*df.columns)


def _before(rows: DataFrame, values: list[str], at: str, high: int, size: int) -> DataFrame:
    """Add ``{value}_met``: the last value that isn't NULL of the rows before each row; places run from 0 to ``high``."""
    block = f"{at}_b"
    rows = rows.withColumn(block, F.expr(f"{at} div {size}"))
    earlier = Window.partitionBy(block).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumns({f"{v}_met": F.last(v, ignorenulls=True).over(earlier) for v in values})
    if high < size:
        return found.drop(block)
    ends = rows.groupBy(block).agg(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(at))).alias(v) for v in values])
    carried = _before(ends, values, block, high // size, size)
    carried = carried.select(block, *[F.col(f"{v}_met").alias(f"{v}_far") for v in values])
    found = found.join(carried, block, "left")
    found = found.withColumns({f"{v}_met": F.coalesce(f"{v}_met", f"{v}_far") for v in values})
    return found.drop(block, *[f"{v}_far" for v in values])
