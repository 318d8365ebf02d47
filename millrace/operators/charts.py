"""The aggregates behind charts: bounded rows per chart, whatever the table size."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import rows_of, union_all
from millrace.functions.types import as_number, ref
from millrace.operators.frequency import top_values
from millrace.operators.profiling import bin_index
from millrace.operators.quality import IQR_FACTOR
from millrace.operators.quantiles import column_quantiles
from millrace.operators.summary import column_facts


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    facts = column_facts(df, columns)
    return {c: (facts[c]["min"], facts[c]["max"]) for c in columns if facts[c]["present"]}


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """(column, bin, lower, upper, cnt): equal-width bins, all columns at once."""
    ranges = _ranges(df, columns)
    if not ranges:
        return df.sparkSession.createDataFrame(
            [], "column string, bin bigint, lower double, upper double, cnt bigint"
        )
    records = [
        F.struct(
            F.lit(c).alias("column"),
            bin_index(as_number(df, c), lo, hi, bins).alias("bin"),
            F.lit(float(lo)).alias("low"),
            F.lit((hi - lo) / bins).alias("width"),
        )
        for c, (lo, hi) in ranges.items()
    ]
    cells = (
        df.select(rows_of(records)).filter("bin is not null")
        .groupBy("column", "bin", "low", "width").agg(F.count(F.lit(1)).alias("cnt"))
    )
    return cells.select(
        "column", "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        "cnt",
    )


def boxes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, q1, median, q3, low_whisker, high_whisker, outliers).

    Whiskers are the extreme values within 1.5 IQR of the box.
    """
    cuts = {c: q for c, q in column_quantiles(df, columns, [0.25, 0.5, 0.75]).items() if q[0] is not None}
    if not cuts:
        return df.sparkSession.createDataFrame(
            [], "column string, q1 double, median double, q3 double, "
            "low_whisker double, high_whisker double, outliers bigint",
        )
    parts = []
    for i, (c, (q1, q2, q3)) in enumerate(cuts.items()):
        x, reach = as_number(df, c), IQR_FACTOR * (q3 - q1)
        fair = x.between(q1 - reach, q3 + reach)
        parts.append(
            F.struct(
                F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"),
                F.min(F.when(fair, x)).alias("low_whisker"), F.max(F.when(fair, x)).alias("high_whisker"),
                F.count_if(~fair).alias("outliers"),
            ).alias(f"b{i}")
        )
    return df.agg(*parts).select(rows_of([F.col(f"b{i}") for i in range(len(parts))]))


def bars(df: DataFrame, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """(column, value, cnt): value counts, NULL left out."""
    return top_values(df, columns, k).select("column", "value", "cnt")


def scatter_grids(df: DataFrame, pairs: Sequence[tuple[str, str]], bins: int = 20) -> DataFrame:
    """(x, y, bx, by, cnt): every point of each pair counted in a grid."""
    ranges = _ranges(df, list(dict.fromkeys(c for p in pairs for c in p)))

    def cell(c: str):
        lo, hi = ranges.get(c, (0.0, 0.0))
        return bin_index(as_number(df, c), lo, hi, bins)

    records = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), cell(a).alias("bx"), cell(b).alias("by"))
        for a, b in pairs
    ]
    return (
        df.select(rows_of(records)).filter("bx is not null and by is not null")
        .groupBy("x", "y", "bx", "by").agg(F.count(F.lit(1)).alias("cnt"))
    )


def lines(df: DataFrame, pairs: Sequence[tuple[str, str]], unit: str = "day") -> DataFrame:
    """(x, y, at, mean, low, high, cnt) of y per time step of x."""
    frames = []
    for when in dict.fromkeys(t for t, _ in pairs):
        values = [y for t, y in pairs if t == when]
        step = F.date_trunc(unit, ref(when)).cast("timestamp_ntz")
        grouped = (
            df.filter(ref(when).isNotNull())
            .groupBy(step.alias("at"))
            .agg(
                *[
                    F.struct(
                        F.lit(when).alias("x"), F.lit(y).alias("y"),
                        F.avg(as_number(df, y)).alias("mean"), F.min(as_number(df, y)).alias("low"),
                        F.max(as_number(df, y)).alias("high"), F.count(ref(y)).alias("cnt"),
                    ).alias(f"l{i}")
                    for i, y in enumerate(values)
                ]
            )
        )
        frames.append(grouped.select("at", rows_of([F.col(f"l{i}") for i in range(len(values))])))
    return union_all(frames).select("x", "y", "at", "mean", "low", "high", "cnt")


def chart_specs(roles: DataFrame, max_plots: int = 30) -> list[tuple[int, str, str, str | None]]:
    """(chart_no, kind, x, y) in order: histogram and box per number, bar per
    category, scatter per number pair, line per (time, number); cut at the cap."""
    by_role: dict[str, list[str]] = {}
    for r in roles.collect():
        by_role.setdefault(r["role"], []).append(r["column"])
    nums = by_role.get("numeric", [])
    specs: list[tuple[str, str, str | None]] = []
    for c in nums:
        specs += [("histogram", c, None), ("box", c, None)]
    specs += [("bar", c, None) for c in by_role.get("categorical", [])]
    specs += [("scatter", a, b) for a, b in combinations(nums, 2)]
    specs += [("line", t, y) for t in by_role.get("datetime", []) for y in nums]
    return [(i, *s) for i, s in enumerate(specs[:max_plots])]


def chart_batch(df: DataFrame, roles: DataFrame, max_plots: int = 30, bins: int = 20) -> DataFrame:
    """(chart_no, kind, x, y, bin, value): all charts of a table in one frame.

    Charts of one kind share one scan.
    """
    order = {c: i for i, c in enumerate(df.columns)}
    specs = chart_specs(roles.orderBy(F.create_map(*[F.lit(v) for kv in order.items() for v in kv])[F.col("column")]), max_plots)
    kinds: dict[str, list[tuple[int, str, str | None]]] = {}
    for no, kind, x, y in specs:
        kinds.setdefault(kind, []).append((no, x, y))
    none = F.lit(None).cast("string")
    frames = []

    def add(kind: str, frame: DataFrame, y) -> None:
        numbers = [
            F.when((F.col("x") == x) & (F.col("y").eqNullSafe(F.lit(v))), F.lit(no)) for no, x, v in kinds[kind]
        ]
        shaped = frame.withColumn("y", y)
        frames.append(
            shaped.select(
                F.coalesce(*numbers).alias("chart_no"), F.lit(kind).alias("kind"), "x", "y",
                F.col("bin").cast("string").alias("bin"), F.col("value").cast("double").alias("value"),
            )
        )

    if "histogram" in kinds:
        h = histograms(df, [x for _, x, _ in kinds["histogram"]], bins)
        add("histogram", h.select(F.col("column").alias("x"), "bin", F.col("cnt").alias("value")), none)
    if "box" in kinds:
        b = boxes(df, [x for _, x, _ in kinds["box"]])
        marks = ["q1", "median", "q3", "low_whisker", "high_whisker", "outliers"]
        flat = b.select(
            F.col("column").alias("x"),
            rows_of([F.struct(F.lit(m).alias("bin"), F.col(m).cast("double").alias("value")) for m in marks]),
        )
        add("box", flat, none)
    if "bar" in kinds:
        v = bars(df, [x for _, x, _ in kinds["bar"]])
        add("bar", v.select(F.col("column").alias("x"), F.col("value").alias("bin"), F.col("cnt").alias("value")), none)
    if "scatter" in kinds:
        g = scatter_grids(df, [(x, y) for _, x, y in kinds["scatter"]], bins)
        cell = F.concat_ws(",", F.col("bx"), F.col("by"))
        add("scatter", g.select("x", "y", cell.alias("bin"), F.col("cnt").alias("value")), F.col("y"))
    if "line" in kinds:
        s = lines(df, [(x, y) for _, x, y in kinds["line"]])
        add("line", s.select("x", "y", F.col("at").alias("bin"), F.col("mean").alias("value")), F.col("y"))
    return union_all(frames)
