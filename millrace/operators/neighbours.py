"""Mutual information by nearest neighbours (the first estimator of Kraskov and others).

For every row, r is the distance to its k-th nearest other row in the larger of both
coordinates' differences; the estimate compares how many rows lie within r by either
coordinate alone.  Rows that are equal in both coordinates are one weighted point.

Points are dealt by range into strips of bounded size.  Each strip is swept along its
more varied axis, until no further point can be among a point's k nearest.  A point
whose k-th distance reaches into other strips is looked up there as well, which makes
the distance exact.  A strip is known by up to three boxes, since one that ends a value
of x and begins the next has y far apart, and its whole box would be in reach of every
point of both.  The counts by one coordinate come from its values, dealt by range with
the rows before each block, so that a count is the difference of two places.  A strip or
a block is given to as many tasks as its questions need, since a coordinate of few values
has as many questions as one of many; a small table of values goes to the points instead.

Defined results: missing values count as 0; both sides are divided by their standard
deviation, a constant by 1; nothing random is added, so ties are ties: a row with k
equal ones has r = 0 and counts the rows of its own value; an estimate below 0 is 0;
with k rows or fewer it is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import types as ty
from millrace.functions.expressions import union_all
from millrace.functions.types import as_number
from millrace.operators.summary import column_facts
from millrace.session import ship_package
from millrace.sources.sinks import stage

K = 3
#: Points in a strip, and distinct values in a block of one coordinate.
STRIP_POINTS = 100_000
#: Distinct values of one coordinate that are sent to all tasks instead (160 KB).
TABLE_VALUES = 10_000
#: Questions that a task holds at once, beside the values of their block or the points of their strip.
ASKED_ROWS = 500_000
#: Points that look for other strips at once.
REACH_ROWS = 1_000


def nearest_distances(
    px: np.ndarray, py: np.ndarray, weight: np.ndarray, qx: np.ndarray, qy: np.ndarray, bound: np.ndarray, k: int, own: bool
) -> np.ndarray:
    """(query, k): the k smallest distances below each query's bound, repeated by weight, filled with the bound.

    With ``own``, queries are the points themselves, and don't count once.
    """
    if len(np.unique(px)) >= len(np.unique(py)):
        a, b, qa, qb = px, py, qx, qy
    else:
        a, b, qa, qb = py, px, qy, qx
    order = np.lexsort((b, a))
    a, b, weight = a[order], b[order], weight[order]
    if own:
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
    else:
        place = np.searchsorted(a, qa)
    best = np.repeat(bound[:, None], k, 1).astype(np.float64)

    def take(rows: np.ndarray, distance: np.ndarray, times: np.ndarray) -> None:
        near = distance < best[rows, -1]
        rows, distance, times = rows[near], distance[near], times[near]
        if len(rows):
            more = np.where(np.arange(k)[None, :] < times[:, None], distance[:, None], np.inf)
            best[rows] = np.sort(np.concatenate([best[rows], more], 1), 1)[:, :k]

    if own:
        everyone = np.arange(len(qa))
        take(everyone, np.zeros(len(qa)), weight[place] - 1)
    for step, first in ((1, place + own), (-1, place - 1)):
        rows, at = np.arange(len(qa)), first.copy()
        while True:
            going = (at >= 0) & (at < len(a))
            rows, at = rows[going], at[going]
            going = np.abs(a[at] - qa[rows]) < best[rows, -1]
            rows, at = rows[going], at[going]
            if not len(rows):
                break
            take(rows, np.maximum(np.abs(a[at] - qa[rows]), np.abs(b[at] - qb[rows])), weight[at])
            at = at + step
    return best


def _columns(table: pa.Table | pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy() if isinstance(table, pa.Table) else table[n].to_numpy(zero_copy_only=False) for n in names]


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel(), pa.float64()))


def _within(k: int) -> Callable:
    """Every point's k smallest distances within its strip."""

    def run(table: pa.Table) -> pa.Table:
        x, y, w = _columns(table, "x", "y", "w")
        found = nearest_distances(x, y, w, x, y, np.full(len(x), np.inf), k, own=True)
        return table.append_column("d", _lists(found))

    return run


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) for every place from first up to last of a row."""
    spans = np.maximum(last - first, 0)
    row = np.repeat(np.arange(len(first)), spans)
    return row, np.repeat(first, spans) + np.arange(len(row)) - np.repeat(np.cumsum(spans) - spans, spans)


def _places(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, beyond: bool) -> np.ndarray:
    """The first place from low up to high whose value reaches what is wanted, or lies beyond it."""
    low, high = low.copy(), high.copy()
    while (low < high).any():
        middle = np.minimum((low + high) // 2, len(values) - 1)
        there = values[middle] > wanted if beyond else values[middle] >= wanted
        open_ = low < high
        high = np.where(open_ & there, middle, high)
        low = np.where(open_ & ~there, middle + 1, low)
    return low


def _reached(boxes: np.ndarray) -> Callable:
    """Which boxes a point's distance reaches into; ``boxes`` has a row (strip, x from, to, y from, to) for each.

    Boxes follow each other by x, those of one single x by y: such a run is searched by
    halves, so that a point looks at the boxes it meets only.
    """
    _, x_from, x_to, y_from, y_to = boxes.T
    follows = (x_from[1:] == x_to[1:]) & (x_from[:-1] == x_from[1:]) & (x_to[:-1] == x_to[1:])
    begins = np.flatnonzero(np.concatenate([[True], ~follows]))
    ends = np.append(begins[1:], len(boxes))

    def run(x: np.ndarray, y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, at = _spread(np.searchsorted(x_to[begins], x - r, "left"), np.searchsorted(x_from[begins], x + r, "right"))
        first = _places(y_to, begins[at], ends[at], y[row] - r[row], beyond=False)
        last = _places(y_from, begins[at], ends[at], y[row] + r[row], beyond=True)
        pair, other = _spread(first, last)
        return row[pair], other

    return run


def _outward(boxes: np.ndarray, k: int) -> Callable:
    """(strip, id, x, y, r) for every other strip that a point's distance reaches into.

    Nothing is nearer than 0: points with k equal rows don't ask.
    """
    strips = int(boxes[:, 0].max()) + 1 if len(boxes) else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = _reached(boxes)
        for batch in (b.slice(i, REACH_ROWS) for b in batches for i in range(0, b.num_rows, REACH_ROWS)):
            strip, ids, x, y = _columns(batch, "strip", "id", "x", "y")
            r = batch["d"].flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[:, -1]
            asks = r > 0
            strip, ids, x, y, r = (c[asks] for c in (strip, ids, x, y, r))
            row, other = reached(x, y, r)
            other = boxes[other, 0].astype(np.int64)
            others = other != strip[row]
            # A point may reach into several boxes of a strip.
            row, other = np.divmod(np.unique(row[others] * strips + other[others]), strips)
            if len(row):
                made = [other.astype(np.int32), ids[row], x[row], y[row], r[row]]
                yield pa.record_batch([pa.array(m) for m in made], ["strip", "id", "x", "y", "r"])

    return run


def _elsewhere(k: int) -> Callable:
    """The distances below the bound asked for."""

    def run(asked: pa.Table, points: pa.Table) -> pa.Table:
        if not len(asked) or not len(points):
            return pa.table({"id": pa.array([], pa.int64()), "e": pa.array([], pa.float64())})
        ids, qx, qy, r = _columns(asked, "id", "x", "y", "r")
        x, y, w = _columns(points, "x", "y", "w")
        found = nearest_distances(x, y, w, qx, qy, r, k, own=False)
        # Distances are filled with the bound, which is no distance of its own.
        row, place = np.nonzero(found < r[:, None])
        return pa.table({"id": pa.array(ids[row]), "e": pa.array(found[row, place])})

    return run


def _last_true(values: np.ndarray, near: np.ndarray, test: Callable) -> np.ndarray:
    """How many leading values pass a test that no later one does; ``near`` is a first guess."""
    n = near.copy()
    while True:
        more = (n < len(values)) & test(values[np.minimum(n, len(values) - 1)])
        less = (n > 0) & ~test(values[np.maximum(n, 1) - 1])
        if not (more | less).any():
            return n
        n = n + more - (less & ~more)


def _edges(axis: str, firsts: np.ndarray, parts: np.ndarray | None = None) -> Callable:
    """A point's questions: rows up to value + r, less rows below value - r; each to the block that knows.

    If one block knows both, that is one question without an id.  With ``parts``, the
    questions of a block are dealt to so many groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, v, w, r = _columns(batch, "id", axis, "w", "r")
            upper = _last_true(firsts, np.searchsorted(firsts, v + r, "right"), lambda f, v=v, r=r: f - v <= r) - 1
            lower = _last_true(firsts, np.searchsorted(firsts, v - r, "left"), lambda f, v=v, r=r: v - f > r) - 1
            both = upper == np.maximum(lower, 0)
            for sign, some, blocks in ((0, both, upper), (1, ~both, upper), (-1, ~both & (lower >= 0), lower)):
                at = blocks[some]
                part = np.zeros(len(at), np.int64) if parts is None else ids[some] % parts[at]
                made = [pa.array(at.astype(np.int32)), pa.array(part.astype(np.int32))]
                made.append(pa.nulls(len(at), pa.int64()) if sign == 0 else pa.array(ids[some]))
                # The weight travels with one of two questions.
                made += [pa.array(v[some]), pa.array(w[some] * (sign >= 0)), pa.array(r[some]), pa.array(np.full(len(at), sign, np.int64))]
                yield pa.record_batch(made, ["block", "part", "id", "v", "w", "r", "sign"])

    return run


def _up_and_down(have: np.ndarray, total: np.ndarray, v: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows up to v + r, and rows below v - r; ``total`` has the rows before each of the values, and all of them."""
    up = _last_true(have, np.searchsorted(have, v + r, "right"), lambda f: f - v <= r)
    down = _last_true(have, np.searchsorted(have, v - r, "left"), lambda f: v - f > r)
    return total[up], total[down]


def _tally(n: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each count once, with the weights of its points."""
    each, at = np.unique(n, return_inverse=True)
    sums = np.zeros(len(each), np.int64)
    np.add.at(sums, at, w)
    return each, sums


def _counts(before: np.ndarray) -> Callable:
    """(id, n, w): of both questions a tally without ids, else a row with the one question's share."""

    def run(asked: pa.Table, values: pa.Table) -> pa.Table:
        if not len(asked):
            return pa.table({"id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "w": pa.array([], pa.int64())})
        block, w, sign, v, r = _columns(asked, "block", "w", "sign", "v", "r")
        have, times = _columns(values.sort_by("v"), "v", "w")
        up, down = _up_and_down(have, np.concatenate([[0], np.cumsum(times)]), v, r)
        whole = sign == 0
        n, sums = _tally((up - down)[whole], w[whole])
        shares = (sign * (before[block] + np.where(sign > 0, up, down)))[~whole]
        ids = asked["id"].combine_chunks().filter(pa.array(~whole))
        ids = pa.concat_arrays([pa.nulls(len(n), pa.int64()), ids])
        return pa.table({"id": ids, "n": np.concatenate([n, shares]), "w": np.concatenate([sums, w[~whole]])})

    return run


def _counts_in_table(axis: str, have: np.ndarray, total: np.ndarray) -> Callable:
    """(n, w) as tallied from a table of all values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, w, r = _columns(batch, axis, "w", "r")
            up, down = _up_and_down(have, total, v, r)
            yield pa.record_batch([pa.array(m) for m in _tally(up - down, w)], ["n", "w"])

    return run


def _by_range(points: DataFrame, rows: int, name: str, *by: str) -> DataFrame:
    """The rows with the number of their range, ranges following each other."""
    cores = points.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, -(-rows // 1000)), -(-rows // STRIP_POINTS), 1)
    return points.repartitionByRange(parts, *by).withColumn(name, F.spark_partition_id())


def _margin(found: DataFrame, values: DataFrame, axis: str) -> DataFrame:
    """(n, w): how many points, by weight, have n rows whose value on the axis differs by no more than r.

    ``values`` has each value of the axis and its rows.
    """
    spark = found.sparkSession
    distinct = values.count()
    if distinct <= TABLE_VALUES:
        have, times = (np.array(c) for c in zip(*values.orderBy("v").collect(), strict=True))
        run = _counts_in_table(axis, have, np.concatenate([[0], np.cumsum(times)]))
        return found.select(axis, "w", "r").mapInArrow(run, "n long, w long")
    values = stage(_by_range(values, distinct, "block", "v"), "blocks")
    blocks = values.groupBy("block").agg(F.min("v").alias("first"), F.sum("w").alias("w")).orderBy("first").collect()
    firsts = np.array([b["first"] for b in blocks])
    before = np.cumsum([0] + [b["w"] for b in blocks])[:-1]
    schema = "block int, part int, id long, v double, w long, r double, sign long"
    points = found.select("id", axis, "w", "r")
    sizes = points.mapInArrow(_edges(axis, firsts), schema).groupBy("block").count().collect()
    parts = np.ones(len(blocks), np.int64)
    for row in sizes:
        parts[row["block"]] = -(-row["count"] // ASKED_ROWS)
    places = [(b["block"], i, int(parts[i])) for i, b in enumerate(blocks)]
    places = spark.createDataFrame(places, "block int, place int, parts int")
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    values = values.join(F.broadcast(places), "block").select(F.col("place").alias("block"), part, "v", "w")
    asked = points.mapInArrow(_edges(axis, firsts, parts), schema)
    answers = asked.groupBy("block", "part").cogroup(values.groupBy("block", "part"))
    answers = answers.applyInArrow(_counts(before), "id long, n long, w long")
    answers = answers.groupBy("id", F.when(F.col("id").isNull(), F.col("n")).alias("whole"))
    answers = answers.agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    return answers.select(F.coalesce("whole", "n").alias("n"), "w")


def _digamma(n: Column) -> Column:
    """Of whole numbers from 1, by the series of n + 6."""
    z = n.cast("double") + 6
    series = F.log(z) - 1 / (2 * z) - 1 / (12 * z**2) + 1 / (120 * z**4) - 1 / (252 * z**6)
    for i in range(6):
        series = series - 1 / (n.cast("double") + i)
    return series


def _values(points: DataFrame, axis: str) -> DataFrame:
    """(v, w): each value of the axis and its rows."""
    return stage(points.groupBy(F.col(axis).alias("v")).agg(F.sum("w").alias("w")), "values")


def _boxes(points: DataFrame) -> np.ndarray:
    """Rows (strip, x from, to, y from, to): boxes of a strip's first x, of its last, and of what lies between."""
    ends = points.groupBy("strip").agg(F.min("x").alias("first"), F.max("x").alias("last"))
    box = [f(c).alias(f"{f.__name__}_{c}") for c in ("x", "y") for f in (F.min, F.max)]
    piece = F.when(F.col("x") == F.col("first"), 0).when(F.col("x") == F.col("last"), 2).otherwise(1)
    boxes = points.join(F.broadcast(ends), "strip").groupBy("strip", piece.alias("piece")).agg(*box).drop("piece")
    return np.array([tuple(r) for r in boxes.orderBy("min_x", "max_x", "min_y").collect()], np.float64).reshape(-1, 5)


def _radii(points: DataFrame, size: int, k: int) -> DataFrame:
    """(id, x, y, w, r): the points with what is just below the distance to the k-th other row."""
    points = stage(_by_range(points, size, "strip", "x", "y").withColumn("id", F.monotonically_increasing_id()), "strips")
    boxes = _boxes(points)
    schema = "strip int, id long, x double, y double, w long, d array<double>"
    own = points.select("strip", "id", "x", "y", "w").groupBy("strip").applyInArrow(_within(k), schema)
    own = stage(own, "own")
    asked = stage(own.mapInArrow(_outward(boxes, k), "strip int, id long, x double, y double, r double"), "asked")
    parts = [(r["strip"], -(-r["count"] // ASKED_ROWS)) for r in asked.groupBy("strip").count().collect()]
    parts = F.broadcast(points.sparkSession.createDataFrame(parts, "strip int, parts int"))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    held = points.join(parts, "strip").select("strip", part, "x", "y", "w")
    asked = asked.join(parts, "strip").select("strip", (F.col("id") % F.col("parts")).cast("int").alias("part"), "id", "x", "y", "r")
    others = asked.groupBy("strip", "part").cogroup(held.groupBy("strip", "part")).applyInArrow(_elsewhere(k), "id long, e double")
    # Few points find nearer ones elsewhere; written out, Spark knows how few.
    more = stage(others.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("e")), 1, k).alias("more")), "more")
    all_d = F.array_sort(F.concat("d", F.coalesce("more", F.array().cast("array<double>"))))
    found = own.join(more, "id", "left").select("id", "x", "y", "w", F.element_at(all_d, k).alias("r"))
    # Strictly within the k-th distance, as far as doubles tell.
    return stage(found.mapInArrow(_just_below, "id long, x double, y double, w long, r double"), "radii")


def _information(pairs: DataFrame, k: int) -> DataFrame:
    """(mi) of a table (x, y) without missing values."""
    points = pairs.groupBy("x", "y").agg(F.count("*").alias("w"))
    points = stage(points, "points")
    size = points.agg(F.sum("w").alias("rows"), F.count("*").alias("points")).first()
    if (size["rows"] or 0) <= k:
        return pairs.sparkSession.createDataFrame([(None,)], "mi double")
    found = _radii(points, size["points"], k)
    counts = union_all([_margin(found, _values(points, axis), axis) for axis in ("x", "y")])
    mean = F.sum(F.col("w") * _digamma(F.col("n"))) / F.lit(size["rows"])
    whole = [_digamma(F.lit(n)) for n in (size["rows"], k)]
    return counts.agg(mean.alias("mean")).select(F.greatest(F.lit(0.0), whole[0] + whole[1] - F.col("mean")).alias("mi"))


def _just_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r = np.nextafter(_columns(batch, "r")[0], 0)
        yield batch.set_column(batch.schema.get_field_index("r"), "r", pa.array(r))


def neighbour_information(df: DataFrame, target: str | None = None, columns: Sequence[str] | None = None, k: int = K) -> DataFrame:
    """(feature, mi): nearest-neighbour mutual information in nats with ``target``.

    The target defaults to the first numeric column.  The driver receives a row for
    each strip and block, and up to ``TABLE_VALUES`` distinct values of a coordinate;
    broadcasts are as small.
    """
    nums = ty.number_columns(df)
    target = target or nums[0]
    names = [c for c in (columns if columns is not None else nums) if c != target]
    ship_package(df.sparkSession)
    filled = df.select(*[F.coalesce(as_number(df, c), F.lit(0.0)).alias(f"c{i}") for i, c in enumerate([target, *names])])
    facts = column_facts(filled, filled.columns)
    scale = [facts[c]["std_pop"] if facts[c]["varies"] else 1.0 for c in filled.columns]
    found = []
    for i, name in enumerate(names, 1):
        pairs = filled.select((F.col(f"c{i}") / F.lit(scale[i])).alias("x"), (F.col("c0") / F.lit(scale[0])).alias("y"))
        found.append((name, _information(pairs, k).first()["mi"]))
    return df.sparkSession.createDataFrame(found, "feature string, mi double")
