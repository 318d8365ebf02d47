"""Vector codes by product quantization, with LAESA pivots.

A vector is cut into equal consecutive parts; each part position has a codebook of
integer entries that k-means rounds move.  The distances of every part to a few
fixed pivots (entries of the first codebook, far from each other) are computed once
and kept with the vectors.  In every round the distances from pivots to the moved
entries give, by the triangle inequality, a lower bound for each part and entry;
entries are tried in the order of their bounds, and one whose bound can't beat the
best distance so far is never evaluated.  Distances are whole numbers and exact.

A round is one pass over the kept vectors; each task returns sums by part, entry and
place, which Spark adds up; the driver receives one codebook's worth of numbers.

Defined results: components become floor(scale * x), the nearest 64-bit integer
beyond that; vectors that are null or hold a null or a component that isn't finite
are dropped; rows that repeat count each, but an id that repeats gives the first
codebook one entry, its smallest vector; rows without an id never give one; with
fewer ids than entries the codebooks are shorter; if the length isn't a multiple of
the parts, cuts are at floor(i * length / parts); vectors of another length than the
smallest id's get neither code nor error and move no entry; an error beyond 64 bits
is the largest 64-bit integer; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import named_again, plain_names
from millrace.sources.sinks import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Fixed pivots a part position.
PIVOTS = 4
#: Rows whose bounds a task holds at once.
SLICE_ROWS = 4096
_MOST = 2**63 - 1
#: Pivot distances beyond this are kept as this; the bounds stay valid.
_FAR = 2**62


def cells(embedding: str, scale: int = SCALE) -> tuple[F.Column, F.Column]:
    """(condition for a vector to be kept, its integer components)."""
    values = F.transform(F.col(embedding), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(embedding).isNotNull() & finite, F.transform(values, lambda x: F.floor(x * F.lit(float(scale))))


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Where each part begins and ends."""
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


def _isqrt(squares: np.ndarray) -> np.ndarray:
    """The whole part of each square root, at most ``_FAR``."""
    if squares.dtype == object:
        flat = [min(math.isqrt(x), _FAR) for x in squares.ravel()]
        return np.array(flat, np.int64).reshape(squares.shape)
    roots = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    roots -= roots * roots > squares
    return roots + ((roots + 1) * (roots + 1) <= squares)


def _distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every entry."""
    out = np.zeros((len(rows), len(entries)), rows.dtype)
    for e, entry in enumerate(entries):
        apart = rows - entry
        out[:, e] = (apart * apart).sum(1)
    return out


def _held(rows: np.ndarray, most: int) -> np.ndarray:
    """The rows as 64-bit integers if squared distances fit, else as Python's."""
    size = max(most, int(np.abs(rows.astype(np.float64)).max(initial=0)))
    fits = max(1, rows.shape[1]) * (2 * size) ** 2 < 2**61
    return rows if fits else rows.astype(object)


def pick_pivots(entries: np.ndarray, pivots: int) -> np.ndarray:
    """Entries far from each other: the first, then whichever is farthest from those picked."""
    if not len(entries):
        return entries
    rows = entries.astype(object)
    picked, nearest = [0], _distances(rows, rows[:1])[:, 0]
    while len(picked) < min(pivots, len(entries)):
        picked.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, _distances(rows, rows[picked[-1:]])[:, 0])
    return entries[picked]


def nearest(rows: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, squared distance) of each row, ties to the lower index, and how many distances that took.

    ``to_pivots`` has the whole part of every row's distance to each pivot.  If those
    of a row and of an entry differ by x, the row is more than x - 1 from the entry.
    """
    most = int(np.abs(entries.astype(np.float64)).max(initial=0))
    rows = _held(rows, most)
    entries = entries.astype(rows.dtype)
    own = _isqrt(_distances(entries, pivots.astype(rows.dtype)))
    bound = np.zeros((len(rows), len(entries)), np.int64)
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - own[None, :, p]) - 1, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    # Squares of bounds as doubles, rounded down: never more than the true ones.
    least = np.square(bound.astype(np.float64)) * (1 - 1e-12)
    best = np.full(len(rows), 2**62 if rows.dtype != object else 2**200, rows.dtype)
    who = np.full(len(rows), len(entries), np.int64)
    open_, evaluated = np.arange(len(rows)), 0
    for r in range(len(entries)):
        tried = order[open_, r]
        # Beyond its bound a distance is strictly larger, so it can't even tie.
        reach = (bound[open_, tried] == 0) | (least[open_, tried] < best[open_].astype(np.float64) * (1 + 1e-12))
        open_, tried = open_[reach], tried[reach]
        if not len(open_):
            break
        evaluated += len(open_)
        apart = rows[open_] - entries[tried]
        found = (apart * apart).sum(1)
        better = (found < best[open_]) | ((found == best[open_]) & (tried < who[open_]))
        best[open_[better]], who[open_[better]] = found[better], tried[better]
    return who, best, evaluated


def _matrices(batch: pa.RecordBatch, length: int, column: str = "cells") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of a batch: places of the rows of this length, and their components."""
    sizes = pa.compute.list_value_length(batch[column]).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(sizes == length)
    for i in range(0, len(places), SLICE_ROWS):
        some = places[i : i + SLICE_ROWS]
        flat = batch[column].take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
        yield some, flat.astype(np.int64).reshape(len(some), length)


def _measure(length: int, parts: int, pivots: list[np.ndarray]) -> Callable:
    """Adds ``to_pivots``: the whole part of every part's distance to its position's pivots."""
    where = cuts(length, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = [None] * len(batch)
            for places, rows in _matrices(batch, length):
                found = []
                for (a, b), some in zip(where, pivots, strict=True):
                    part = _held(rows[:, a:b], int(np.abs(some.astype(np.float64)).max(initial=0)))
                    found.append(_isqrt(_distances(part, some.astype(part.dtype))))
                for place, row in zip(places, np.concatenate(found, 1), strict=True):
                    out[place] = row
            yield batch.append_column("to_pivots", pa.array(out, pa.list_(pa.int64())))

    return run


def _assigned(batch: pa.RecordBatch, length: int, books: list[np.ndarray], pivots: list[np.ndarray]) -> Iterator[tuple]:
    """Slices of a batch: places, and for each part its rows, nearest entries and distances."""
    where, width = cuts(length, len(books)), len(pivots[0])
    for places, rows in _matrices(batch, length):
        known = batch["to_pivots"].take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        known = known.reshape(len(places), len(books), width)
        each = []
        for i, (a, b) in enumerate(where):
            who, far, _ = nearest(rows[:, a:b], known[:, i], books[i], pivots[i])
            each.append((rows[:, a:b], who, far))
        yield places, each


def _sums(length: int, books: list[np.ndarray], pivots: list[np.ndarray]) -> Callable:
    """One row per part, entry and place that this task's vectors use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(book.shape, object) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            for _, each in _assigned(batch, length, books, pivots):
                for i, (rows, who, _) in enumerate(each):
                    rows = _held(rows, 0)
                    for e in np.unique(who):
                        mine = rows[who == e]
                        counts[i][e] += len(mine)
                        totals[i][e] += mine.sum(0).astype(object)
        found = [
            (i, int(e), place, Decimal(int(x)), int(counts[i][e]))
            for i in range(len(books))
            for e in np.flatnonzero(counts[i])
            for place, x in enumerate(totals[i][e])
        ]
        if found:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.record_batch(columns, ["part", "entry", "place", "total", "n"])

    return run


def _codes(length: int, books: list[np.ndarray], pivots: list[np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list = [None] * len(batch)
            errors: list = [None] * len(batch)
            for places, each in _assigned(batch, length, books, pivots):
                for k, place in enumerate(places):
                    codes[place] = "".join(f"{who[k]:02x}" for _, who, _ in each)
                    errors[place] = min(sum(int(far[k]) for _, _, far in each), _MOST)
            rest = batch.drop_columns(["cells", "to_pivots"])
            yield rest.append_column("code", pa.array(codes, pa.string())).append_column("error", pa.array(errors, pa.int64()))

    return run


def _first_entries(kept: DataFrame, vec_id: str, entries: int) -> list[list[int]]:
    """The smallest vector of each of the smallest ids; at most ``entries`` rows a look come to the driver."""
    starts: list[list[int]] = []
    asked, last = kept.filter(F.col(vec_id).isNotNull()).select(vec_id, "cells"), None
    while len(starts) < entries:
        rest = asked if last is None else asked.filter(F.col(vec_id) > F.lit(last))
        found = rest.orderBy(vec_id, "cells").limit(entries).collect()
        if not found:
            break
        for row in found:
            if last is None or row[vec_id] != last:
                starts.append(row["cells"])
                last = row[vec_id]
    return starts[:entries]


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Of all entries' components by part, entry and place, comma-joined."""
    numbers = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """The kept rows with their other columns, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` in place of the vector."""
    plain, names = plain_names(vectors)
    keep, whole = cells(names[embedding], scale)
    spark = vectors.sparkSession
    kept = plain.filter(keep).withColumn("cells", whole).drop(names[embedding])
    own = [c for c in kept.columns if c != "cells"]
    starts = _first_entries(kept, names[vec_id], entries)
    length = len(starts[0]) if starts else 0
    starts = [s for s in starts if len(s) == length]
    first = np.array(starts, np.int64).reshape(len(starts), length)
    books = [first[:, a:b] for a, b in cuts(length, parts)]
    pivots = [pick_pivots(book, PIVOTS) for book in books]
    measured = T.StructType([*kept.schema.fields, T.StructField("to_pivots", T.ArrayType(T.LongType()))])
    if starts:
        table = stage(kept.mapInArrow(_measure(length, parts, pivots), measured), "measured")
        schema = "part int, entry int, place int, total decimal(38,0), n long"
        for _ in range(rounds):
            sums = table.mapInArrow(_sums(length, books, pivots), schema)
            moved = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
            books = [book.copy() for book in books]
            for row in moved.collect():
                books[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
        made = T.StructType([kept.schema[c] for c in own]).add("code", "string").add("error", "long")
        coded = stage(table.mapInArrow(_codes(length, books, pivots), made), "coded")
    else:
        coded = kept.select(*own, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(total > _MOST, F.lit(_MOST)).otherwise(total.cast("long"))
    sums = stage(coded.groupBy(F.col(names[label]).alias("of")).agg(total.alias("label_error")), "label_errors")
    found = coded.join(sums, coded[names[label]].eqNullSafe(sums["of"]), "left")
    found = found.withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))
    names.pop(embedding)
    return named_again(found, names, **{c: c for c in ("code", "error", "label_error", "codebooks_sha256")})
