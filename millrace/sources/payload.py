"""Files that hold one JSON array of objects, cut into records in parallel.

A file is read in pieces that end at a closing brace, by file range as Spark splits it.
Whether a piece begins inside a string depends on what lies before; the first pass tells
for every range, and either state it may begin in, the state it ends in, how the depth
of nesting changes and how low it gets.  A walk over the ranges then gives each its true
beginning, and the second pass cuts ranges into the objects of the array independently.
An object that crosses ranges leaves a part in each; only such parts are shuffled.

Elements of the array that aren't objects are no records.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ship_package
from millrace.sources.sinks import staging_root

END = "}"
_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)


def walk(piece: str, inside: bool, depth: int) -> tuple[bool, int, int, int]:
    """(inside a string, depth, least depth, where an object at depth 1 begins or -1) after a piece and its end."""
    least, begin = depth, -1
    for m in _TOKEN.finditer(piece):
        token = m[0]
        if token == '"':
            inside = not inside
        elif inside or token[0] == "\\":
            continue
        elif token in "{[":
            if token == "{" and depth == 1 and begin < 0:
                begin = m.start()
            depth += 1
        else:
            depth -= 1
            least = min(least, depth)
    if not inside:
        depth -= 1
    return inside, depth, min(least, depth), begin


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("file", "start", "value")), strict=True)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a range and assumed state: what it ends in, the change of depth and the least depth on the way."""
    held, states = None, []

    def rows() -> pa.RecordBatch:
        columns = [[held[0]] * 2, [held[1]] * 2, [False, True], *[list(c) for c in zip(*states, strict=True)]]
        return pa.record_batch([pa.array(c) for c in columns], ["file", "start", "assumed", "inside", "depth", "least"])

    for file, start, piece in _ranges(batches):
        if held != (file, start):
            if held is not None:
                yield rows()
            held, states = (file, start), [(False, 0, 0), (True, 0, 0)]
        moved = [walk(piece, inside, depth) for inside, depth, _ in states]
        states = [(i, d, min(low, before[2])) for (i, d, low, _), before in zip(moved, states, strict=True)]
    if held is not None:
        yield rows()


def _beginnings(effects: list) -> dict[tuple[str, int], tuple[bool, int, int | None]]:
    """(file, range) -> inside a string, depth, and the range in which the open object begins."""
    by_range = {(r["file"], r["start"], r["assumed"]): r for r in effects}
    found, file, inside, depth, owner = {}, None, False, 0, None
    for name, start in sorted({(r["file"], r["start"]) for r in effects}):
        if name != file:
            file, inside, depth, owner = name, False, 0, None
        found[(name, start)] = (inside, depth, owner)
        r = by_range[(name, start, inside)]
        # Between objects the depth is 1 or less.
        if owner is None or depth + r["least"] <= 1:
            owner = start
        inside, depth = r["inside"], depth + r["depth"]
        if depth <= 1:
            owner = None
    return found


def _objects(beginnings: dict[tuple[str, int], tuple[bool, int, int | None]]) -> Callable:
    """Whole objects, and parts (with the range of their object's beginning) of those that cross ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owner, inside, depth, parts, open_, out = None, None, False, 0, [], False, []

        def left() -> list[tuple]:
            return [(*held, held[1] if owner is None else owner, END.join(parts) + END)] if open_ and parts else []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "owner", "record"])

        for file, start, piece in _ranges(batches):
            if held != (file, start):
                out += left()
                held, parts = (file, start), []
                inside, depth, owner = beginnings[(file, start)]
                open_ = owner is not None
            inside, depth, _, begin = walk(piece, inside, depth)
            if open_:
                parts.append(piece)
            elif begin >= 0:
                open_, parts = True, [piece[begin:]]
            if open_ and not inside and depth <= 1:
                out.append((file, start, owner, END.join(parts) + END))
                open_, owner, parts = False, None, []
            if len(out) >= 10_000:
                yield batch()
                out = []
        out += left()
        yield batch()

    return run


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", END).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def holds_array(spark: SparkSession, path: str) -> bool:
    """Whether the (first) file begins with an array; one piece comes to the driver."""
    first = _pieces(spark, path).select(F.ltrim(F.translate(F.substring("value", 1, 1000), "\r\n\t\ufeff", "   ")).startswith("[").alias("found")).first()
    return bool(first and first["found"])


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(record): the objects of the files' arrays as texts.

    Two rows for each file range come to the driver, one goes to every task.
    """
    ship_package(spark)
    pieces = _pieces(spark, path)
    effects = pieces.mapInArrow(_effects, "file string, start long, assumed boolean, inside boolean, depth long, least long").collect()
    cut = pieces.mapInArrow(_objects(_beginnings(effects)), "file string, start long, owner long, record string")
    parts = cut.filter("owner IS NOT NULL").groupBy("file", "owner")
    joined = parts.agg(F.array_join(F.array_sort(F.collect_list(F.struct("start", "record")))["record"], "").alias("record"))
    return cut.filter("owner IS NULL").select("record").unionByName(joined.select("record"))


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """The objects as rows, typed by Spark's JSON reader from one object a line."""
    lines = read_objects(spark, path).select(F.translate("record", "\r\n", "  ").alias("value"))
    out = f"{staging_root(spark)}/millrace/objects-{uuid.uuid4().hex}"
    lines.write.text(out)
    return spark.read.json(out)
