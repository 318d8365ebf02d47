"""Delimited files whose quoted fields hold line breaks, read in parallel.

Lines are read by file range, as Spark splits the files.  Whether a line begins inside
a quoted field depends on all lines before it, so a first pass tells for every range
what it does to either state; one small walk over the ranges then gives the state each
of them begins in.  In the second pass ranges are cut into records independently.  A
record that crosses ranges leaves one piece in each; only such pieces are shuffled.

Defined results, as in Python's ``csv``: a quote opens a field at its start only; two
quotes within a quoted field are one; records end with a line feed, with or without a
carriage return before it; breaks within quotes stay as they are; empty lines are no
records; a field left open at the end of a file ends there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.sqltext import name_sql
from millrace.session import ship_package

QUOTE, COMMA = '"', ","


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is still open after a line, given the state before it."""
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside = False
        elif line.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = line.find(COMMA, at) + 1
        if not at:
            return False


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """(file, range, some of its lines); lines of a range come together and in order."""
    for batch in batches:
        file, start, lines = (batch[c].to_pylist() for c in ("file", "start", "value"))
        first = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or (file[i], start[i]) != (file[first], start[first]):
                yield file[first], start[first], lines[first:i]
                first = i


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: the state it leaves for either it may begin in, and if an open field is closed."""
    held, state = None, [False, True, False]

    def row() -> pa.RecordBatch:
        columns = [[held[0]], [held[1]], *[[x] for x in state]]
        return pa.record_batch([pa.array(c) for c in columns], ["file", "start", "if_outside", "if_inside", "closes"])

    for file, start, lines in _ranges(batches):
        if held != (file, start):
            if held is not None:
                yield row()
            held, state = (file, start), [False, True, False]
        for line in lines:
            if QUOTE in line:
                state[:2] = ends_inside(line, state[0]), ends_inside(line, state[1])
            state[2] |= not state[1]
    if held is not None:
        yield row()


def _open_ranges(effects: list) -> dict[tuple[str, int], int]:
    """(file, range) that begin within a record -> the range in which that record begins."""
    found, file, inside, owner = {}, None, False, 0
    for r in sorted(effects, key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, inside = r["file"], False
        if inside:
            found[(file, r["start"])] = owner
        if not inside or r["closes"]:
            owner = r["start"]
        inside = r["if_inside"] if inside else r["if_outside"]
    return found


def _records(opened: dict[tuple[str, int], int]) -> Callable:
    """Whole records, and pieces (with the range of their record's beginning) of those that cross ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owner, inside, piece, out = None, None, False, [], []

        def left() -> list[tuple]:
            """What is left open at the end of a range."""
            if not piece:
                return []
            return [(held[0], held[1], owner if owner is not None else held[1], False, "\n".join(piece))]

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "owner", "first", "record"])

        for file, start, lines in _ranges(batches):
            fresh = held != (file, start)
            if fresh:
                out += left()
                held, owner, piece = (file, start), opened.get((file, start)), []
                inside = owner is not None
            header = fresh and start == 0
            for line in lines:
                inside = ends_inside(line, inside) if QUOTE in line else inside
                piece.append(line)
                if not inside:
                    record = "\n".join(piece).removesuffix("\r")
                    if record or owner is not None:
                        out.append((held[0], held[1], owner, header, record))
                        header = False
                    piece, owner = [], None
            if len(out) >= 10_000:
                yield batch()
                out = []
        out += left()
        yield batch()

    return run


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, record): every record as one text; ``first`` marks a file's first one.

    One row for each range that begins within a record is sent to the tasks; the
    driver receives one row for each range.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    effects = lines.mapInArrow(_effects, "file string, start long, if_outside boolean, if_inside boolean, closes boolean")
    opened = _open_ranges(effects.collect())
    cut = lines.mapInArrow(_records(opened), "file string, start long, owner long, first boolean, record string")
    whole = cut.filter("owner IS NULL").select("first", "record")
    if not opened:
        return cut.select("first", "record")
    pieces = cut.filter("owner IS NOT NULL").groupBy("file", "owner")
    ordered = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = pieces.agg(F.bool_or("first").alias("first"), F.regexp_replace(F.array_join(ordered["record"], "\n"), "\r$", "").alias("record"))
    return whole.unionByName(joined.select("first", "record"))


def has_broken_records(spark: SparkSession, path: str) -> bool:
    """Whether any line leaves a quoted field open: the lines with an odd number of quotes are looked at."""
    lines = spark.read.option("lineSep", "\n").text(path)
    odd = (F.length("value") - F.length(F.translate("value", QUOTE, ""))) % 2 == 1
    return not lines.filter(odd).isEmpty()


def read_delimited(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of files with a header record; without a schema all columns are text."""
    records = read_records(spark, path)
    options = {"escape": QUOTE, "quote": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
    if schema is None:
        head = records.filter("first").select("record").first()
        names = _header(spark, head["record"] if head else "")
        schema = ", ".join(f"{name_sql(n)} string" for n in names)
    rows = records.filter("NOT first").select(F.from_csv("record", F.lit(schema), options).alias("row"))
    return rows.select("row.*")


def _header(spark: SparkSession, record: str) -> list[str]:
    """Column names as Spark's reader gives them; it is handed the one record."""
    import csv
    import io

    names = next(csv.reader(io.StringIO(record)), [])
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    return [f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names)]
