"""The order rows have in their files, as a column.

Files follow each other by path; rows are numbered from 0 without gaps, the same
whether a table lies in one file or in many.  Nothing is sorted or shuffled: a row's
place within its file range is the order in which Spark reads it, and one small table
with a row for each range tells how many rows lie before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import free_name


def number_rows(raw: DataFrame, position: str = "position") -> DataFrame:
    """Add each row's number; ``raw`` comes straight from a file reader.

    One row for each file range comes to the driver and goes to every task.
    """
    if position in raw.columns:
        raise ValueError(f"the table already has a column {position!r}")
    file, start, place = (free_name(raw, n) for n in ("file", "start", "place"))
    names = [F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(start)]
    placed = raw.select("*", *names, F.monotonically_increasing_id().alias(place))
    ranges = placed.groupBy(file, start).agg(F.min(place).alias("least"), F.count("*").alias("n")).collect()
    before, rows = 0, []
    for r in sorted(ranges, key=lambda r: (r[file], r[start])):
        rows.append((r[file], r[start], before - r["least"]))
        before += r["n"]
    shift = free_name(raw, "shift")
    shifts = raw.sparkSession.createDataFrame(rows, f"{file} string, {start} long, {shift} long")
    found = placed.join(F.broadcast(shifts), [file, start])
    return found.select(*[found[c] for c in raw.columns], (F.col(place) + F.col(shift)).alias(position))
