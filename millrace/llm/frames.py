"""Small helpers that the operators of this package share."""

from __future__ import annotations

import math
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Python workers live on between tasks; with these, what a task frees goes back to
#: the system at once and doesn't add up over the workers of an executor.
WORKER_SETTINGS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "4194304",
    "MALLOC_TRIM_THRESHOLD_": "4194304",
    "TOKENIZERS_PARALLELISM": "false",
}


def prepare(spark: SparkSession) -> None:
    """Settings of Python workers, for sessions that haven't started any yet.

    On one machine they can import the package from where it lies; on a cluster it
    is installed or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for name, value in WORKER_SETTINGS.items():
        env.setdefault(name, value)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column, pattern: str) -> Column:
    """All matches of a pattern; none for a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def parts_for(df: DataFrame, column: str, target_bytes: int) -> int:
    """How many buckets of about ``target_bytes`` of a text column a table needs.

    At least three a core, so that small tables keep a cluster busy.  The one
    number that comes to the driver is the table's size.
    """
    size = df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0
    return max(3 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / target_bytes))


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names c0, c1, ..., which no working column clashes with."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def named_again(df: DataFrame, names: dict[str, str], **made: str) -> DataFrame:
    """Undo ``plain_names``; columns made replace those of the same name."""
    kept = [F.col(short).alias(name) for name, short in names.items() if name not in made]
    return df.select(*kept, *[F.col(short).alias(name) for name, short in made.items()])
