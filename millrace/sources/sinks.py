"""Writers for tables, artefacts, contracts and models; staging; the run log."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.types import free_name

MIN_FILE_ROWS = 1_000

RUN_LOG = (
    "run_id string, file_type string, status string, rows_before bigint, rows_after bigint, "
    "duplicates_before bigint, duplicates_after bigint, missing_before bigint, missing_after bigint, "
    "started_at string, ended_at string, output_path string, error string"
)
CONTRACT = (
    "target_column string, problem_type string, domain_context struct<domain: string, "
    "target_variable_description: string, entity_name: string, financial_context_available: boolean, "
    "strategic_focus: string, target_nature: string, recommended_tone: string, confidence_score: double, "
    "justification: string, evidence_integrity: struct<has_placeholders: boolean, placeholder_count: int, "
    "reporting_mode: string>>"
)


def save_table(df: DataFrame, path: str, kind: str = "parquet") -> str:
    """Write a table, replacing what is there.  Parquet keeps the types."""
    writer = df.write.mode("overwrite")
    if kind == "parquet":
        writer.parquet(path)
    elif kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError(f"unsupported sink kind {kind!r}")
    return path


def save_artefacts(frames: dict[str, DataFrame], root: str, run_id: str, kind: str = "parquet") -> dict[str, str]:
    """One tidy table per artefact, partitioned by run."""
    return {name: save_table(f, f"{root}/{name}/run_id={run_id}", kind) for name, f in frames.items()}


def write_contract(spark: SparkSession, path: str, target: str, problem_type: str, context: dict | None = None) -> str:
    """One JSON row: the target, its problem type, and optional context."""
    rows = spark.createDataFrame([(target, problem_type, context)], CONTRACT)
    rows.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_contract(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONTRACT).json(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def append_run(spark: SparkSession, path: str, **fields) -> None:
    """Put one entry into the run log; it replaces an earlier entry of the run.

    The log is a snapshot, named by the newest file below ``commits``.  A writer
    makes a new snapshot and renames its commit into place, which only one writer
    can do for a number; the others read again and retry.  The snapshot before
    the current one stays for readers that have begun; older ones go.
    """
    schema = T.StructType.fromDDL(RUN_LOG)
    unknown = set(fields) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"unknown run log fields: {sorted(unknown)}")
    row = spark.createDataFrame([tuple(fields.get(n) for n in schema.fieldNames())], schema)
    while True:
        number, snapshot = _current(spark, path)
        rows = row if snapshot is None else latest_runs(spark.read.schema(RUN_LOG).parquet(f"{path}/{snapshot}").unionByName(row))
        made = f"snapshot-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(f"{path}/{made}")
        if _commit(spark, path, number + 1, made):
            return _collect_old(spark, path, number)
        _files(spark, path).delete(_path(spark, f"{path}/{made}"), True)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    _, snapshot = _current(spark, path)
    return spark.createDataFrame([], RUN_LOG) if snapshot is None else spark.read.schema(RUN_LOG).parquet(f"{path}/{snapshot}")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, path: str) -> list[int]:
    folder = _path(spark, f"{path}/commits")
    files = _files(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def _snapshot_of(spark: SparkSession, path: str, number: int) -> str:
    return spark.read.text(f"{path}/commits/{number:012d}").first()["value"]


def _current(spark: SparkSession, path: str) -> tuple[int, str | None]:
    numbers = _commits(spark, path)
    return (numbers[-1], _snapshot_of(spark, path, numbers[-1])) if numbers else (0, None)


def _commit(spark: SparkSession, path: str, number: int, snapshot: str) -> bool:
    """Whether this writer was the first to give the number a snapshot."""
    files, conf = _files(spark, path), spark._jsc.hadoopConfiguration()
    waiting = _path(spark, f"{path}/waiting/{uuid.uuid4().hex}")
    target = _path(spark, f"{path}/commits/{number:012d}")
    files.mkdirs(target.getParent())
    out = files.create(waiting, False)
    out.write(bytearray(snapshot.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(waiting), files.makeQualified(target), no_overwrite)
    except Exception as e:
        files.delete(waiting, False)
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True


def _collect_old(spark: SparkSession, path: str, before: int) -> None:
    """Drop what came before the snapshot that the current one replaced."""
    files = _files(spark, path)
    for number in [n for n in _commits(spark, path) if n < before]:
        files.delete(_path(spark, f"{path}/{_snapshot_of(spark, path, number)}"), True)
        files.delete(_path(spark, f"{path}/commits/{number:012d}"), False)


def latest_runs(log: DataFrame, key: str = "run_id", at: str = "ended_at", tie: tuple[str, ...] = ()) -> DataFrame:
    """The newest entry per run.

    Each task keeps only its newest entry of a run before the shuffle.
    """
    order = Window.partitionBy(key).orderBy(F.desc(at), *[F.desc(t) for t in tie])
    rank = free_name(log, "rank")
    return log.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)


@cache
def _local_root() -> str:
    made = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def stage(df: DataFrame, name: str = "table", rows: int | None = None) -> DataFrame:
    """Write the table to the shared folder and read it back.

    Later passes start from the files, so neither a long plan nor a lost
    executor makes the earlier steps run again.  With the row count known, a
    table of few partitions is cut into enough files to keep all cores busy;
    a large one is not affected.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if rows is not None:
        cores = spark.sparkContext.defaultParallelism
        writer = writer.option("maxRecordsPerFile", max(MIN_FILE_ROWS, math.ceil(rows / cores)))
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
