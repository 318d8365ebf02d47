"""A local session with the settings the operators are written for."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package from where it lies.

    That is enough where all machines see the folder; else install the package or send
    it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared_dir: str | None = None
) -> SparkSession:
    """For tests and the bench.  On a cluster, pass your own session in."""
    builder = SparkSession.builder
    if shared_dir is not None:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    return (
        builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
