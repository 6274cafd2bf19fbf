"""Session helpers: shared storage and local sessions for tests and the bench."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


def local_session(checkpoint_dir: str, cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench (AQE on, UI off, UTC)."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bandwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", checkpoint_dir)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, sub: str | None = None) -> str:
    """A folder on the storage the whole cluster shares: the session's ``spark.checkpoint.dir``.

    A session that names none is an error; no machine-local folder is ever used.
    """
    try:
        sc = spark.sparkContext
    except PySparkException:  # a Connect session has no SparkContext: the conf is all there is
        sc = None
    base = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    return base if sub is None else base.rstrip("/") + "/" + sub


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder (one per write)."""
    return shared_dir(spark, f"bandwise/{name}-{uuid.uuid4().hex[:12]}")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder; without one the session helper's own error is raised."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends, and the planner knows its size."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
