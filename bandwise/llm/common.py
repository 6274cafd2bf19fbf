"""Helpers shared by the operators: table access, shipped functions, written intermediate tables."""

from __future__ import annotations

import ctypes
import importlib
import os
import sys

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.session import fresh_path

LARGE_GROUP = 1 << 20  # bytes; memory is not returned after every small group
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(module: str, function: str, **params):
    """A function for ``mapInArrow``: calls ``module.function(batches, **params)`` in the worker.

    It is pickled by value and imports the module when it runs, so workers
    need the package on their path or at the driver's place, nothing else.
    """
    call = _late(module, function, params)

    def run(batches):
        try:
            yield from call(batches)
        finally:
            give_back()

    return run


def shipped_group(module: str, function: str, **params):
    """The same for ``applyInArrow`` on groups: ``module.function(table, **params)``."""
    call = _late(module, function, params)

    def run(t):
        try:
            return call(t)
        finally:
            if t.nbytes > LARGE_GROUP:
                give_back()

    return run


def shipped_cogroup(module: str, function: str, **params):
    """The same for ``applyInArrow`` on cogroups: ``module.function(left, right, **params)``."""
    call = _late(module, function, params)

    def run(left, right):
        try:
            return call(left, right)
        finally:
            if left.nbytes + right.nbytes > LARGE_GROUP:
                give_back()

    return run


def give_back() -> None:
    """Return freed memory to the system.

    Workers live through all stages of a job, and the allocators keep what the largest task so far needed:
    that would lie idle beside what later stages need elsewhere on the executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def _late(module: str, function: str, params: dict):
    root = _ROOT

    def call(*args):
        try:
            m = importlib.import_module(module)
        except ModuleNotFoundError:
            sys.path.insert(0, root)
            m = importlib.import_module(module)
        return getattr(m, function)(*args, **params)

    return call


def keep(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    w = df.write.option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(df: DataFrame) -> DataFrame:
    """The two columns most operators need; rows without an id cannot be reported and are left out."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")


def parts(df: DataFrame, least: int = 1) -> int:
    """Shuffle partitions of the session, at least ``least``."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
