"""File sources and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_file(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    header: bool = True,
    **options,
) -> DataFrame:
    """Read any Spark format with a header row.

    Pass ``schema`` in production: without it CSV columns arrive as strings
    (the original module's behaviour) and ``clean`` casts them later; with it there
    is no inference pass over the files.
    """
    reader = spark.read.format(fmt).option("header", str(header).lower()).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_report_csv(report: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a report as one headed CSV file.

    Reports have one row per band (or band x type), so a single output
    partition is bounded by construction; never use this for row-level data.
    """
    report.coalesce(1).write.mode(mode).option("header", "true").csv(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None) -> str:
    """Write a row-level table in parallel (one file per partition)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int, path: str, sort: bool = True
) -> DataFrame:
    """Store ``df`` as an external table bucketed (and sorted) on ``keys`` at ``path``.

    Two tables bucketed on the same join keys with the same bucket count join
    without any shuffle (and, when sorted, without a sort). Use it for the
    fact and a fact-sized dimension that are joined on every feature build,
    e.g. sales and price sensitivity on (BranchCode, MaterialCode). Only the
    session catalog is used; the files live at ``path`` (the shared folder).
    """
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
