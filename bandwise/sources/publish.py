"""Reports and models published as versions: a reader sees the old one or the new one, never half of either.

A version is staged in a folder of its own (all frames and models), gets a manifest that names its parts, and
becomes current when one small pointer file is renamed over the old one. A writer that dies before leaves only a folder that
nobody points to. Two writers get different folders; the one that renames last wins, whole.

The rename is the file system's (``FileContext.rename`` with overwrite), atomic on HDFS and on local folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"
MANIFEST = "manifest.json"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    p = _path(spark, path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _files(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _get(spark: SparkSession, path: str) -> str | None:
    p, fs = _files(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def stage(spark: SparkSession, path: str, frames: Mapping[str, DataFrame] | None = None, models: Mapping[str, object] | None = None, fmt: str = "parquet", **options) -> str:
    """Write a version that nobody reads yet; its name. ``models`` are MLlib objects with ``write()``."""
    version = f"v-{uuid.uuid4().hex}"
    for name, df in (frames or {}).items():
        df.write.format(fmt).options(**options).save(f"{path}/{version}/{name}")
    for name, model in (models or {}).items():
        model.write().save(f"{path}/{version}/{name}")
    manifest = {"version": version, "previous": current(spark, path), "format": fmt, "options": options,
                "frames": {n: df.schema.jsonValue() for n, df in (frames or {}).items()}, "models": sorted(models or {})}
    _put(spark, f"{path}/{version}/{MANIFEST}", json.dumps(manifest))
    return version


def switch(spark: SparkSession, path: str, version: str) -> None:
    """Make a staged (or older) version the current one."""
    if _get(spark, f"{path}/{version}/{MANIFEST}") is None:
        raise ValueError(f"{path} has no complete version {version}")
    temp = f"{path}/.{version}-{uuid.uuid4().hex[:8]}"
    _put(spark, temp, version)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(_path(spark, temp), _path(spark, f"{path}/{POINTER}"), how)


def publish(spark: SparkSession, path: str, frames: Mapping[str, DataFrame] | None = None, models: Mapping[str, object] | None = None, fmt: str = "parquet", **options) -> str:
    """Stage a version and make it current; its name."""
    version = stage(spark, path, frames, models, fmt, **options)
    switch(spark, path, version)
    return version


def current(spark: SparkSession, path: str) -> str | None:
    return _get(spark, f"{path}/{POINTER}")


def manifest(spark: SparkSession, path: str, version: str | None = None) -> dict:
    version = version or current(spark, path)
    text = _get(spark, f"{path}/{version}/{MANIFEST}") if version else None
    if text is None:
        raise ValueError(f"nothing published at {path}")
    return json.loads(text)


def read_frame(spark: SparkSession, path: str, name: str, version: str | None = None) -> DataFrame:
    """A frame of the current (or a given) version, with the schema it was written with."""
    from pyspark.sql.types import StructType

    m = manifest(spark, path, version)
    schema = StructType.fromJson(m["frames"][name])
    return spark.read.format(m["format"]).options(**m["options"]).schema(schema).load(f"{path}/{m['version']}/{name}")


def read_models(spark: SparkSession, path: str, loader: Callable[[str], object], version: str | None = None) -> dict[str, object]:
    """All models of one version: two models published together are read together."""
    m = manifest(spark, path, version)
    return {n: loader(f"{path}/{m['version']}/{n}") for n in m["models"]}
