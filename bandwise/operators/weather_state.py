"""The latest weather of every station, kept by key and merged from new days only.

The state holds, for each (year, station), the rows of its latest date, partitioned by a hash bucket of the station. ``merge_days``
reads the buckets that the new rows touch, keeps what is latest, and replaces those partitions; rows of a (station, date) that come
again replace the old ones. ``latest_from`` gives ``weather.weather_latest``: the country's stations are joined by bucket
and key, so at run time only the buckets that hold one of them are scanned (dynamic partition pruning).

A station's latest date never goes back: withdrawn days need a rebuild (``merge_days`` of all days into a new path). Rows without a station or
date are left out, as ``weather_latest`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandwise.operators.weather import weather_latest
from bandwise.session import written

BUCKETS = 64


def bucket_of(station: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(station.cast("string")), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def merge_days(new_days: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Merge rows of new days (columns of the weather table) into the state at ``path``."""
    spark = new_days.sparkSession
    fresh = new_days.where("stn IS NOT NULL AND date IS NOT NULL")
    fresh = fresh.withColumns({"_year": F.year("date"), "_bucket": bucket_of(F.col("stn"), buckets)})
    rows = fresh
    if _exists(spark, path):
        state = spark.read.schema(fresh.schema).parquet(path)
        touched = [r["_bucket"] for r in fresh.select("_bucket").distinct().collect()]  # at most ``buckets``
        old = state.where(F.col("_bucket").isin(touched)).join(fresh.select("stn", "date").distinct(), ["stn", "date"], "left_anti")
        rows = fresh.unionByName(old)
    # the rank limit is applied before the shuffle too: a task sends a station's latest rows only
    place = F.rank().over(Window.partitionBy("_year", "stn").orderBy(F.desc("date")))
    latest = written(rows.withColumn("_place", place).where("_place = 1").drop("_place"), "latest_weather")
    latest.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)


def latest_from(spark: SparkSession, path: str, stations: DataFrame, country: str = "TH", year: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``weather_latest`` of all days that the state has seen."""
    state = spark.read.parquet(path)
    if year is not None:
        state = state.where(F.col("_year") == year)
    local = stations.where(F.col("country") == country).select(F.col("usaf").alias("_usaf"))
    local = local.withColumn("_of", bucket_of(F.col("_usaf"), buckets)).distinct()
    state = state.join(local, (state["_bucket"] == local["_of"]) & (state["stn"] == local["_usaf"]), "left_semi")
    return weather_latest(state.drop("_bucket", "_year"), stations, country)
