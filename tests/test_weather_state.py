"""Latest weather from merged days equals latest weather from all days; only buckets in need are read or written."""

import datetime as dt
import random

from pyspark.sql import functions as F

from bandwise.operators import weather as we
from bandwise.operators import weather_state as ws
from bandwise.session import fresh_path

DAY = dt.date(2023, 12, 1)


def weather(spark, seed, days, stations=40):
    rnd = random.Random(seed)
    rows = [(s, None if d is None else DAY + dt.timedelta(days=d), rnd.uniform(0, 40)) for s in [*range(stations), None] for d in [*days, None] if rnd.random() < 0.7]
    return spark.createDataFrame(rows, "stn int, date date, temp double")


def masters(spark):
    return spark.createDataFrame([(s, f"n{s // 2}" if s % 9 else None, 1.0 * s, 2.0, "TH" if s % 4 == 1 else "XX") for s in range(45)], "usaf int, name string, lat double, lon double, country string")


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_merged_days_equal_all_days(spark):
    path, meta = fresh_path(spark, "weather"), masters(spark)
    first, second, third = weather(spark, 1, range(0, 30)), weather(spark, 2, range(25, 45)), weather(spark, 3, [44, 2], stations=9)
    seen = None
    for part in (first, second, third, third):
        ws.merge_days(part, path)
        seen = part if seen is None else seen.join(part.select("stn", "date"), ["stn", "date"], "left_anti").unionByName(part)
        for year in (2023, 2024):
            assert rows(ws.latest_from(spark, path, meta, "TH", year)) == rows(we.weather_latest(seen, meta, "TH", year)), year


def test_only_touched_buckets_are_rewritten(spark):
    path = fresh_path(spark, "weather")
    ws.merge_days(weather(spark, 4, range(20)), path)

    def files():
        return {r["f"] for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}

    before = files()
    one = spark.createDataFrame([(7, DAY + dt.timedelta(days=25), 1.0)], "stn int, date date, temp double")
    ws.merge_days(one, path)
    bucket = one.select(ws.bucket_of(F.col("stn")).alias("b")).first()["b"]
    assert {f.split("_bucket=")[1].split("/")[0] for f in before ^ files()} == {str(bucket)}


def test_buckets_are_pruned_at_run_time(spark):
    path, meta = fresh_path(spark, "weather"), fresh_path(spark, "stations")
    ws.merge_days(weather(spark, 5, range(20)), path)
    masters(spark).write.parquet(meta)
    df = ws.latest_from(spark, path, spark.read.parquet(meta), "TH", 2023)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
