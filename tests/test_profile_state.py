"""Profiles from monthly state against profiles from scratch; sketches within their stated error."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bandwise.operators import profile as pr
from bandwise.operators import profile_state as ps
from bandwise.operators import sampling as sa
from bandwise.session import fresh_path

COLS = "SalDate date, BranchCode int, MaterialCode int, TotalQtySale int"


def make(seed, n=1500):
    rnd = random.Random(seed)
    start = dt.date(2020, 1, 1)
    return [(start + dt.timedelta(days=rnd.randrange(120)), rnd.choice([1, 2, None]), rnd.randrange(3), rnd.choice([None, 0, 0, 1, 2, 3, 9, rnd.randrange(500)])) for _ in range(n)]


def rounded(df, columns):
    def near(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v

    return sorted((tuple(near(v) for v in r) for r in df.select(*columns).collect()), key=str)


def check(spark, path, sales):
    whole = pr.dow_sales_profile(sales)
    assert rounded(ps.weekday_profile_from(spark, path), whole.columns) == rounded(whole, whole.columns)


def test_replayed_months_equal_scratch(spark):
    path = fresh_path(spark, "weekdays")
    first = spark.createDataFrame(make(1), COLS)
    ps.replay_weekdays(first, path)
    check(spark, path, first)
    march = F.month("SalDate") == 3
    second = first.where(~march).unionByName(spark.createDataFrame(make(2), COLS).where(march))
    ps.replay_weekdays(second, path, [dt.date(2020, 3, 20), dt.date(2020, 3, 2)])
    check(spark, path, second)


def test_sketched_medians_stay_within_the_rank_error(spark):
    rnd = random.Random(3)
    rows = [(dt.date(2020, 1 + i % 12, 6) + dt.timedelta(days=(0 - dt.date(2020, 1 + i % 12, 6).weekday()) % 7), 1, 1, int(rnd.paretovariate(1) * 50)) for i in range(20000)]
    path = fresh_path(spark, "weekdays")
    ps.replay_weekdays(spark.createDataFrame(rows, COLS), path)
    r = ps.weekday_profile_from(spark, path, exact_median=False).collect()
    assert len(r) == 1 and r[0]["Total_Bill_Dow"] == 20000
    values = sorted(x[3] for x in rows)
    below, upto = sum(v < r[0]["MED_SumQTY_Dow"] for v in values) / 20000, sum(v <= r[0]["MED_SumQTY_Dow"] for v in values) / 20000
    assert below <= 0.5 + ps.RANK_ERROR and upto >= 0.5 - ps.RANK_ERROR


def test_the_source_is_read_once_and_groups_meet_once(spark):
    sales = spark.createDataFrame(make(4), COLS)
    source, path = fresh_path(spark, "sales"), fresh_path(spark, "weekdays")
    sales.write.parquet(source)
    stored = spark.read.parquet(source)
    plan = ps._weekday_parts(ps._months(stored, "SalDate", None), ps._KEYS, F.col("SalDate"), "TotalQtySale")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan
    ps.replay_weekdays(stored, path)
    plan = ps.weekday_profile_from(spark, path)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_many_copies_and_many_quantities(spark):
    """Counts beyond one stretch, and thousands of distinct quantities, which the median passes once."""
    day = dt.date(2020, 1, 6)
    n = 2 * ps.STRETCH + 3
    rows = spark.range(n + 4001).select(
        F.lit(day).alias("SalDate"), F.lit(1).alias("BranchCode"), F.when(F.col("id") < n, 1).otherwise(2).alias("MaterialCode"),
        F.when(F.col("id") < n, F.lit(7)).otherwise((F.col("id") - n).cast("int")).alias("TotalQtySale"),
    )
    path = fresh_path(spark, "weekdays")
    ps.replay_weekdays(rows, path)
    check(spark, path, rows)
    state = spark.read.parquet(path).select("MaterialCode", F.kll_sketch_get_n_double("sketch").alias("n")).collect()
    assert {r["MaterialCode"]: r["n"] for r in state} == {1: n, 2: 4001}


def test_column_profile_unites_months(spark):
    path = fresh_path(spark, "columns")
    df = spark.range(30000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 150).cast("int")).alias("SalDate"), F.col("id").alias("k"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 700)).alias("odd.name"), F.lit(None).cast("double").alias("none"),
    )
    ps.replay_columns(df.where("k < 20000"), path)
    ps.replay_columns(df, path, [dt.date(2020, m, 1) for m in range(1, 7)])
    got = {r["column_name"]: r for r in ps.column_profile_from(spark, path).collect()}
    assert {c: (r["non_null"], r["n_null"]) for c, r in got.items()} == {"SalDate": (30000, 0), "k": (30000, 0), "odd.name": (20000, 10000), "none": (0, 30000)}
    for c, n in (("SalDate", 150), ("k", 30000), ("odd.name", 700), ("none", 0)):
        assert abs(got[c]["approx_distinct"] - n) <= 4 * ps.DISTINCT_ERROR * n


def test_only_the_months_named_are_read(spark):
    source = fresh_path(spark, "sales")
    spark.createDataFrame(make(5), COLS).write.partitionBy("SalDate").parquet(source)
    rows = ps._months(spark.read.parquet(source), "SalDate", [dt.date(2020, 2, 9)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SalDate" in plan and {r["m"] for r in rows.select(F.month("SalDate").alias("m")).distinct().collect()} == {2}


def test_sample_by_halves_are_whole_and_stable(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 50 > 0, F.col("id") % 3).alias("label")).repartition(7)
    sample, rest = sa.stratified_split(df, {0: 0.5, 1: 0.1}, "label", ["id"], method="sampleBy")
    a, b = {r["id"] for r in sample.collect()}, {r["id"] for r in rest.collect()}
    assert not a & b and len(a) + len(b) == 20000 and {r["id"] for r in sample.repartition(3).collect()} == a
    shares = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(shares) == {0, 1}  # no fraction, or no label: in the rest
    for label, f in ((0, 0.5), (1, 0.1)):
        n = df.where(F.col("label") == label).count()
        assert abs(shares[label] - f * n) <= 5 * (n * f * (1 - f)) ** 0.5
    twice = spark.createDataFrame([(1, "a")] * 40, "k int, label string")
    sample, rest = sa.stratified_split(twice, 0.5, "label", "k", method="sampleBy")
    assert sample.count() + rest.count() == 40 and sample.columns == twice.columns
    with pytest.raises(ValueError, match="method"):
        sa.stratified_split(df, 0.5, "label", "id", method="other")
