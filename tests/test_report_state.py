"""Reports from the day state equal reports from scratch; a replay reads and replaces its days only."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bandwise.functions.scoring import classify_error
from bandwise.operators import evaluate as ev
from bandwise.operators import report_state as rs
from bandwise.session import fresh_path

DAYS = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(8)]
COLS = "SalDate date, TotalQtySale int, pred_final double, avgPriceDis double, avgPrice double, supPrice double"


def make(seed, days=DAYS, n=600):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        q = rnd.choice([0, 0, 1, 2, 5, 9, 12, 70, 1500, -3, 5000])
        price = rnd.choice([None, rnd.uniform(1, 9)])
        rows.append((rnd.choice(days), q, rnd.choice([None, q + rnd.uniform(-3, 3)]), price, rnd.uniform(1e6, 1e6 + 1), 2.0))
    return rows


def rounded(df, *order):
    def near(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v

    return sorted((tuple(near(v) for v in r) for r in df.select(sorted(df.columns)).collect()), key=str)


def check(spark, path, scored):
    state = rs.read_state(spark, path)
    assert rounded(rs.range_report_from(state)) == rounded(ev.range_report(scored))
    whole = ev.over_under_report(classify_error(scored, "TotalQtySale", "pred_final"), "TotalQtySale", "pred_final")
    assert rounded(rs.over_under_report_from(state)) == rounded(whole)


def test_replay_equals_scratch(spark):
    path = fresh_path(spark, "state")
    first = spark.createDataFrame(make(1), COLS)
    rs.replay(first, path)
    check(spark, path, first)
    day = DAYS[3]
    second = first.where(F.col("SalDate") != day).unionByName(spark.createDataFrame(make(2, [day], 90), COLS))
    rs.replay(second, path, [day])
    check(spark, path, second)
    gone = second.where(~F.col("SalDate").isin(DAYS[5:]))  # days that lost all their rows
    rs.replay(gone, path, DAYS[5:])
    check(spark, path, gone)
    later = dt.date(2020, 3, 1)
    more = gone.unionByName(spark.createDataFrame(make(3, [later], 50), COLS))
    rs.replay(more, path, [later])
    check(spark, path, more)


def test_report_of_a_period(spark):
    path = fresh_path(spark, "state")
    scored = spark.createDataFrame(make(4), COLS)
    rs.replay(scored, path)
    state = rs.read_state(spark, path, DAYS[2], DAYS[4])
    part = scored.where(F.col("SalDate").between(DAYS[2], DAYS[4]))
    assert rounded(rs.range_report_from(state)) == rounded(ev.range_report(part))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_rows_without_a_day(spark):
    path = fresh_path(spark, "state")
    scored = spark.createDataFrame([*make(5, n=40), (None, 2, 1.0, 1.0, 1.0, 1.0)], COLS)
    rs.replay(scored, path)
    check(spark, path, scored)
    fixed = scored.where("SalDate IS NOT NULL")
    rs.replay(fixed, path, [None])
    check(spark, path, fixed)


def test_only_the_replayed_days_are_scanned_and_written(spark):
    path, source = fresh_path(spark, "state"), fresh_path(spark, "scored")
    spark.createDataFrame(make(6), COLS).write.partitionBy("SalDate").parquet(source)
    scored = spark.read.parquet(source)
    rs.replay(scored, path)
    before = {r["f"] for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    state = rs.day_state(scored.where(F.col("SalDate").isin([DAYS[1]])))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SalDate" in plan or "PartitionFilters: [(SalDate" in plan
    rs.replay(scored, path, [DAYS[1]])
    after = {r["f"] for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    assert {f.split("day=")[1][:10] for f in before ^ after} == {str(DAYS[1])}


def test_label_variance_survives_large_means(spark):
    """Labels around a billion: sums of squares would lose the variance, merged moments do not."""
    path = fresh_path(spark, "state")
    rows = [(d, 10**9 + i + k, float(10**9 + i), 1.0, 1.0, 1.0) for k, d in enumerate(DAYS) for i in range(20)]
    scored = spark.createDataFrame(rows, COLS)
    rs.replay(scored, path, bands=[(0, 2 * 10**9)])
    got = rs.range_report_from(rs.read_state(spark, path), bands=[(0, 2 * 10**9)]).first()
    want = ev.range_report(scored, bands=[(0, 2 * 10**9)]).first()
    assert got["r2"] == pytest.approx(want["r2"], rel=1e-9) and got["count"] == len(rows)


def test_empty(spark):
    path = fresh_path(spark, "state")
    empty = spark.createDataFrame([], COLS)
    rs.replay(empty, path, [DAYS[0]])
    report = rs.range_report_from(rs.read_state(spark, path)).collect()
    assert len(report) == 17 and all(r["count"] == 0 for r in report)
