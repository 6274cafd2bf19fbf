import math
import random

import pytest
from pyspark.sql import functions as F

from bandwise.operators import weather as we


def _brute(stores, stations, k):
    out = {}
    for sk, la, lo in stores:
        d = sorted((math.sqrt((la - a) ** 2 + (lo - o) ** 2), n) for n, a, o in stations)
        out[sk] = [n for _, n in d[:k]]
    return out


@pytest.mark.parametrize("k", [1, 2, 3])
def test_nearest_matches_brute_force(spark, k):
    rnd = random.Random(k * 100)
    stores = [(i, rnd.uniform(5, 20), rnd.uniform(97, 105)) for i in range(60)]
    stations = [(f"s{j:03d}", rnd.uniform(5, 20), rnd.uniform(97, 105)) for j in range(40)]
    sdf = spark.createDataFrame(stores, "BranchCode int, lat double, lng double")
    cdf = spark.createDataFrame(stations, "name string, lat double, lon double")
    got = {}
    for r in we.nearest_station(sdf, cdf, k=k).orderBy("BranchCode", "rank").collect():
        got.setdefault(r["BranchCode"], []).append(r["name"])
    assert got == _brute(stores, stations, k)


def test_tied_stations_get_average_rank(spark):
    sdf = spark.createDataFrame([(1, 10.0, 100.0)], "BranchCode int, lat double, lng double")
    cdf = spark.createDataFrame([("a", 10.0, 101.0), ("b", 10.0, 99.0), ("c", 13.0, 100.0)], "name string, lat double, lon double")
    rows = we.nearest_station(sdf, cdf, k=3).orderBy("rank").collect()
    assert [(r["name"], r["rank"], r["avg_rank"]) for r in rows] == [("a", 1, 1.5), ("b", 2, 1.5), ("c", 3, 3.0)]


def test_fewer_candidates_than_k_and_missing_coordinates(spark):
    sdf = spark.createDataFrame([(1, 10.0, 100.0), (2, None, 100.0)], "BranchCode int, lat double, lng double")
    cdf = spark.createDataFrame([("a", 11.0, 100.0)], "name string, lat double, lon double")
    rows = we.nearest_station(sdf, cdf, k=2).collect()
    assert [(r["BranchCode"], r["name"]) for r in rows] == [(1, "a")]


def test_weather_latest_semantics(spark):
    import datetime as dt

    w = spark.createDataFrame(
        [
            (1, dt.date(2024, 1, 1), 20.0),
            (1, dt.date(2024, 1, 3), 21.0),
            (2, dt.date(2024, 1, 3), 22.0),  # same name as stn 1: ties kept
            (3, dt.date(2024, 1, 2), 23.0),  # station without a name: dropped
            (4, dt.date(2024, 1, 5), 24.0),  # not a TH station
            (1, dt.date(2023, 12, 31), 19.0),
        ],
        "stn int, date date, temp double",
    )
    st = spark.createDataFrame(
        [(1, "BKK", 13.7, 100.5, "TH"), (2, "BKK", 13.8, 100.6, "TH"), (3, None, 14.0, 100.0, "TH"), (4, "X", 1.0, 1.0, "XX")],
        "usaf int, name string, lat double, lon double, country string",
    )
    got = sorted((r["stn"], str(r["date"])) for r in we.weather_latest(w, st, "TH", 2024).collect())
    assert got == [(1, "2024-01-03"), (2, "2024-01-03")]


STORE, CAND = "BranchCode int, lat double, lng double", "name string, lat double, lon double"


def _nearest(spark, stores, stations, k):
    got = {}
    out = we.nearest_station(spark.createDataFrame(stores, STORE), spark.createDataFrame(stations, CAND), k=k)
    for r in out.orderBy("BranchCode", "rank").collect():
        got.setdefault(r["BranchCode"], []).append(r["name"])
    return got


def _frontier(spark, stores, stations, k):
    """The search's steps: (pairs before ranking, their lazy frame)."""
    sto = spark.createDataFrame(stores, STORE).selectExpr("BranchCode AS _sk", "lat AS _slat", "lng AS _slng")
    points = spark.createDataFrame(stations, CAND).selectExpr("lat AS _la", "lon AS _lo").groupBy("_la", "_lo").agg(F.count("*").alias("_n"))
    ext = points.agg(F.min("_la"), F.max("_la"), F.min("_lo"), F.max("_lo"), F.sum("_n")).first()
    grid = we._Grid(*ext[:4])
    placed, cells = we._cells(points, grid, "_la", "_lo")
    cells = cells.checkpoint()
    frontier = we._frontier(sto, cells, grid, k, ext[4]).checkpoint()
    while not frontier.filter((F.col("places") > we.LEAF_POINTS) & (F.col("level") < we.LEVELS)).isEmpty():
        frontier = we._refined(frontier, cells, k).checkpoint()
    return we._pairs(frontier, placed, "_la", "_lo"), we._frontier(sto, cells, grid, k, ext[4])


def test_plans_have_no_pairs_of_everything(spark):
    rnd = random.Random(1)
    stores = [(i, rnd.uniform(5, 20), rnd.uniform(97, 105)) for i in range(50)]
    stations = [(f"s{j}", rnd.uniform(5, 20), rnd.uniform(97, 105)) for j in range(50)]
    for lazy in _frontier(spark, stores, stations, 1):
        plan = lazy._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert "level" in plan and "Join" in plan  # an equi-join on cells, not a checkpointed scan


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf"), None])
def test_unusable_coordinates_are_left_out(spark, bad):
    stores = [(1, 10.0, 100.0), (2, bad, 100.0), (3, 11.0, bad), (4, 12.0, 101.0)]
    stations = [("a", 10.0, 100.5), ("b", bad, 100.0), ("c", 12.0, bad), ("d", 13.0, 101.0)]
    assert _nearest(spark, stores, stations, 1) == {1: ["a"], 4: ["d"]}


def test_one_outlier_does_not_pair_everything(spark):
    rnd = random.Random(3)
    stores = [(i, rnd.uniform(5, 20), rnd.uniform(97, 105)) for i in range(500)]
    stations = [(f"s{j:03d}", rnd.uniform(5, 20), rnd.uniform(97, 105)) for j in range(200)] + [("zero", 0.0, 0.0)]
    pairs, _ = _frontier(spark, stores, stations, 1)
    assert pairs.count() <= 20 * len(stores)
    assert _nearest(spark, stores, stations, 1) == _brute(stores, stations, 1)


def test_far_stores_and_dense_towns(spark):
    rnd = random.Random(4)
    town = [(f"t{j:04d}", 15 + rnd.gauss(0, 0.001), 100 + rnd.gauss(0, 0.001)) for j in range(2000)]
    stations = town + [(f"r{j}", rnd.uniform(5, 20), rnd.uniform(97, 105)) for j in range(20)]
    stores = [(i, rnd.uniform(5, 20), rnd.uniform(97, 105)) for i in range(60)] + [(100 + i, 60.0 + i, -20.0) for i in range(5)]
    stores += [(200 + i, 15 + rnd.gauss(0, 0.002), 100 + rnd.gauss(0, 0.002)) for i in range(35)]
    pairs, _ = _frontier(spark, stores, stations, 2)
    assert pairs.count() <= 60 * len(stores)  # of 202,000
    assert _nearest(spark, stores, stations, 2) == _brute(stores, stations, 2)


def test_all_candidates_on_one_point(spark):
    stations = [(f"s{j:03d}", 10.0, 100.0) for j in range(300)]
    stores = [(i, 9.0 + i / 10, 100.0) for i in range(20)]
    pairs, _ = _frontier(spark, stores, stations, 3)
    assert pairs.count() == len(stores)  # one place
    assert _nearest(spark, stores, stations, 3) == _brute(stores, stations, 3)
    out = we.nearest_station(spark.createDataFrame(stores, STORE), spark.createDataFrame(stations, CAND), k=3)
    assert {r["avg_rank"] for r in out.collect()} == {150.5}


def test_empty_sides_keep_the_schema(spark):
    sdf, cdf = spark.createDataFrame([(1, 10.0, 100.0)], STORE), spark.createDataFrame([("a", 10.0, 101.0)], CAND)
    full = we.nearest_station(sdf, cdf)
    for s, c in ((sdf, cdf.limit(0)), (sdf.limit(0), cdf)):
        none = we.nearest_station(s, c)
        assert none.count() == 0 and none.dtypes[1:4] == full.dtypes[1:4] and none.columns == full.columns


def test_grid_aligned_points(spark):
    stores = [(i * 10 + j, float(i), float(j)) for i in range(5) for j in range(5)]
    stations = [(f"s{i}{j}", float(i) + 0.5 * (j % 2), float(j) * 2.0) for i in range(0, 5, 2) for j in range(3)]
    assert _nearest(spark, stores, stations, 2) == _brute(stores, stations, 2)


def test_one_weather_scan_and_a_pushed_date_range(spark, tmp_path):
    import datetime as dt

    spark.createDataFrame([(1, dt.date(2024, 1, 1), 20.0)], "stn int, date date, temp double").write.parquet(str(tmp_path / "w"))
    spark.createDataFrame([(1, "BKK", 13.7, 100.5, "TH")], "usaf int, name string, lat double, lon double, country string").write.parquet(str(tmp_path / "s"))
    df = we.weather_latest(spark.read.parquet(str(tmp_path / "w")), spark.read.parquet(str(tmp_path / "s")), "TH", 2024)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("temp#") and plan.count(f"{tmp_path}/w") == 1 and "GreaterThanOrEqual(date,2024-01-01)" in plan and "WindowGroupLimit" in plan


def test_year_filter_prunes_partitions(spark):
    from bandwise.plans import registry
    from tests.conftest import SMALL

    df = registry.q_weather_partitioned(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan
    assert df.count() == registry.q_weather_latest(spark, SMALL).count()
