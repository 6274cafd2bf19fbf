import math
import random

from bandwise.operators import sphere as sp


def _km(a, b):
    (la1, lo1), (la2, lo2) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    h = math.sin((la1 - la2) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo1 - lo2) / 2) ** 2
    return 2 * sp.EARTH_KM * math.asin(math.sqrt(min(h, 1.0)))


def _frames(spark, stores, stations):
    return (
        spark.createDataFrame(stores, "BranchCode int, lat double, lng double"),
        spark.createDataFrame(stations, "name string, lat double, lon double"),
    )


def test_equals_brute_force_with_date_line_poles_and_a_dense_town(spark):
    rnd = random.Random(5)
    stations = [(f"w{j:03d}", math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180)) for j in range(60)]
    stations += [(f"t{j:03d}", 13.7 + rnd.uniform(0, 0.01), 100.5 + rnd.uniform(0, 0.01)) for j in range(60)]
    stations += [("east", 0.0, 179.9), ("west", 0.0, -179.9), ("north", 89.9, 10.0), ("pole", 90.0, 77.0), ("far", -70.0, 540.5)]
    stores = [(i, math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180)) for i in range(30)]
    stores += [(100, 0.0, 180.0), (101, 0.0, -179.95), (102, 89.95, -170.0), (103, 90.0, 0.0), (104, 13.705, 100.505), (105, -70.0, -179.4)]
    s, c = _frames(spark, stores, stations + [("none", None, 1.0), ("beyond", 91.0, 1.0), ("nan", math.nan, 1.0)])
    got = {}
    for r in sp.nearest_on_sphere(s, c, k=3).orderBy("BranchCode", "rank").collect():
        got.setdefault(r["BranchCode"], []).append((r["name"], r["dis_km"]))
    for key, la, lo in stores:
        want = sorted((round(_km((la, lo), (a, o)), 6), n) for n, a, o in stations)[:3]
        assert [n for n, _ in got[key]] == [n for _, n in want], key
        assert all(abs(d - w) < 1e-5 for (_, d), (w, _) in zip(got[key], want, strict=True)), key


def test_empty_and_fewer_than_k(spark):
    s, c = _frames(spark, [(1, 10.0, 100.0), (2, None, 1.0)], [("a", 11.0, 100.0)])
    assert [(r["BranchCode"], r["name"]) for r in sp.nearest_on_sphere(s, c, k=2).collect()] == [(1, "a")]
    none = sp.nearest_on_sphere(s, c.limit(0), k=2)
    assert none.columns == ["BranchCode", "name", "lat", "lon", "dis_km", "rank"] and none.isEmpty()


def test_only_coarse_cells_are_sent_to_every_task(spark, monkeypatch):
    """Without a hint the planner sends whole cell tables through the driver while it believes them small."""
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.checkpoint()

    monkeypatch.setattr(sp, "checkpointed", noted)
    rnd = random.Random(8)
    places = [(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(400)]
    found = sp.nearest_on_sphere(*_frames(spark, places[:50], [(f"w{i:03d}", a, o) for i, a, o in places]), k=2)
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    joins = [line for p in plans for line in p.splitlines() if " Join " in line or line.startswith("Join ") or "Join Inner" in line]
    assert joins and all("strategy=merge" in j or "strategy=broadcast" in j for j in joins)
    assert found.count() == 100
    cells = spark.range(100).selectExpr("CAST(id % 10 AS INT) AS level", "id AS cx", "id AS cy", "id AS cz")
    sent = sp._at_cells(cells, cells.withColumn("n", cells.cx), sp._CELL)
    plan = sent._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1 and sent.count() == 100
