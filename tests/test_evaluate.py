import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from bandwise.functions.scoring import SALES_BANDS, classify_error, post_score
from bandwise.operators import evaluate as ev


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        q = rnd.choice([0, 0, 0, 1, 2, 3, 5, 8, 12, 30, 55, 70, 150, 3.5, -1, 5000])
        rows.append((i, float(q), q * rnd.uniform(0.5, 1.5) + rnd.uniform(-1, 1)))
    return spark.createDataFrame(rows, "id int, label double, predict_qty double")


def test_metrics_match_mllib(spark, scored):
    got = ev.regression_metrics(scored, "label", "predict_qty").first()
    for m in ("rmse", "mse", "r2", "mae"):
        want = RegressionEvaluator(labelCol="label", predictionCol="predict_qty", metricName=m).evaluate(scored)
        assert got[m] == pytest.approx(want, rel=1e-9)


def test_range_report_properties(spark, scored):
    rep = ev.range_report(scored, "label", "predict_qty").orderBy("band_id").collect()
    assert [r["Range"] for r in rep][:5] == ["0", "1", "2", "3", "4 to 6"] and len(rep) == len(SALES_BANDS)
    total = scored.count()
    assert all(r["all"] == total for r in rep)
    in_band = sum(r["count"] for r in rep)
    outside = scored.filter(~F.col("label").isin(*[float(v) for v in (0, 1, 2, 3, 5, 8, 12, 30, 55, 70, 150)])).count()
    assert in_band + outside == total
    empty = [r for r in rep if r["count"] == 0]
    assert empty and all(r["mae"] is None and r["r2"] is None for r in empty)
    # constant labels inside a single-value band: r2 is NULL, not -inf/NaN
    assert rep[0]["r2"] is None and rep[0]["mae"] is not None
    # each band agrees with the evaluator run on that band alone
    b = rep[5]  # 7 to 10
    part = scored.filter(F.col("label").between(7, 10))
    assert b["rmse"] == pytest.approx(RegressionEvaluator(labelCol="label", predictionCol="predict_qty").evaluate(part))


def test_report_unchanged_after_repartition(spark, scored):
    a = ev.range_report(scored, "label", "predict_qty").orderBy("band_id").collect()
    b = ev.range_report(scored.repartition(13), "label", "predict_qty").orderBy("band_id").collect()
    for x, y in zip(a, b):
        assert x["count"] == y["count"] and (x["mse"] is None) == (y["mse"] is None)
        if x["mse"] is not None:
            assert x["mse"] == pytest.approx(y["mse"], rel=1e-12)


def test_null_prediction_is_skipped_but_counted(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, None), (2.0, 2.0)], "label double, predict_qty double")
    r = {x["band_id"]: x for x in ev.range_metrics(df, "label", "predict_qty").collect()}
    assert (r[2]["count"], r[2]["n_scored"], r[2]["mae"]) == (2, 1, 0.5)


def test_over_under_lower_plus_upper_is_band_count(spark, scored):
    ou = ev.over_under_report(classify_error(scored, "label", "predict_qty"), "label", "predict_qty", value_cols=())
    rep = {r["band_id"]: r["count"] for r in ev.range_report(scored, "label", "predict_qty").collect()}
    sums = {}
    for r in ou.collect():
        sums[r["band_id"]] = sums.get(r["band_id"], 0) + r["count_of_each_part"]
        assert r["Range"].count("-") >= 1 and r["prediction_type"] in ("Lower", "Upper")
    assert sums == {k: v for k, v in rep.items() if v}


def test_classify_error_null_is_lower(spark):
    df = spark.createDataFrame([(2, 3.0), (2, 1.0), (2, 2.0), (2, None)], "label int, predict_qty double")
    got = [(r["prediction_type"], r["prediction_diff"]) for r in classify_error(df).collect()]
    assert got == [("Upper", 1.0), ("Lower", 1.0), ("Upper", 0.0), ("Lower", None)]


def test_uplift_days(spark):
    df = spark.createDataFrame([(d, 10.0) for d in (1, 2, 5, 6, None)], "Day int, predict_qty double")
    got = [r["predict_qty"] for r in post_score(df).collect()]
    assert got == [15.0, 14.0, 14.0, 10.0, 10.0]


def test_range_report_single_shuffle_of_rows(spark, scored):
    plan = ev.range_report(scored, "label", "predict_qty")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1  # one shuffle of partial sums keyed by band
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_band_reports_one_pass_equals_separate_reports(spark, scored):
    df = scored.withColumn("avgPrice", F.col("id") * 0.5)
    r1, r2 = ev.band_reports(df, "label", "predict_qty", value_cols=("avgPrice",))
    a = {r["band_id"]: r for r in ev.range_report(df, "label", "predict_qty").collect()}
    for r in r1.collect():
        o = a[r["band_id"]]
        assert (r["count"], r["n_scored"], r["all"]) == (o["count"], o["n_scored"], o["all"])
        for m in ("mae", "rmse", "mse", "r2"):
            assert (r[m] is None) == (o[m] is None) and (r[m] is None or r[m] == pytest.approx(o[m], rel=1e-9))
    b = {(r["band_id"], r["prediction_type"]): r for r in ev.over_under_report(df, "label", "predict_qty", ("avgPrice",)).collect()}
    got = {(r["band_id"], r["prediction_type"]): r for r in r2.collect()}
    assert got.keys() == b.keys()
    for k, r in got.items():
        assert r["count_of_each_part"] == b[k]["count_of_each_part"]
        assert r["avg(avgPrice)"] == pytest.approx(b[k]["avg(avgPrice)"], rel=1e-9)


def test_constant_label_r2_is_null_under_any_partitioning(spark):
    df = spark.createDataFrame([(2.0, 2.0 + i * 0.01) for i in range(500)], "label double, predict_qty double")
    for parts in (1, 7, 64):
        rep = {r["band_id"]: r for r in ev.range_report(df.repartition(parts), "label", "predict_qty").collect()}
        assert rep[3]["r2"] is None and rep[3]["count"] == 500
        r1, _ = ev.band_reports(df.repartition(parts), "label", "predict_qty", value_cols=())
        assert {r["band_id"]: r for r in r1.collect()}[3]["r2"] is None
