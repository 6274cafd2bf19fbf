import math

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from bandwise.operators import models as mo
from bandwise.session import fresh_path
from bandwise.sources import fixtures as fx
from tests.conftest import SMALL


def test_chained_scoring_keeps_one_row_per_input_with_duplicate_keys(spark):
    df = spark.createDataFrame(
        [("2021-01-01", 1, 10, 3), ("2021-01-01", 1, 10, 4), ("2021-01-01", 1, 10, 0)],
        "SalDate string, BranchCode int, MaterialCode int, TotalQtySale int",
    )
    lv1, lv2 = fx.fixed_predictors()
    out = mo.two_stage_score(df, lv1, lv2).collect()
    # the original module's self join on the key would give 3 * 3 = 9 rows here
    assert len(out) == 3
    assert [r["pred_final"] for r in out] == [r["pred_lv1"] * r["pred_lv2"] for r in out]


def test_helper_columns_do_not_collide(spark):
    df = spark.createDataFrame([(1, 2.0)], "MaterialCode int, x double")
    m1 = SQLTransformer(statement="SELECT *, 1.0D AS features, 1.0D AS pred_lv1 FROM __THIS__")
    m2 = SQLTransformer(statement="SELECT *, 2.0D AS features, x AS pred_lv2 FROM __THIS__")
    out = mo.two_stage_score(df, m1, m2)
    assert out.columns == ["MaterialCode", "x", "pred_lv1", "pred_lv2", "pred_final"]
    assert out.first()["pred_final"] == 2.0


def test_train_save_load_roundtrip(spark):
    sales = fx.sales(spark, SMALL)
    models = mo.train_two_stage(
        sales, ["avgPrice", "supPrice", "DayofMonth"], classifier="dt", regressor="dt"
    )
    a = mo.two_stage_score(sales, *models).orderBy("SalDate", "BranchCode", "MaterialCode").select("pred_final").collect()
    path = fresh_path(spark, "model")
    mo.save_two_stage(models, path)
    b = mo.two_stage_score(sales, *mo.load_two_stage(path)).orderBy("SalDate", "BranchCode", "MaterialCode").select("pred_final").collect()
    assert a == b and len(a) == sales.count()


def test_fitted_models_beat_a_constant(spark):
    """A label that the features explain: zero for small x, else a sum of both."""
    df = spark.range(600).selectExpr("CAST(id % 10 AS DOUBLE) AS x", "CAST(id * 7 % 13 AS DOUBLE) AS y")
    df = df.selectExpr("*", "CAST(CASE WHEN x < 3 THEN 0 ELSE 5 * x + y END AS INT) AS TotalQtySale")
    scored = mo.two_stage_score(df, *mo.train_two_stage(df, ["x", "y"]))
    r = scored.selectExpr("sqrt(avg(pow(pred_final - TotalQtySale, 2))) AS rmse", "stddev_pop(TotalQtySale) AS sd").first()
    assert r["rmse"] < 0.3 * r["sd"]
    sells = scored.selectExpr("avg(CASE WHEN (pred_lv1 > 0) = (TotalQtySale > 0) THEN 1 ELSE 0 END) AS hit").first()["hit"]
    assert sells == 1.0


def test_null_features_follow_handle_invalid(spark):
    df = spark.createDataFrame([(float(i), None if i % 5 == 0 else 1.0, i % 3) for i in range(60)], "x double, y double, TotalQtySale int")
    params = {"classifier": "dt", "regressor": "dt"}
    mo.train_two_stage(df, ["x", "y"], handle_invalid="skip", **params)
    with pytest.raises(Exception, match="null|NULL|assembl"):
        mo.train_two_stage(df, ["x", "y"], handle_invalid="error", **params)


def _few_values(spark, n=4000):
    """Three features with few values each (13 * 29 * 5), sales that depend on them and on chance."""
    df = spark.range(n).selectExpr(
        "id", "CAST(pmod(xxhash64(id), 13) AS DOUBLE) AS x", "CAST(pmod(xxhash64(id, 1), 29) AS DOUBLE) AS y", "CAST(pmod(xxhash64(id, 2), 5) AS DOUBLE) AS z"
    )
    return df.selectExpr("*", "CAST(CASE WHEN x * y + z * pmod(xxhash64(id, 3), 7) > 90 THEN x + y ELSE 0 END AS INT) AS TotalQtySale")


def test_boosting_reads_a_row_per_bins_and_label_not_per_sale(spark, monkeypatch):
    fitted = []

    class Spy(GBTClassifier):
        def _fit(self, dataset):
            fitted.append(dataset.count())
            return super()._fit(dataset)

    monkeypatch.setitem(mo._CLASSIFIERS, "gbt", Spy)
    for n in (3000, 12000):
        df = spark.range(n).selectExpr("CAST(id % 6 AS DOUBLE) AS x", "CAST(id % 4 AS DOUBLE) AS y", "CAST(id % 3 AS INT) AS TotalQtySale")
        mo.train_two_stage(df, ["x", "y"], regressor="dt", classifier_params={"maxIter": 1})
    assert fitted[0] == fitted[1] <= 6 * 4 * 2


def test_merged_rows_give_the_trees_of_all_rows(spark):
    df = _few_values(spark)
    features = ["x", "y", "z"]
    clf, reg = mo.train_two_stage(df, features, regressor="dt", classifier_params={"maxIter": 5})
    base = df.selectExpr("*", "CAST(TotalQtySale > 0 AS DOUBLE) AS sells", "CAST(TotalQtySale AS DOUBLE) AS qty")
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(base)
    # between the values, too: borders lie in the middle, as MLlib's do
    places = base.selectExpr("id", *[f"{c} + CAST(pmod(id, 9) AS DOUBLE) / 8 - 0.5 AS {c}" for c in features])
    whole = VectorAssembler(inputCols=features, outputCol="features").transform(places)
    plain_clf = GBTClassifier(labelCol="sells", seed=42, maxIter=5).fit(rows)
    plain_reg = DecisionTreeRegressor(labelCol="qty", seed=42).fit(rows.where("qty > 0"))
    raw = vector_to_array("rawPrediction")[1]
    plain = plain_reg.transform(plain_clf.transform(whole).select("id", "features", raw.alias("a"))).withColumnRenamed("prediction", "pred_lv2")
    merged = reg.transform(clf.transform(places).select("id", *features, raw.alias("a")))
    want, got = ({r["id"]: (r["a"], r["b"]) for r in d.select("id", "a", F.col("pred_lv2").alias("b")).collect()} for d in (plain, merged))
    assert len(want) == len(got) == 4000 and len({a for a, _ in want.values()}) > 20
    for i, pair in want.items():
        assert got[i] == pytest.approx(pair, abs=1e-9)


def test_bins_keep_few_values_apart_and_share_many_evenly(spark):
    df = spark.range(20000).selectExpr(
        "CAST(CASE WHEN id = 7 THEN 3 ELSE id % 3 END AS INT) AS few", "pow(CAST(id AS DOUBLE), 3) AS many", "5.0D AS one", "CAST(NULL AS DOUBLE) AS none",
        "CASE id % 4 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN NULL ELSE CAST(id % 4 AS DOUBLE) END AS odd",
    )
    cols = ["few", "many", "one", "none", "odd"]
    bins = mo.fit_bins(df, cols)
    few, many, one, none, odd = bins.getSplitsArray()
    assert few == [-math.inf, *(math.nextafter(x, math.inf) for x in (0.5, 1.5, 2.5)), math.inf]  # a value of one row, too
    assert len(odd) == 3 and len(one) == len(none) == 3
    sizes = [r["count"] for r in bins.transform(df).groupBy("bin_many").count().collect()]
    assert len(sizes) == len(many) - 1 == 32 and max(sizes) < 1.2 * 20000 / 32 and min(sizes) > 0.8 * 20000 / 32


def test_learners_that_draw_or_count_rows_get_all_rows(spark, monkeypatch):
    fitted = []

    class Spy(RandomForestClassifier):
        def _fit(self, dataset):
            fitted.append(dataset.count())
            return super()._fit(dataset)

    monkeypatch.setitem(mo._CLASSIFIERS, "rf", Spy)
    mo.train_two_stage(_few_values(spark, 900), ["x"], classifier="rf", regressor="dt", classifier_params={"numTrees": 2})
    assert fitted == [900]
    assert not mo._mergeable(GBTClassifier(subsamplingRate=0.5)) and not mo._mergeable(GBTClassifier(minInstancesPerNode=2))
    assert mo._mergeable(GBTClassifier()) and not mo._mergeable(GBTClassifier(validationIndicatorCol="v"))
