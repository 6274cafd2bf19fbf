"""Published versions: readers see whole versions only."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer

from bandwise.session import fresh_path
from bandwise.sources import publish as pub


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions(spark):
    path = fresh_path(spark, "published")
    with pytest.raises(ValueError, match="nothing published"):
        pub.read_frame(spark, path, "report")
    one, two = spark.range(3).toDF("n"), spark.range(5).toDF("n")
    first = pub.publish(spark, path, {"report": one, "other": two})
    old = pub.read_frame(spark, path, "report")
    second = pub.publish(spark, path, {"report": two, "other": one})
    assert rows(pub.read_frame(spark, path, "report")) == rows(two) and rows(old) == rows(one)  # a running reader keeps its version
    assert rows(pub.read_frame(spark, path, "report", first)) == rows(one)
    assert pub.manifest(spark, path)["previous"] == first and pub.current(spark, path) == second
    pub.switch(spark, path, first)
    assert rows(pub.read_frame(spark, path, "other")) == rows(two)


def test_a_killed_write_leaves_the_old_version(spark):
    path = fresh_path(spark, "published")
    good = spark.range(4).toDF("n")
    version = pub.publish(spark, path, {"a": good, "b": good}, fmt="csv", header="true")
    broken = spark.range(4).selectExpr("CAST(raise_error('lost') AS STRING) AS n")
    with pytest.raises(Exception, match="lost"):
        pub.publish(spark, path, {"a": spark.range(9).toDF("n"), "b": broken}, fmt="csv", header="true")
    assert pub.current(spark, path) == version and rows(pub.read_frame(spark, path, "a")) == rows(good)
    staged = pub.stage(spark, path, {"a": spark.range(1).toDF("n")})  # dies before the switch
    assert pub.current(spark, path) == version and staged != version
    with pytest.raises(ValueError, match="no complete version"):
        pub.switch(spark, path, "v-missing")


def test_models_are_read_together(spark):
    path = fresh_path(spark, "published")

    def model(x):
        return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, {x} AS p FROM __THIS__")]).fit(spark.range(1))

    for k in (1, 2):
        pub.publish(spark, path, models={"lv1": model(k), "lv2": model(10 * k)})
        got = pub.read_models(spark, path, PipelineModel.load)
        assert [got[n].transform(spark.range(1)).first()["p"] for n in ("lv1", "lv2")] == [k, 10 * k]
