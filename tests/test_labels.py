"""The fitted label dictionary: stable indexes, versions, persistence, policies, one pass."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from bandwise.operators import encode as enc
from bandwise.operators import labels as lb
from bandwise.session import fresh_path


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, None), ("c", 3, "y"), ("b", 1, "y")], "c string, z int, `odd.name` string")


def encoder(policy="error", columns=("c", "z")):
    return lb.LabelEncoder(inputCols=list(columns), outputCols=[f"{c}_i" for c in columns], vectorCols=[f"{c}_v" for c in columns], handleInvalid=policy)


def coded(df, columns=("c", "z")):
    vec = [enc.one_hot_active(F.col(f"{c}_v")).alias(f"{c}_at") for c in columns]
    return sorted(map(tuple, df.select(*columns, *[f"{c}_i" for c in columns], *vec).collect()), key=str)


def test_order_is_string_indexers(spark):
    df = spark.range(700).select((F.col("id") * F.col("id") % 53).alias("p"), F.concat(F.lit("l"), F.col("id") % 7).alias("q"))
    want = StringIndexer(inputCols=["p", "q"], outputCols=["wp", "wq"]).fit(df).transform(df)
    got = lb.LabelEncoder(inputCols=["p", "q"], outputCols=["gp", "gq"]).fit(df).transform(want)
    assert got.where("gp <> wp OR gq <> wq").count() == 0 and got.count() == 700


def test_other_rows_get_the_fitted_indexes(spark, rows):
    model = encoder("keep").fit(rows)
    other = spark.createDataFrame([("c", 9), ("new", 1), (None, None)], "c string, z int")
    assert coded(model.transform(other)) == [("c", 9, 2.0, 3.0, 2, 3), ("new", 1, 3.0, 0.0, 3, 0), (None, None, 3.0, 3.0, 3, 3)]
    assert model.transform(other).select(enc.one_hot_size(F.col("c_v"))).distinct().collect() == [(4,)]
    assert model.transform(other.select("z", F.lit(1).alias("_idx"), "c", F.lit("q").alias("label"))).count() == 3  # clashing names


def test_policies(spark, rows):
    other = spark.createDataFrame([("a", 1), ("new", 1), (None, 1)], "c string, z int")
    model = encoder("skip").fit(rows)
    assert [r[0] for r in coded(model.transform(other))] == ["a"]
    for bad in (["new"], [None]):
        with pytest.raises(Exception, match="not in the dictionary"):
            encoder().fit(rows).transform(other.where(F.col("c").eqNullSafe(bad[0]))).collect()
    with pytest.raises(ValueError, match="handleInvalid"):
        encoder("drop").fit(rows)
    with pytest.raises(ValueError, match="distinct"):
        lb.LabelEncoder(inputCols=["c", "c"], outputCols=["x", "y"]).fit(rows)


def test_save_load_extend(spark, rows):
    path = fresh_path(spark, "labels")
    model = encoder("keep").fit(rows)
    model.save(path)
    before = coded(model.transform(rows))
    newer = spark.createDataFrame([("d", 1), ("e", 1), ("e", 7), ("a", 1), (None, 1)], "c string, z int")
    longer = lb.LabelEncoderModel.load(path).extended(newer)
    assert longer.version == 2 and longer.sizes == {"c": 5, "z": 4}
    longer.append_to(path)
    loaded = lb.LabelEncoderModel.load(path)
    table = {(r["column"], r["label"]): (r["idx"], r["version"]) for r in loaded.labels.collect()}
    assert table[("c", "e")] == (3.0, 2) and table[("c", "d")] == (4.0, 2) and table[("z", "7")] == (3.0, 2) and table[("c", "a")] == (0.0, 1)
    assert coded(loaded.at_version(1).transform(rows)) == before  # the old dictionary, vectors and sizes too
    assert [r[2] for r in coded(loaded.transform(rows))] == [r[2] for r in before]  # indexes that were given stay
    assert loaded.extended(newer).version == 2 and loaded.extended(newer).sizes == loaded.sizes  # nothing new
    with pytest.raises(ValueError, match="no earlier version"):
        model.append_to(path)


def test_inside_a_pipeline(spark, rows):
    path = fresh_path(spark, "pipeline")
    fitted = Pipeline(stages=[encoder("keep")]).fit(rows)
    fitted.write().save(path)
    assert coded(PipelineModel.load(path).transform(rows)) == coded(fitted.transform(rows))
    est = fresh_path(spark, "estimator")
    encoder("keep").save(est)
    assert lb.LabelEncoder.load(est).getInputCols() == ["c", "z"]


def test_odd_names_and_empty_frames(spark, rows):
    df = lb.LabelEncoder(inputCols=["odd.name"], outputCols=["i"], handleInvalid="keep").fit(rows).transform(rows)
    assert sorted(r["i"] for r in df.collect()) == [0.0, 0.0, 1.0, 1.0, 2.0]
    empty = encoder("keep").fit(rows.where("false"))
    assert empty.sizes == {"c": 0, "z": 0} and coded(empty.transform(rows))[0][2:] == (0.0, 0.0, 0, 0)
    assert empty.extended(rows).sizes == {"c": 3, "z": 3}


def test_all_columns_in_one_shuffle(spark, rows):
    plan = lb.label_counts(rows, ["c", "z", "odd.name"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_few_jobs(spark):
    from bandwise.plans import registry
    from tests.conftest import SMALL

    sc = spark.sparkContext
    sc.setJobGroup("labels", "labels")
    registry.REGISTRY["one_hot_multi"].run(spark, SMALL).write.format("noop").mode("overwrite").save()
    n = len(sc.statusTracker().getJobIdsForGroup("labels"))
    sc.setJobGroup("idle", "idle")
    assert n < 25, n
