"""Label index tables and sparse one-hot vectors."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from bandwise.operators import clean as cl
from bandwise.operators import encode as enc


def test_index_equals_string_indexer(spark):
    rows = spark.range(500).select(F.concat(F.lit("l"), (F.col("id") * F.col("id") % 37).cast("string")).alias("c"), "id")
    want = StringIndexer(inputCol="c", outputCol="want").fit(rows).transform(rows)
    got = enc.string_index(want, "c", "got")
    assert got.where("got <> want OR got IS NULL").count() == 0 and got.count() == 500


def test_null_labels(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    with pytest.raises(Exception, match="NULL label"):
        enc.string_index(rows, "c", "i").collect()
    assert sorted(r["i"] for r in enc.string_index(rows, "c", "i", "skip").collect()) == [0.0, 0.0, 1.0]
    assert sorted(r["i"] for r in enc.string_index(rows, "c", "i", "keep").collect()) == [0.0, 0.0, 1.0, 2.0]


def test_one_hot_stays_sparse(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "c string, z int")
    df = enc.one_hot_many(rows, ["c", "z"])
    got = df.select("c", "z", *[f(F.col(v)).alias(f"{f.__name__}_{v}") for v in ("c_vec", "z_vec") for f in (enc.one_hot_size, enc.one_hot_active)])
    assert sorted(map(tuple, got.collect())) == [("a", 1, 2, 0, 2, 0), ("a", 2, 2, 0, 2, 1), ("b", 1, 2, 1, 2, 0)]
    udfs = [d._jdf.queryExecution().executedPlan().toString().count("UDF(") for d in (df.select("c_vec"), got.select("one_hot_size_c_vec"))]
    assert udfs[0] == udfs[1]  # the encoder's own one; reading size and position adds none


def test_clean_names_missing_columns(spark):
    df = spark.createDataFrame([(1, "2")], "branchcode int, MATERIALCODE string")
    with pytest.raises(ValueError, match="avgPrice"):
        cl.clean(df, "basic_score")
    assert cl.cast_columns(df, {"BranchCode": "int", "MaterialCode": "int"}).first()[1] == 2


def test_drop_incomplete_lets_outer_joins_become_inner(spark):
    a, b = spark.range(10).withColumn("x", F.lit(1.0)), spark.range(5).withColumn("y", F.when(F.col("id") > 1, F.lit(float("nan"))).otherwise(F.lit(2.0)))
    df = cl.drop_incomplete(a.join(b, "id", "left"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" in plan and "LeftOuter" not in plan
    assert sorted(r["id"] for r in df.collect()) == [0, 1]
