import math

from bandwise.operators import clean as cl


def test_lenient_casts_and_dropna(spark):
    df = spark.createDataFrame(
        [("3.7", "1.5", "x"), ("abc", "2", "y"), (None, "3", "z"), ("4", "nan", "w")],
        "TotalQtySale string, avgPrice string, tag string",
    )
    out = cl.clean(df, {"TotalQtySale": "int", "avgPrice": "double"}).collect()
    # the NULL row is dropped before the casts; 'abc' becomes NULL and is kept
    assert [r["TotalQtySale"] for r in out] == [3, None, 4]
    assert out[0]["avgPrice"] == 1.5 and math.isnan(out[2]["avgPrice"])


def test_dropna_removes_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert cl.drop_incomplete(df).count() == 1
    # NaN counts as missing for "all" too (Spark's na.drop semantics)
    assert cl.drop_all_null(df).count() == 1


def test_profiles_cover_original_variants():
    p = cl.CAST_PROFILES
    assert "Total_Bill_Dow" not in p["dow_freq_score"] and p["dow_freq_score"]["MostSalesUnitFreq"] == "double"
    assert "label" not in p["basic_score"] and p["basic_train"]["label"] == "int"
    assert p["full"]["supPrice"] == "int" and p["basic_train"]["supPrice"] == "double"


def test_profile_columns_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "b")], "a int, b string")
    rows = {r["column_name"]: r for r in cl.profile_columns(df, approx_distinct=True).collect()}
    assert (rows["a"]["non_null"], rows["a"]["n_null"], rows["a"]["data_type"]) == (2, 1, "int")
    assert rows["b"]["approx_distinct"] == 2


def test_column_type_counts(spark):
    df = spark.createDataFrame([(1, 2, "a")], "a int, b int, c string")
    got = {r["type"]: (r["count"], r["names"]) for r in cl.column_type_counts(df).collect()}
    assert got == {"int": (2, "a | b"), "string": (1, "c")}
