"""Two-output cleaning: every row on one side, a reason for every bad cell, one scan."""

import pytest
from pyspark.sql import functions as F

from bandwise.operators import clean as cl
from bandwise.operators import quarantine as qu
from bandwise.session import fresh_path

PROFILE = {"i": "int", "d": "double", "day": "date"}
ROWS = [
    (1, "1", "1.5", "2020-01-31", "x"), (2, "abc", "1", "2020-01-01", "x"), (3, "3.7", "NaN", "2020-01-01", "x"), (4, "99999999999", "1e3", "2020-02-30", "x"),
    (5, None, "-", None, None), (6, " 7 ", "Infinity", "2020-01-01", ""), (1, "1", "1.5", "2020-01-31", "x"), (8, "", "1", "2020-01-01", "x"),
]
SCHEMA = "id int, i string, d string, day string, note string"


def cells(rejected):
    return sorted(((r["id"], r["column"], r["raw"], r["reason"]) for r in qu.rejected_cells(rejected).select("record.id", "column", "raw", "reason").collect()), key=str)


def test_every_row_is_on_one_side_with_reasons(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept, rejected = qu.split(df, PROFILE)
    assert kept.dtypes == [("id", "int"), ("i", "int"), ("d", "double"), ("day", "date"), ("note", "string")]
    assert sorted((r["id"], r["i"], r["d"]) for r in kept.collect()) == [(1, 1, 1.5), (1, 1, 1.5), (6, 7, float("inf"))]
    assert sorted(r["id"] for r in rejected.select("record.id").collect()) == [2, 3, 4, 5, 8]
    assert cells(rejected) == sorted(
        [(2, "i", "abc", "not a number"), (3, "d", "NaN", "not a number"), (4, "i", "99999999999", "out of range"), (4, "day", "2020-02-30", "not a date"),
         (5, "i", None, "missing"), (5, "d", "-", "not a number"), (5, "day", None, "missing"), (5, "note", None, "missing"), (8, "i", "", "not a number")], key=str
    )
    back = rejected.select("record.*").unionByName(df.join(kept.select("id").distinct(), "id", "left_semi").select(*df.columns))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)


def test_kept_is_clean_without_lost_cells(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = qu.split(df, PROFILE)[0]
    plain = cl.clean(df, PROFILE).where("i IS NOT NULL AND NOT isnan(d) AND d IS NOT NULL AND day IS NOT NULL")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, qu.clean_kept(df, PROFILE).collect())) == sorted(map(tuple, kept.collect()))


def test_fractions_and_optional_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept, rejected = qu.split(df, {"i": "int"}, required=["id"], fractions="reject")
    assert cells(rejected) == sorted([(2, "i", "abc", "not a number"), (3, "i", "3.7", "fraction"), (4, "i", "99999999999", "out of range"), (8, "i", "", "not a number")])
    assert [r["i"] for r in kept.where("id = 5").collect()] == [None]
    with pytest.raises(ValueError, match="columns missing: z"):
        qu.split(df, {"z": "int"})
    with pytest.raises(ValueError, match="fractions"):
        qu.split(df, PROFILE, fractions="round")


def test_typed_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 2**40), (2, float("nan"), 5), (3, None, None)], "id int, x double, n long")
    kept, rejected = qu.split(df, {"x": "double", "n": "int"})
    assert kept.count() == 0
    assert cells(rejected) == sorted([(1, "n", str(2**40), "out of range"), (2, "x", "NaN", "missing"), (3, "x", None, "missing"), (3, "n", None, "missing")], key=str)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_torn_lines(spark, fmt):
    path = fresh_path(spark, "lines")
    lines = {
        "csv": ["a,b", "1,2", "3", "4,5,6", '"7",x', ""],
        "json": ['{"a": "1", "b": 2}', '{"a": "3"', "4,5,6", '{"a": 7, "b": "x"}'],
    }[fmt]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    kept, rejected = qu.split(qu.read_permissive(spark, path, ["a", "b"], fmt), {"a": "int", "b": "int"})
    assert [tuple(r) for r in kept.collect()] == [(1, 2)]
    found = {(r["column"], r["raw"], r["reason"]) for r in qu.rejected_cells(rejected).collect()}
    assert found == {(None, {"csv": "3", "json": '{"a": "3"'}[fmt], "corrupt record"), (None, "4,5,6", "corrupt record"), ("b", "x", "not a number")}
    assert {(r["column"], r["reason"], r["cells"]) for r in qu.reject_summary(rejected).collect()} == {(None, "corrupt record", 2), ("b", "not a number", 1)}


def test_readmit_after_repairs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept, rejected = qu.split(df, PROFILE)
    again, still = qu.readmit(rejected, {"i": F.when(F.col("i") == "abc", F.lit("12")).otherwise(F.col("i"))}, PROFILE)
    assert [(r["id"], r["i"]) for r in again.collect()] == [(2, 12)]
    assert kept.count() + again.count() + still.count() == len(ROWS)


def test_one_scan_and_each_side_reads_its_partition(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    source = fresh_path(spark, "source")
    df.write.parquet(source)
    kept, rejected = qu.split(spark.read.parquet(source), PROFILE)
    for side, value in ((kept, "true"), (rejected, "false")):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and source not in plan and "PartitionFilters: [isnotnull(ok" in plan, value


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    kept, rejected = qu.split(empty, PROFILE)
    assert kept.count() == rejected.count() == 0
    odd = spark.createDataFrame([("1", "a", True, "r"), ("x", "b", False, "s")], "i string, problems string, ok boolean, `record.x` string")
    kept, rejected = qu.split(odd, {"i": "int"})
    assert [tuple(r) for r in kept.collect()] == [(1, "a", True, "r")] and rejected.select("record.*").first()["problems"] == "b"
