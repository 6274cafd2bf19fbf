import datetime as dt

from pyspark.sql import functions as F

from bandwise.functions import calendar as cal


def _one_col(spark, values, name, dtype):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def test_all_holidays_normal_and_null(spark):
    dates = [dt.date(2020, int(m), int(d)) for d, m in (k.split("-") for k, _, _ in cal.HOLIDAYS)]
    df = spark.createDataFrame([(d,) for d in dates + [dt.date(2020, 7, 7), None]], "SalDate date")
    rows = cal.encode_calendar(df).select("DDDD-MMMM", "Holiday", "HolidayType").collect()
    got = [(r[0], r[1], r[2]) for r in rows]
    assert got[:20] == [tuple(h) for h in cal.HOLIDAYS]
    assert got[20] == ("7-7", "Normal", "Normal")
    assert got[21] == (None, "Normal", "Normal")


def test_day_keys_are_unpadded_and_strings_parse(spark):
    df = spark.createDataFrame([("2021-04-04", "12", "7"), ("not a date", "x", "8")], "SalDate string, Branchcode string, MaterialCode string")
    r = cal.encode_calendar(df).collect()
    assert r[0]["DDDD-MMMM"] == "4-4" and r[0]["YYYY-MMMM"] == "2021-4"
    assert r[0]["BranchCode"] == 12 and r[0]["MaterialCode"] == 7
    assert r[1]["YYYY"] is None and r[1]["Holiday"] == "Normal" and r[1]["BranchCode"] is None


def test_welfare_months(spark):
    keys = cal.WELFARE_LOW_MONTHS + ["2019-7", "2021-01", None]
    df = _one_col(spark, keys, "ym", "string")
    got = [r[0] for r in df.select(cal.welfare_amount(F.col("ym"))).collect()]
    assert got == ["500"] * 6 + ["700", "700", "700"]


def test_tier_numbers(spark):
    df = _one_col(spark, ["T1", "T2", "T3", "T4", "T5", "t1", None], "t", "string")
    assert [r[0] for r in df.select(cal.tier_number(F.col("t"))).collect()] == ["1", "2", "3", "4", "5", "5", "5"]


def test_month_quarter_edges_and_extract_date(spark):
    days = [8, 9, 16, 17, 24, 25]
    df = spark.createDataFrame([(dt.date(2021, 3, d),) for d in days], "SalDate date")
    out = cal.extract_date(df).collect()
    assert [r["MonthQuarter"] for r in out] == [0, 1, 1, 2, 2, 3]
    assert [r["DayofMonth"] for r in out] == days
    r = out[0]  # 2021-03-08 is a Monday
    assert (r["DayofWeek"], r["Quarter"], r["WeekOfYear"], r["Yearday"]) == (2, 1, 10, 67)


def test_extract_date_drops_all_null_rows(spark):
    df = spark.createDataFrame([(None, None), (dt.date(2021, 1, 1), 1)], "SalDate date, DayofMonth int")
    assert cal.extract_date(df).count() == 1


def test_welfare_day_flag_null_is_zero(spark):
    df = _one_col(spark, [1, 5, 6, None], "DDDD", "int")
    assert [r[0] for r in cal.add_welfare_day_flag(df).select("welfareFlagDay").collect()] == ["1", "1", "0", "0"]


def test_no_python_udf_in_calendar_plan(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "SalDate date")
    plan = cal.encode_calendar(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
