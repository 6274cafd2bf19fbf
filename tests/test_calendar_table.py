"""Interval rules against day-by-day Python; defaults, keys, broadcast bound."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bandwise.functions import calendar as cal
from bandwise.operators import calendar_table as ct
from bandwise.session import fresh_path

SCHEMA = f"{ct.RULES}, name string, type string"


def day(y, m, d):
    return dt.date(y, m, d)


RULES = [
    (day(2018, 4, 13), day(2018, 4, 15), True, day(2020, 6, 1), 0, "A", "x"),
    (day(2019, 4, 14), None, False, None, 0, "B", "x"),
    (day(2019, 4, 14), None, False, None, 0, "C", "a"),
    (day(2018, 12, 30), day(2019, 1, 2), True, None, 0, "End", "y"),
    (day(2018, 1, 1), None, True, None, 9, "New", "z"),
    (day(2020, 2, 29), None, True, None, None, "Leap", "l"),
    (None, day(2019, 1, 1), True, None, 99, "never", "n"),
    (day(2019, 6, 10), day(2019, 6, 8), False, None, 0, "backwards", "b"),
    (day(2030, 1, 1), None, True, None, 99, "later", "n"),
]


def brute(rules, d):
    best = None
    for first, last, yearly, until, priority, name, kind in rules:
        if first is None:
            continue
        length = max(0, ((last or first) - first).days)
        for k in range(0, 60 if yearly else 1):
            try:
                start = first.replace(year=first.year + k)
            except ValueError:
                continue
            if start <= d <= start + dt.timedelta(days=length) and (until is None or d <= until):
                best = max(best or (), (priority or 0, first, name, kind))
    return best[2:] if best else ("Normal", "Normal")


def test_rules_day_by_day(spark):
    days = [day(2017, 12, 25) + dt.timedelta(days=i) for i in range(1900)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "SalDate date")
    got = {r["SalDate"]: (r["Holiday"], r["HolidayType"]) for r in ct.encode_holidays(df, spark.createDataFrame(RULES, SCHEMA)).collect()}
    assert got == {d: brute(RULES, d) for d in days} | {None: ("Normal", "Normal")}


def test_random_rules_by_key(spark):
    rnd = random.Random(3)
    start = day(2018, 1, 1)
    rules = []
    for _ in range(60):
        first = start + dt.timedelta(days=rnd.randrange(900))
        until = rnd.choice([None, first + dt.timedelta(days=rnd.randrange(900))])
        rules.append((rnd.choice("pq"), first, first + dt.timedelta(days=rnd.randrange(9)), rnd.random() < 0.5, until, rnd.randrange(3), f"n{rnd.randrange(9)}", "t"))
    rows = [(rnd.choice(["p", "q", "r", None]), start + dt.timedelta(days=rnd.randrange(1100))) for _ in range(800)]
    df = spark.createDataFrame(rows, "region string, SalDate date")
    out = ct.encode_holidays(df, spark.createDataFrame(rules, f"region string, {SCHEMA}"), keys=["region"])
    got = sorted(((r["region"], r["SalDate"], r["Holiday"]) for r in out.collect()), key=str)
    assert got == sorted(((k, d, brute([x[1:] for x in rules if x[0] == k], d)[0]) for k, d in rows), key=str)


def test_defaults_equal_the_literal_encoders(spark):
    df = spark.range(1200).select(F.date_add(F.lit("2018-10-01").cast("date"), F.col("id").cast("int")).alias("SalDate"))
    assert ct.encode_calendar(df).exceptAll(cal.encode_calendar(df)).count() == 0
    keyed = cal.encode_calendar(df)
    assert ct.encode_welfare(keyed).exceptAll(cal.encode_welfare(keyed)).count() == 0


def test_text_dates_and_clashing_names(spark):
    df = spark.createDataFrame([("2019-04-14", "n", 1), ("bad", "m", 2), (None, "o", 3)], "SalDate string, name string, day int")
    out = ct.encode_holidays(df.withColumn("Holiday", F.lit("old")), spark.createDataFrame(RULES, SCHEMA))
    assert sorted((r["name"], r["day"], r["Holiday"]) for r in out.collect()) == [("m", 2, "Normal"), ("n", 1, "C"), ("o", 3, "Normal")]
    assert ct.encode_holidays(df.where("false"), spark.createDataFrame(RULES, SCHEMA)).count() == 0


def test_broadcast_only_below_the_bound(spark, monkeypatch):
    df = spark.createDataFrame([(day(2019, 4, 14),)], "SalDate date")
    hinted = "ResolvedHint (strategy=broadcast)"
    assert hinted in ct.encode_holidays(df)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(ct, "BROADCAST_DAYS", 0)
    assert hinted not in ct.encode_holidays(df)._jdf.queryExecution().analyzed().toString()
    assert ct.encode_holidays(df).first()["Holiday"] == "Songkran"


def test_rules_from_a_file(spark):
    path = fresh_path(spark, "rules")
    ct.default_holidays(spark).coalesce(1).write.option("header", "true").csv(path)
    assert ct.read_rules(spark, path).exceptAll(ct.default_holidays(spark)).count() == 0
    bad = fresh_path(spark, "rules")
    spark.createDataFrame([("first,last,yearly,until,priority,name,type",), ("2019-13-01,,true,,0,x,y",)], "value string").coalesce(1).write.text(bad)
    with pytest.raises(Exception, match="MALFORMED|FAILED|malformed"):
        ct.read_rules(spark, bad).collect()
