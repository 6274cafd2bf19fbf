"""A third of all rows on one key: joins split the hot partition, aggregates merge map-side."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bandwise.functions.calendar import encode_calendar
from bandwise.operators import enrich as en
from bandwise.operators import evaluate as ev


@pytest.fixture()
def skewed(spark):
    n = 30000
    base = spark.range(n).select(
        # the hot rows vary by day but share one (branch, material, year, month) join key
        F.when(F.col("id") % 3 == 0, F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 31).cast("int")))
        .otherwise(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 60).cast("int")))
        .alias("SalDate"),
        # one (branch, material) holds a third of the rows
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 97).cast("int") + 2).alias("BranchCode"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 89).cast("int") + 2).alias("MaterialCode"),
        (F.col("id") % 7).cast("int").alias("TotalQtySale"),
    )
    tier = (
        base.select(
            F.col("BranchCode"),
            F.col("MaterialCode").alias("MaterailCode"),
            F.year("SalDate").alias("CALYEAR"),
            F.month("SalDate").alias("CALMONTH"),
        )
        .distinct()
        .withColumn("Tier", F.lit("T2"))
        .checkpoint()  # a stored dimension table, as in production
    )
    return base, tier


def test_hot_key_join_is_split_and_exact(spark, skewed):
    base, tier = skewed
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = en.join_tier(encode_calendar(base), en.tier_dim(tier))
        rows = joined.collect()  # runs this very plan, so AQE finalises it
        assert len(rows) == base.count() and all(r["Tier"] == "T2" for r in rows)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_band_is_merged_map_side(spark, skewed):
    base, _ = skewed
    scored = base.withColumn("pred", F.col("TotalQtySale") * 1.1)
    rep = ev.range_report(scored, "TotalQtySale", "pred")
    rows = rep.collect()
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # partial aggregate before the band shuffle
    assert sum(r["count"] for r in rows) == base.count()


def test_salted_joins_equal_plain_joins(spark, skewed):
    base, tier = skewed
    cal = encode_calendar(base)
    plain = en.join_tier(cal, en.tier_dim(tier))
    salted = en.join_tier(cal, en.tier_dim(tier), salt=8)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    ps = base.groupBy(F.col("BranchCode").alias("Branch"), "MaterialCode").agg(F.avg("TotalQtySale").alias("f0_"))
    a = en.join_price_sensitivity(base, en.price_sensitivity_dim(ps), how="inner")
    b = en.join_price_sensitivity(base, en.price_sensitivity_dim(ps), how="inner", salt=5)
    assert a.count() == base.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("how", ["right", "full", "outer", "left_semi"])
def test_salted_joins_are_inner_or_left(spark, skewed, how):
    base, tier = skewed
    with pytest.raises(ValueError, match="inner or left"):
        en.join_tier(encode_calendar(base), en.tier_dim(tier), how=how, salt=4)


def test_null_keys_are_spread_and_kept(spark, skewed):
    """A third of the rows has no key: a left join keeps them all, and no task gets them all."""
    base, tier = skewed
    holed = base.withColumn("BranchCode", F.when(F.col("BranchCode") != 1, F.col("BranchCode")))
    cal = encode_calendar(holed)
    plain, salted = en.join_tier(cal, en.tier_dim(tier)), en.join_tier(cal, en.tier_dim(tier), salt=8)
    assert salted.count() == holed.count()
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nulls = en.join_tier(cal, en.tier_dim(tier), salt=8).where("BranchCode IS NULL")
        sizes = [r["n"] for r in nulls.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) >= 4 and max(sizes) < 0.6 * sum(sizes)


def test_only_hot_keys_are_copied(spark, skewed):
    base, _ = skewed
    assert [tuple(r) for r in en.hot_keys(base, ["BranchCode", "MaterialCode"], 0.1).collect()] == [(1, 1)]
