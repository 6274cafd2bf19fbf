"""Input tables of the forecasting pipeline, derived from the TPC-H-like TESTDATA.

The original module reads its sales, tier, price-sensitivity, store and weather
tables from files and a warehouse that are not public. These functions build
tables with the same schemas from ``lineitem``, ``orders``, ``part``,
``supplier``, ``nation`` and ``events`` so that every operator runs on data
that grows with the scale factor. ``plans/oracle.py`` holds the same
derivations as DuckDB SQL.

Rounded doubles use ``round(x + 1e-7, 4)``: without the nudge the two engines
break exact decimal ties differently.

The few modulo rules below are data design, not sampling: they give some rows of the
price-sensitivity and tier tables a branch that no sale has, so that left joins have
unmatched rows on both sides, damage some text cells for the cleaning checks, and
give the fixed classifier a "does not sell" class. Every table is still built
from, and every query still reads, the whole input tables.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture derivation (shared with plans/oracle.py).
DATE_SHIFT_MONTHS = 240  # ship dates move 20 years forward so 2019-2021 welfare months occur
RAW_TEXT_MODULUS = 97  # sales_raw_text damages rows where MaterialCode % 97 is 0, 1 or 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _r4(c):
    return F.round(c + F.lit(1e-7), 4)


def _sal_date():
    return F.add_months(F.to_date("l_shipdate"), DATE_SHIFT_MONTHS)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per (SalDate, BranchCode, MaterialCode); returned lines sell 0."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    daily = li.groupBy(
        _sal_date().alias("SalDate"),
        F.col("l_suppkey").cast("int").alias("BranchCode"),
        F.col("l_partkey").cast("int").alias("MaterialCode"),
    ).agg(
        F.sum(qty).cast("int").alias("TotalQtySale"),
        _r4(F.avg(F.col("l_extendedprice") / F.col("l_quantity"))).alias("avgPrice"),
        _r4(F.avg(net / F.col("l_quantity"))).alias("avgPriceDis"),
        _r4(F.sum(net)).alias("totalNetSale"),
    )
    # one row per part key (p_partkey is the key, so max() is the price): declared unique, the
    # left join is dropped by the optimizer in every plan that never reads supPrice
    part = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_partkey").cast("int").alias("MaterialCode"))
        .agg(F.max("p_retailprice").alias("supPrice"))
    )
    return daily.join(part, "MaterialCode", "left").select(
        "SalDate",
        "BranchCode",
        "MaterialCode",
        "TotalQtySale",
        "avgPrice",
        "avgPriceDis",
        "totalNetSale",
        "supPrice",
        F.dayofmonth("SalDate").alias("DayofMonth"),
        F.col("TotalQtySale").alias("label"),
    )


def sales_rollup(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """Sales summed per (branch, month) or (branch, year): fills the 61-3000 bands."""
    s = sales(spark, sf_dir)
    period = F.trunc("SalDate", "month" if grain == "month" else "year")
    return (
        s.groupBy(period.alias("SalDate"), "BranchCode")
        .agg(F.sum("TotalQtySale").cast("int").alias("TotalQtySale"))
        .withColumn("label", F.col("TotalQtySale"))
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows with the categorical columns the one-hot encoders take."""
    li = table(spark, sf_dir, "lineitem")
    supp = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    promo = li.groupBy(
        _sal_date().alias("SalDate"),
        F.col("l_suppkey").cast("int").alias("BranchCode"),
        F.col("l_partkey").cast("int").alias("MaterialCode"),
    ).agg(F.min("l_returnflag").alias("promotion"))
    where = supp.join(nation, supp.s_nationkey == nation.n_nationkey, "left").select(
        F.col("s_suppkey").cast("int").alias("BranchCode"),
        F.col("n_name").alias("ProvinceEN"),
        F.col("s_name").alias("DistrictEN"),
        (F.lit(10000) + F.col("s_nationkey")).alias("ZipCode"),
    )
    return promo.join(where, "BranchCode", "left")


def sales_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as an all-string file would arrive, with some damaged cells."""
    s = sales(spark, sf_dir)
    bad = F.col("MaterialCode") % RAW_TEXT_MODULUS

    def damaged(c):
        return (
            F.when(bad == 0, F.lit(None).cast("string"))
            .when(bad == 1, F.lit("abc"))
            .when(bad == 2, F.lit("3.7"))
            .otherwise(F.col(c).cast("string"))
        )

    out = []
    for c in s.columns:
        out.append((damaged(c) if c in ("avgPrice", "supPrice", "TotalQtySale") else F.col(c).cast("string")).alias(c))
    return s.select(out)


def price_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price-sensitivity file: Branch, MaterialCode, f0_.

    Materials with ``l_partkey % 4 == 0`` get a negative branch, so a left join keeps unmatched sales.
    """
    li = table(spark, sf_dir, "lineitem")
    branch = F.when(F.col("l_partkey") % 4 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
    return li.groupBy(
        branch.cast("int").alias("Branch"),
        F.col("l_partkey").cast("int").alias("MaterialCode"),
    ).agg(_r4(F.avg("l_discount")).alias("f0_"))


def tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw monthly tier file: BranchCode, MaterailCode (sic), CALYEAR, CALMONTH, Tier.

    Materials with ``l_partkey % 5 == 0`` get a negative branch (unmatched keys for the left join).
    """
    li = table(spark, sf_dir, "lineitem")
    branch = F.when(F.col("l_partkey") % 5 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    d = _sal_date()
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .groupBy(
            branch.cast("int").alias("BranchCode"),
            F.col("l_partkey").cast("int").alias("MaterailCode"),
            F.year(d).alias("CALYEAR"),
            F.month(d).alias("CALMONTH"),
        )
        # priorities start with one digit, so the minimum digit is the minimum text (hash-aggregable)
        .agg(F.concat(F.lit("T"), F.min(F.substring("o_orderpriority", 1, 1).cast("int")).cast("string")).alias("Tier"))
    )


def welfare_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = table(spark, sf_dir, "supplier")
    return supp.filter(F.col("s_suppkey") % 4 == 0).select(F.col("s_suppkey").cast("int").alias("branchcode"))


def store_location_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw store master: code, lat, lng."""
    supp = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return supp.select(
        k.cast("int").alias("code"),
        (F.lit(5) + (k * 37 % 160) / F.lit(10.0)).alias("lat"),
        (F.lit(97) + (k * 53 % 80) / F.lit(10.0)).alias("lng"),
    )


def customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer master: code, lat, lng (a store table that grows with the scale factor)."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("int").alias("code"),
        (F.lit(5) + (k * 41 % 1600) / F.lit(100.0)).alias("lat"),
        (F.lit(97) + (k * 59 % 800) / F.lit(100.0)).alias("lng"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-station master: usaf, name, lat, lon, country."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        k.alias("usaf"),
        F.col("n_name").alias("name"),
        (F.lit(5) + (k * 61 % 160) / F.lit(10.0)).alias("lat"),
        (F.lit(97) + (k * 29 % 80) / F.lit(10.0)).alias("lon"),
        F.when(k % 3 != 0, F.lit("TH")).otherwise(F.lit("XX")).alias("country"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station weather: stn, date, temp, max, min."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(
        (F.col("user_id") % 30).cast("int").alias("stn"),
        F.to_date("ts").alias("date"),
    ).agg(
        _r4(F.avg("value")).alias("temp"),
        F.max("value").alias("max"),
        F.min("value").alias("min"),
    )


def fixed_predictors() -> tuple[SQLTransformer, SQLTransformer]:
    """A model-free two-stage predictor, as MLlib transformers.

    Stage 1 ("does it sell") says yes unless MaterialCode % 5 == 0; stage 2
    ("how many") predicts 0.9 * quantity + 1. They stand in for fitted models
    wherever the result must be checked against SQL.
    """
    lv1 = SQLTransformer(
        statement="SELECT *, CASE WHEN MaterialCode % 5 > 0 THEN 1.0D ELSE 0.0D END AS pred_lv1 FROM __THIS__"
    )
    lv2 = SQLTransformer(statement="SELECT *, CAST(TotalQtySale AS DOUBLE) * 0.9D + 1.0D AS pred_lv2 FROM __THIS__")
    return lv1, lv2


def fixed_single_predictor() -> SQLTransformer:
    """A model-free single-stage predictor: predict_qty = 0.8 * label + 2."""
    return SQLTransformer(statement="SELECT *, CAST(label AS DOUBLE) * 0.8D + 2.0D AS predict_qty FROM __THIS__")
