from pyspark.sql import functions as F

from bandwise.operators import sampling as sa
from bandwise.sources import fixtures as fx
from tests.conftest import SMALL

KEY = ["SalDate", "BranchCode", "MaterialCode"]


def test_split_partitions_the_input(spark):
    s = fx.sales(spark, SMALL)
    smp, rest = sa.stratified_split(s, 0.7, "label", KEY)
    n, a, b = s.count(), smp.count(), rest.count()
    assert a + b == n and 0.6 * n < a < 0.8 * n
    assert smp.join(rest, KEY).count() == 0
    assert smp.unionByName(rest).exceptAll(s).count() == 0


def test_split_is_partitioning_independent(spark):
    s = fx.sales(spark, SMALL)
    a = sorted(map(tuple, sa.stratified_split(s, 0.3, "label", KEY)[0].select(*KEY).collect()))
    b = sorted(map(tuple, sa.stratified_split(s.repartition(17), 0.3, "label", KEY)[0].select(*KEY).collect()))
    assert a == b


def test_null_key_lands_in_both_halves_like_anti_join(spark):
    df = spark.createDataFrame([(None, 1), ("k1", 1), ("k2", 1)], "k string, label int")
    smp, rest = sa.stratified_split(df, 1.0, "label", ["k"])
    assert smp.count() == 3 and [r["k"] for r in rest.collect()] == [None]


def test_per_label_fractions(spark):
    s = fx.sales(spark, SMALL)
    smp, rest = sa.stratified_split(s, {0: 1.0}, "label", KEY)
    assert smp.filter(F.col("label") != 0).count() == 0
    assert smp.count() == s.filter(F.col("label") == 0).count()


def test_exact_split_counts_every_label(spark):
    import math

    s = fx.sales(spark, SMALL).unionByName(fx.sales(spark, SMALL).withColumn("label", F.lit(None).cast("int")).limit(7))
    for frac in (0.0, 0.31, 0.7, 1.0):
        smp, rest = sa.stratified_split(s, frac, "label", KEY, exact=True)
        n, got, left = ({r["label"]: r["n"] for r in d.groupBy("label").agg(F.count("*").alias("n")).collect()} for d in (s, smp, rest))
        assert got == {k: math.ceil(v * frac) for k, v in n.items() if math.ceil(v * frac)}
        assert left == {k: v - got.get(k, 0) for k, v in n.items() if v > got.get(k, 0)}
    a = sorted(map(tuple, sa.stratified_split(s.repartition(11), 0.31, "label", KEY, exact=True)[0].select(*KEY).collect()))
    assert a == sorted(map(tuple, sa.stratified_split(s, 0.31, "label", KEY, exact=True)[0].select(*KEY).collect()))
