"""A notebook-style flow written with the original helper names gives the registry's results."""

from pyspark.sql import functions as F

from bandwise import compat as C
from bandwise.functions.scoring import SALES_BANDS
from bandwise.operators import evaluate as ev
from bandwise.plans import registry
from bandwise.session import fresh_path
from bandwise.sources import fixtures as fx
from tests.conftest import SMALL


def test_scalar_lookups():
    assert (C.holiday("13-4"), C.holiday_type("9-5"), C.holiday("2-2")) == ("Songkran", "Goverment", "Normal")
    assert (C.welfare("2020-10"), C.welfare("2020-9"), C.tier_convert("T3"), C.tier_convert(None)) == (500, 700, 3, 5)


def test_feature_flow_with_original_names(spark):
    sales = fx.sales(spark, SMALL)
    df = C.encode_holiday(sales)
    df = C.join_df_with_ps(df, C.transform_ps(fx.price_sensitivity(spark, SMALL)))
    df = C.join_df_with_tier(df, C.transform_tier(fx.tier(spark, SMALL)))
    df = C.encode_welfare(C.encode_tier(df))
    df = C.transform_welfare_flag_day(C.transform_welfare_flag(df, fx.welfare_branches(spark, SMALL)))
    df = C.rename(df)
    bw = C.map_weather_to_store(
        C.query_store_location(fx.store_location_raw(spark, SMALL)),
        C.query_weather(fx.weather(spark, SMALL), fx.stations(spark, SMALL), 2024),
    )
    df = C.clean(C.join_df_with_weather(df, bw))
    want = registry.q_clean_full(spark, SMALL)
    got = df.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_per_band_evaluation_with_original_names(spark):
    sales = fx.sales(spark, SMALL)
    lv1, lv2 = fx.fixed_predictors()
    l = []
    for lo, hi in SALES_BANDS:
        C.evalEachClass_BinaryModel(sales, lo, hi, l, lv1, lv2)
    rep = C.to_Report1(sales, fresh_path(spark, "compat_r1"), l)
    one_pass = {r["Range"]: r for r in ev.range_report(registry._scored_two_stage(spark, SMALL)).collect()}
    for r in rep.collect():
        o = one_pass[r["Range"]]
        assert r["count"] == o["count"] and r["all"] == o["all"]
        if o["count"]:
            assert abs(r["mae"] - o["mae"]) < 1e-9 and abs(r["rmse"] - o["rmse"]) < 1e-9

    clear = C.to_Clear_BinaryModel(sales, lv1, lv2)
    parts = []
    for lo, hi in SALES_BANDS:
        C.evalEachClass2_BinaryClass(clear, lo, hi, parts)
    rep2 = C.to_Report2(parts, fresh_path(spark, "compat_r2"))
    assert rep2.agg(F.sum("count_of_each_part")).first()[0] == clear.filter(F.col("TotalQtySale").between(0, 3000)).count()
