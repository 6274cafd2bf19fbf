"""Drop-in names for notebooks written against the original helper module.

Each function keeps the original name and argument order and delegates to the
Spark-native operator; nothing is re-implemented here. Differences: models
and tables are passed in instead of read from globals or a warehouse, the
date is a real date, and the evaluation helpers that append to a list run one
Spark job per band instead of one per metric. For whole reports prefer
``operators.evaluate.range_report`` / ``over_under_report`` (one job for all
bands).
"""

from __future__ import annotations

from functools import partial

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions import calendar as cal
from bandwise.functions import scoring as sc
from bandwise.operators import clean as cl
from bandwise.operators import encode as enc
from bandwise.operators import enrich as en
from bandwise.operators import evaluate as ev
from bandwise.operators import models as mo
from bandwise.operators import sampling as sa
from bandwise.operators import weather as we
from bandwise.session import checkpointed
from bandwise.sources import files

# --- sampling ---------------------------------------------------------------


stratified_split_train_test = sa.stratified_split

# --- scalar lookups (plain Python, for notebooks and tests) -----------------

_HOLIDAY = {k: n for k, n, _ in cal.HOLIDAYS}
_HOLIDAY_TYPE = {k: t for k, _, t in cal.HOLIDAYS}
_TIER = dict(cal.TIER_NUMBERS)


def holiday(dm: str | None) -> str:
    return _HOLIDAY.get(dm, cal.NORMAL_DAY)


def holiday_type(dm: str | None) -> str:
    return _HOLIDAY_TYPE.get(dm, cal.NORMAL_DAY)


def welfare(ym: str | None) -> int:
    return cal.WELFARE_LOW if ym in cal.WELFARE_LOW_MONTHS else cal.WELFARE_HIGH


def tier_convert(t: str | None) -> int:
    return _TIER.get(t, cal.TIER_DEFAULT)


# --- stores and weather -----------------------------------------------------


query_store_location = we.store_location
map_weather_to_store = we.map_weather_to_store


def query_weather(weather: DataFrame, stations: DataFrame, year: int | None = None) -> DataFrame:
    return we.weather_latest(weather, stations, "TH", year)


# --- encoders ---------------------------------------------------------------


one_hot_encoder_ProvinceEN = partial(enc.one_hot, prefix="ProvinceEN")
one_hot_encoder_DistrictEN = partial(enc.one_hot, prefix="DistrictEN")
one_hot_encoder_ZipCode = partial(enc.one_hot, prefix="ZipCode")
one_hot_encoder_promotion = partial(enc.one_hot, prefix="promotion")
one_hot_encoder_holiday = partial(enc.one_hot, prefix="holiday")
one_hot_encoder_holidaytype = partial(enc.one_hot, prefix="holidaytype")
one_hot_encoder_tier = partial(enc.one_hot, prefix="tier")
string_indexer_tier = enc.string_index
convert_string_to_numeric = enc.string_index_multi

# --- calendar, tier, welfare ------------------------------------------------

encode_holiday = cal.encode_calendar
encode_tier = cal.encode_tier
encode_welfare = cal.encode_welfare
extract_date = cal.extract_date
rename = cal.rename_parts


transform_welfare_flag = en.welfare_branch_flag


def transform_welfare_flag_day(df: DataFrame, day: str = "DDDD") -> DataFrame:
    return cal.add_welfare_day_flag(df, day)


transform_welfare_flag_day_2 = partial(transform_welfare_flag_day, day="DayofMonth")

# --- joins and dimension prep ----------------------------------------------

transform_ps = en.price_sensitivity_dim
transform_tier = en.tier_dim


join_df_with_ps = en.join_price_sensitivity
join_df_with_tier = en.join_tier
join_df_with_weather = en.join_weather


def read_file(df: str, _format: str, spark: SparkSession | None = None, schema=None) -> DataFrame:
    spark = spark or SparkSession.getActiveSession()
    return files.read_file(spark, df, _format, schema=schema)


# --- cleaning ---------------------------------------------------------------


clean = partial(cl.clean, profile="full")
clean_basic = partial(cl.clean, profile="basic_train")
clean_basic_v2 = clean_basic2 = partial(cl.clean, profile="basic_score")
clean_binary = partial(cl.clean, profile="binary_train")
clean_binary_2 = clean_binary_2_2 = partial(cl.clean, profile="binary_score")
clean_binary_3 = partial(cl.clean, profile="dow_train")
clean_binary_3_2 = partial(cl.clean, profile="dow_score")
clean_binary_4 = partial(cl.clean, profile="dow_freq_score")
select_variable = cl.select_variable
count_column_types = cl.column_type_counts

# --- post scoring -----------------------------------------------------------


post_score = partial(sc.post_score, pred="predict_qty", day="Day")
post_score_v2 = partial(sc.post_score, pred="predict_qty", day="DayofMonth")


def post_score_v3(df: DataFrame, pred: str = "pred_final") -> DataFrame:
    return sc.post_score(df, pred, "DayofMonth", out=f"{pred}_post")


# --- evaluation -------------------------------------------------------------


def _append_metrics(scored: DataFrame, label: str, pred: str, lo, hi, l: list) -> None:
    """One job: the band's metrics, appended as rmse, mse, r2, mae (text) and count."""
    r = ev.regression_metrics(scored.filter(F.col(label).between(lo, hi)), label, pred).first()
    if r["count"]:
        l.extend(str(r[m]) for m in ("rmse", "mse", "r2", "mae"))
    l.append(r["count"])


def evalEachClass(df: DataFrame, lower_bound, upper_bound, l: list, m: Transformer, pred: str = "predict_qty") -> None:  # noqa: N802
    _append_metrics(mo.score(df.filter(F.col("label").between(lower_bound, upper_bound)), m, pred), "label", pred, lower_bound, upper_bound, l)


def evalEachClass_BinaryModel(  # noqa: N802
    df: DataFrame, lower_bound, upper_bound, l: list, m1: Transformer, m2: Transformer, pred: str = "pred_final"
) -> None:
    part = df.filter(F.col("TotalQtySale").between(lower_bound, upper_bound))
    _append_metrics(mo.two_stage_score(part, m1, m2, out=pred), "TotalQtySale", pred, lower_bound, upper_bound, l)


def _exact(value: int):
    def run(df, lower_bound, upper_bound, l, m1, m2, pred: str = "pred_final"):
        part = df.filter(F.col("TotalQtySale") == value)
        _append_metrics(mo.two_stage_score(part, m1, m2, out=pred), "TotalQtySale", pred, value, value, l)

    return run


evalEachClass_BinaryModel0 = _exact(0)  # noqa: N816
evalEachClass_BinaryModel1 = _exact(1)  # noqa: N816
evalEachClass_BinaryModel2 = _exact(2)  # noqa: N816
evalEachClass_BinaryModel3 = _exact(3)  # noqa: N816


def to_Report1(df: DataFrame, name_csv: str, list_criterea: list, bands=None) -> DataFrame:  # noqa: N802
    """Report 1 from the appended list (empty bands contribute only a count), written as CSV."""
    spark = df.sparkSession
    bands = sc.SALES_BANDS if bands is None else bands
    rows, it = [], iter(list_criterea)
    for lo, hi in bands:
        vals = []
        for v in it:
            vals.append(v)
            if not isinstance(v, str):
                break
        metrics = [None if v == "None" else float(v) for v in vals[:-1]] if len(vals) == 5 else [None] * 4
        rows.append((sc.band_label(lo, hi), *metrics, int(vals[-1]) if vals else 0))
    rep = spark.createDataFrame(rows, "Range string, rmse double, mse double, r2 double, mae double, count long")
    rep = rep.withColumn("all", F.lit(df.count())).select("Range", "mae", "rmse", "mse", "r2", "count", "all")
    files.write_report_csv(rep, name_csv)
    return rep


def to_Report2(l: list, name_csv: str) -> DataFrame:  # noqa: N802
    rep = ev.union_reports(*l)
    files.write_report_csv(rep, name_csv)
    return rep


def to_Clear(df: DataFrame, persistedModel: Transformer, pred: str = "predict_qty") -> DataFrame:  # noqa: N802, N803
    return sc.classify_error(mo.score(df, persistedModel, pred), "label", pred)


def to_Clear_BinaryModel(df: DataFrame, m1: Transformer, m2: Transformer) -> DataFrame:  # noqa: N802
    return sc.classify_error(mo.two_stage_score(df, m1, m2, out="predict_qty"), "TotalQtySale", "predict_qty")


def _over_under_band(df, label: str, lower, upper, l: list, exact=None) -> None:
    band = [(lower, upper)] if exact is None else [(exact, exact)]
    rep = ev.over_under_report(df, label, "predict_qty", bands=band)
    rep = checkpointed(rep.withColumn("Range", F.lit(f"{lower}-{upper}")))  # at most two rows, read twice
    for kind in (sc.LOWER, sc.UPPER):
        l.append(rep.filter(F.col("prediction_type") == kind).drop("band_id"))


def evalEachClass2(df: DataFrame, lower, upper, l: list) -> None:  # noqa: N802
    _over_under_band(df, "label", lower, upper, l)


def evalEachClass2_BinaryClass(df: DataFrame, lower, upper, l: list) -> None:  # noqa: N802
    _over_under_band(df, "TotalQtySale", lower, upper, l)


def _exact2(value: int):
    def run(df, lower, upper, l):
        _over_under_band(df, "TotalQtySale", lower, upper, l, exact=value)

    return run


evalEachClass2_BinaryClass0 = _exact2(0)  # noqa: N816
evalEachClass2_BinaryClass1 = _exact2(1)  # noqa: N816
evalEachClass2_BinaryClass2 = _exact2(2)  # noqa: N816
evalEachClass2_BinaryClass3 = _exact2(3)  # noqa: N816
