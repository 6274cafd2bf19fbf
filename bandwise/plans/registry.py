"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query reads the TESTDATA tables of ``sf_dir`` (through
``sources/fixtures.py``) so its work grows with the data. Doubles that come
out of an aggregate are rounded to 6 places (after a 1e-9 nudge) on both
sides: the two engines add floating-point values in different orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions import calendar as cal
from bandwise.functions.scoring import SALES_BANDS, classify_error, post_score
from bandwise.operators import calendar_table as ct
from bandwise.operators import clean as cl
from bandwise.operators import encode as enc
from bandwise.operators import enrich as en
from bandwise.operators import evaluate as ev
from bandwise.operators import labels as lb
from bandwise.operators import models as mo
from bandwise.operators import profile as pr
from bandwise.operators import profile_state as ps
from bandwise.operators import quarantine as qu
from bandwise.operators import report_state as rs
from bandwise.operators import sampling as sa
from bandwise.operators import sphere as sp
from bandwise.operators import weather as we
from bandwise.operators import weather_state as ws
from bandwise.plans import features as fe
from bandwise.plans import oracle as o
from bandwise.plans.oracle import r6, with_fixtures
from bandwise.session import fresh_path
from bandwise.sources import files
from bandwise.sources import fixtures as fx

KEY = ["SalDate", "BranchCode", "MaterialCode"]
KEY_SQL = "SalDate, BranchCode, MaterialCode"
WEATHER_YEAR = 2024  # the year of the events table behind the weather fixture
SPLIT_FRACTION = 0.7


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn

    return deco


def round6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-9), 6) for c in cols})


# --------------------------------------------------------------------------- inputs


def _sales(spark, sf):
    return fx.sales(spark, sf)


def _scored_two_stage(spark, sf, out="pred_final"):
    lv1, lv2 = fx.fixed_predictors()
    return mo.two_stage_score(_sales(spark, sf), lv1, lv2, out=out)


def _scored_single(spark, sf):
    return mo.score(_sales(spark, sf), fx.fixed_single_predictor())


def _branch_weather(spark, sf, k=1):
    return we.nearest_station(
        we.store_location(fx.store_location_raw(spark, sf)),
        we.weather_latest(fx.weather(spark, sf), fx.stations(spark, sf), "TH", WEATHER_YEAR),
        k=k,
    )


def _features(spark, sf):
    bw = _branch_weather(spark, sf).select("BranchCode", "name", "temp")
    return fe.prepare_features(
        _sales(spark, sf), fx.price_sensitivity(spark, sf), fx.tier(spark, sf), fx.welfare_branches(spark, sf), bw
    )


def _binary_features(spark, sf):
    zips = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("BranchCode"), (F.lit(10000) + F.col("s_nationkey")).alias("ZipCode")
    )
    df = (
        cal.encode_calendar(_sales(spark, sf))
        .transform(lambda d: en.welfare_branch_flag(d, fx.welfare_branches(spark, sf)))
        .transform(cal.add_welfare_day_flag)
        .transform(cal.rename_parts)
        .join(zips, "BranchCode", "left")
    )
    return df.select(
        *KEY, "TotalQtySale", "avgPrice", "avgPriceDis", "totalNetSale", "supPrice", "label", "Year", "ZipCode",
        "welfareFlag", "welfareFlagDay",
    )


def _dow_features(spark, sf):
    prof = pr.dow_sales_profile(_sales(spark, sf)).withColumn(
        "HighQualityFlag", (F.col("NumWeekSale") >= 2).cast("int")
    )
    b = _binary_features(spark, sf).withColumn("DoW_Num", F.dayofweek("SalDate"))
    return b.join(prof, ["BranchCode", "MaterialCode", "DoW_Num"])


# --------------------------------------------------------------------------- evaluation (flagship first)

_METRICS = ("mae", "rmse", "mse", "r2")


def _range_sql(source: str, label: str, pred: str, with_all: bool, *deps: str, bands=None) -> str:
    return with_fixtures(
        f"""
src AS (SELECT {o.band_case(label, bands)} AS band_id, CAST({label} AS DOUBLE) AS l, CAST({pred} AS DOUBLE) AS p FROM {source}),
agg AS (SELECT band_id, COUNT(*) AS n, COUNT(p - l) AS n_scored, SUM((p - l) * (p - l)) AS _sse,
               SUM(abs(p - l)) AS _sae, VAR_POP(CASE WHEN p - l IS NOT NULL THEN l END) AS _var,
               MIN(CASE WHEN p - l IS NOT NULL THEN l END) AS _lmin, MAX(CASE WHEN p - l IS NOT NULL THEN l END) AS _lmax
        FROM src GROUP BY band_id),
bands AS ({o.bands_values(bands)})
SELECT b.band_id, b.Range, b.lower, b.upper,
       {r6("a._sae / NULLIF(a.n_scored, 0)")} AS mae,
       {r6("sqrt(a._sse / NULLIF(a.n_scored, 0))")} AS rmse,
       {r6("a._sse / NULLIF(a.n_scored, 0)")} AS mse,
       CASE WHEN a._lmin < a._lmax THEN {r6("1 - a._sse / (a._var * a.n_scored)")} END AS r2,
       COALESCE(a.n, 0) AS count, COALESCE(a.n_scored, 0) AS n_scored
       {', CAST((SELECT SUM(n) FROM agg) AS BIGINT) AS "all"' if with_all else ""}
FROM bands b LEFT JOIN agg a ON a.band_id = b.band_id""",
        *deps,
    )


@register("range_report", _range_sql("scored", "TotalQtySale", "pred_final", True, "scored"))
def q_range_report(spark, sf):
    return round6(ev.range_report(_scored_two_stage(spark, sf), "TotalQtySale", "pred_final"), *_METRICS)


@register("range_metrics_two_stage", _range_sql("scored", "TotalQtySale", "pred_final", False, "scored"))
def q_range_metrics_two_stage(spark, sf):
    return round6(ev.range_metrics(_scored_two_stage(spark, sf), "TotalQtySale", "pred_final"), *_METRICS)


# the original module's exact-value variants (quantity 0, 1, 2, 3) are the same report over four one-value bands
EXACT_BANDS = [(0, 0), (1, 1), (2, 2), (3, 3)]


@register(
    "range_metrics_exact", _range_sql("scored", "TotalQtySale", "pred_final", False, "scored", bands=EXACT_BANDS)
)
def q_range_metrics_exact(spark, sf):
    return round6(
        ev.range_metrics(_scored_two_stage(spark, sf), "TotalQtySale", "pred_final", bands=EXACT_BANDS), *_METRICS
    )


_MONTHLY_SCORED = "(SELECT *, CAST(label AS DOUBLE) * CAST(0.8 AS DOUBLE) + CAST(2 AS DOUBLE) AS predict_qty FROM sales_monthly)"


@register("range_metrics", _range_sql(_MONTHLY_SCORED, "label", "predict_qty", False, "sales_monthly"))
def q_range_metrics(spark, sf):
    monthly = mo.score(fx.sales_rollup(spark, sf, "month"), fx.fixed_single_predictor())
    return round6(ev.range_metrics(monthly, "label", "predict_qty"), *_METRICS)


_YEARLY_SCORED = "(SELECT *, CAST(label AS DOUBLE) * CAST(0.8 AS DOUBLE) + CAST(2 AS DOUBLE) AS predict_qty FROM sales_yearly)"


@register("range_metrics_yearly", _range_sql(_YEARLY_SCORED, "label", "predict_qty", True, "sales_yearly"))
def q_range_metrics_yearly(spark, sf):
    yearly = mo.score(fx.sales_rollup(spark, sf, "year"), fx.fixed_single_predictor())
    return round6(ev.range_report(yearly, "label", "predict_qty"), *_METRICS)


@register(
    "regression_metrics",
    with_fixtures(
        f"""
src AS (SELECT CAST(label AS DOUBLE) AS l, CAST(label AS DOUBLE) * CAST(0.8 AS DOUBLE) + CAST(2 AS DOUBLE) AS p FROM sales),
a AS (SELECT COUNT(*) AS n, COUNT(p - l) AS n_scored, SUM((p - l) * (p - l)) AS _sse, SUM(abs(p - l)) AS _sae,
             VAR_POP(CASE WHEN p - l IS NOT NULL THEN l END) AS _var,
             MIN(CASE WHEN p - l IS NOT NULL THEN l END) AS _lmin, MAX(CASE WHEN p - l IS NOT NULL THEN l END) AS _lmax
      FROM src)
SELECT {r6("_sae / NULLIF(n_scored, 0)")} AS mae, {r6("sqrt(_sse / NULLIF(n_scored, 0))")} AS rmse,
       {r6("_sse / NULLIF(n_scored, 0)")} AS mse, CASE WHEN _lmin < _lmax THEN {r6("1 - _sse / (_var * n_scored)")} END AS r2,
       n AS count, n_scored FROM a""",
        "sales",
    ),
)
def q_regression_metrics(spark, sf):
    return round6(ev.regression_metrics(_scored_single(spark, sf), "label", "predict_qty"), *_METRICS)


def _classified_sql(label: str, pred_expr: str, source: str) -> str:
    return f"""
ce AS (SELECT *, CASE WHEN {pred_expr} >= {label} THEN 'Upper' ELSE 'Lower' END AS prediction_type,
              CAST(abs({pred_expr} - {label}) AS DOUBLE) AS prediction_diff, {pred_expr} AS predict_qty
       FROM {source})"""


_SINGLE_PRED = "(CAST(label AS DOUBLE) * CAST(0.8 AS DOUBLE) + CAST(2 AS DOUBLE))"
_TWO_STAGE_PRED = "(pred_lv1 * pred_lv2)"
_OU_AVG = ("avgPriceDis", "avgPrice", "supPrice", "predict_qty", "prediction_diff")


def _over_under_sql(label: str, pred_expr: str, source: str, *deps: str, bands=None) -> str:
    avgs = ", ".join(f'{r6(f"AVG({c})")} AS "avg({c})"' for c in _OU_AVG)
    bands = SALES_BANDS if bands is None else bands
    lo, hi = min(b[0] for b in bands), max(b[1] for b in bands)
    return with_fixtures(
        f"""{_classified_sql(label, pred_expr, source)},
bands AS ({o.bands_values(bands)}),
b AS (SELECT {o.band_case(label, bands)} AS band_id, * FROM ce WHERE {label} BETWEEN {lo} AND {hi})
SELECT b.band_id, r.bounds AS Range, b.prediction_type, {avgs}, COUNT(*) AS count_of_each_part
FROM b JOIN bands r ON b.band_id = r.band_id
GROUP BY b.band_id, r.bounds, b.prediction_type""",
        *deps,
    )


def _ou_round(df):
    return round6(df, *[f"avg({c})" for c in _OU_AVG])


@register("over_under_report", _over_under_sql("label", _SINGLE_PRED, "sales", "sales"))
def q_over_under_report(spark, sf):
    classified = classify_error(_scored_single(spark, sf), "label", "predict_qty")
    return _ou_round(ev.over_under_report(classified, "label", "predict_qty"))


@register("over_under_two_stage", _over_under_sql("TotalQtySale", _TWO_STAGE_PRED, "scored", "scored"))
def q_over_under_two_stage(spark, sf):
    classified = classify_error(_scored_two_stage(spark, sf, out="predict_qty"), "TotalQtySale", "predict_qty")
    return _ou_round(ev.over_under_report(classified, "TotalQtySale", "predict_qty"))


@register(
    "over_under_exact", _over_under_sql("TotalQtySale", _TWO_STAGE_PRED, "scored", "scored", bands=EXACT_BANDS)
)
def q_over_under_exact(spark, sf):
    classified = classify_error(_scored_two_stage(spark, sf, out="predict_qty"), "TotalQtySale", "predict_qty")
    return _ou_round(ev.over_under_report(classified, "TotalQtySale", "predict_qty", bands=EXACT_BANDS))


def _fused(spark, sf):
    scored = _scored_two_stage(spark, sf, out="predict_qty")
    return ev.band_reports(scored, "TotalQtySale", "predict_qty")


@register("band_reports_range", REGISTRY["range_report"].sql)
def q_band_reports_range(spark, sf):
    """Report 1 of the one-pass pair (same numbers as range_report)."""
    return round6(_fused(spark, sf)[0], *_METRICS)


@register("band_reports_over_under", REGISTRY["over_under_two_stage"].sql)
def q_band_reports_over_under(spark, sf):
    """Report 2 of the one-pass pair (same numbers as over_under_two_stage)."""
    return _ou_round(_fused(spark, sf)[1])


@register(
    "union_reports",
    with_fixtures(
        f"""{_classified_sql("label", _SINGLE_PRED, "scored")},
bands AS ({o.bands_values()}),
one AS (SELECT 'single' AS report, {o.band_case("label")} AS band_id, * FROM ce WHERE label BETWEEN 0 AND 3000),
ce2 AS (SELECT *, CASE WHEN {_TWO_STAGE_PRED} >= TotalQtySale THEN 'Upper' ELSE 'Lower' END AS prediction_type2,
               CAST(abs({_TWO_STAGE_PRED} - TotalQtySale) AS DOUBLE) AS prediction_diff2 FROM scored),
two AS (SELECT 'two_stage' AS report, {o.band_case("TotalQtySale")} AS band_id, ce2.* FROM ce2 WHERE TotalQtySale BETWEEN 0 AND 3000)
SELECT report, u.band_id, r.bounds AS Range, prediction_type, COUNT(*) AS count_of_each_part FROM (
  SELECT report, band_id, prediction_type FROM one
  UNION ALL SELECT report, band_id, prediction_type2 FROM two) u
JOIN bands r ON u.band_id = r.band_id
GROUP BY report, u.band_id, r.bounds, prediction_type""",
        "scored",
    ),
)
def q_union_reports(spark, sf):
    single = ev.over_under_report(classify_error(_scored_single(spark, sf), "label", "predict_qty"), "label", "predict_qty")
    two = ev.over_under_report(
        classify_error(_scored_two_stage(spark, sf, out="predict_qty"), "TotalQtySale", "predict_qty"),
        "TotalQtySale",
        "predict_qty",
    )
    cols = ["report", "band_id", "Range", "prediction_type", "count_of_each_part"]
    return ev.union_reports(
        single.withColumn("report", F.lit("single")).select(cols), two.withColumn("report", F.lit("two_stage")).select(cols)
    )


@register(
    "classify_error",
    with_fixtures(
        f"""{_classified_sql("label", _SINGLE_PRED, "sales")}
SELECT {KEY_SQL}, label, predict_qty, prediction_type, prediction_diff FROM ce""",
        "sales",
    ),
)
def q_classify_error(spark, sf):
    return classify_error(_scored_single(spark, sf), "label", "predict_qty").select(
        *KEY, "label", "predict_qty", "prediction_type", "prediction_diff"
    )


@register(
    "classify_error_two_stage",
    with_fixtures(
        f"""{_classified_sql("TotalQtySale", _TWO_STAGE_PRED, "scored")}
SELECT {KEY_SQL}, TotalQtySale, pred_lv1, pred_lv2, predict_qty, prediction_type, prediction_diff FROM ce""",
        "scored",
    ),
)
def q_classify_error_two_stage(spark, sf):
    scored = _scored_two_stage(spark, sf, out="predict_qty")
    return classify_error(scored, "TotalQtySale", "predict_qty").select(
        *KEY, "TotalQtySale", "pred_lv1", "pred_lv2", "predict_qty", "prediction_type", "prediction_diff"
    )


@register(
    "two_stage_score",
    with_fixtures(f"SELECT {KEY_SQL}, TotalQtySale, pred_lv1, pred_lv2, pred_final FROM scored", "scored"),
)
def q_two_stage_score(spark, sf):
    return _scored_two_stage(spark, sf).select(*KEY, "TotalQtySale", "pred_lv1", "pred_lv2", "pred_final")


@register(
    "post_score",
    with_fixtures(
        f"""SELECT {KEY_SQL}, DDDD AS Day,
       CASE WHEN DDDD = 1 THEN p + p / CAST(2 AS DOUBLE) WHEN DDDD BETWEEN 2 AND 5 THEN p + p / CAST(2.5 AS DOUBLE)
            ELSE p END AS predict_qty
FROM (SELECT *, {_SINGLE_PRED} AS p FROM calendar) c""",
        "calendar",
    ),
)
def q_post_score(spark, sf):
    df = cal.rename_parts(cal.encode_calendar(_scored_single(spark, sf)))
    return post_score(df, "predict_qty", "Day").select(*KEY, "Day", "predict_qty")


@register(
    "post_score_v2",
    with_fixtures(
        f"""SELECT {KEY_SQL}, DayofMonth,
       CASE WHEN DayofMonth = 1 THEN p + p / CAST(2 AS DOUBLE)
            WHEN DayofMonth BETWEEN 2 AND 5 THEN p + p / CAST(2.5 AS DOUBLE) ELSE p END AS predict_qty
FROM (SELECT *, {_SINGLE_PRED} AS p FROM sales) s""",
        "sales",
    ),
)
def q_post_score_v2(spark, sf):
    return post_score(_scored_single(spark, sf), "predict_qty", "DayofMonth").select(*KEY, "DayofMonth", "predict_qty")


@register(
    "post_score_v3",
    with_fixtures(
        f"""SELECT {KEY_SQL}, DayofMonth, pred_final,
       CASE WHEN DayofMonth = 1 THEN pred_final + pred_final / CAST(2 AS DOUBLE)
            WHEN DayofMonth BETWEEN 2 AND 5 THEN pred_final + pred_final / CAST(2.5 AS DOUBLE)
            ELSE pred_final END AS pred_final_post
FROM scored""",
        "scored",
    ),
)
def q_post_score_v3(spark, sf):
    df = post_score(_scored_two_stage(spark, sf), "pred_final", "DayofMonth", out="pred_final_post")
    return df.select(*KEY, "DayofMonth", "pred_final", "pred_final_post")


# --------------------------------------------------------------------------- sinks


@register("range_report_csv", REGISTRY["range_report"].sql)
def q_range_report_csv(spark, sf):
    report = q_range_report(spark, sf)
    path = files.write_report_csv(report, fresh_path(spark, "range_report_csv"))
    return files.read_file(spark, path, "csv", schema=report.schema)


@register("over_under_csv", REGISTRY["over_under_report"].sql)
def q_over_under_csv(spark, sf):
    report = q_over_under_report(spark, sf)
    path = files.write_report_csv(report, fresh_path(spark, "over_under_csv"))
    return files.read_file(spark, path, "csv", schema=report.schema)


@register("read_table", with_fixtures("SELECT * FROM sales", "sales"))
def q_read_table(spark, sf):
    s = _sales(spark, sf)
    path = fresh_path(spark, "sales_csv")
    s.write.option("header", "true").csv(path)
    return files.read_file(spark, path, "csv", schema=s.schema)


# --------------------------------------------------------------------------- projections, casts, filters


@register(
    "select_variable", with_fixtures(f"SELECT {KEY_SQL}, TotalQtySale, avgPrice FROM sales", "sales")
)
def q_select_variable(spark, sf):
    return cl.select_variable(_sales(spark, sf), [*KEY, "TotalQtySale", "avgPrice"])


@register(
    "rename_parts", with_fixtures(f"SELECT {KEY_SQL}, DDDD AS Day, MMMM AS Month, YYYY AS Year FROM calendar", "calendar")
)
def q_rename_parts(spark, sf):
    return cal.rename_parts(cal.encode_calendar(_sales(spark, sf))).select(*KEY, "Day", "Month", "Year")


@register(
    "encode_calendar",
    with_fixtures(
        f"""SELECT {KEY_SQL}, YYYY, MMMM, DDDD, "DDDD-MMMM", "YYYY-MMMM", YY, MM, Holiday, HolidayType FROM calendar""",
        "calendar",
    ),
)
def q_encode_calendar(spark, sf):
    return cal.encode_calendar(_sales(spark, sf)).select(
        *KEY, "YYYY", "MMMM", "DDDD", "DDDD-MMMM", "YYYY-MMMM", "YY", "MM", "Holiday", "HolidayType"
    )


@register(
    "holiday_lookup",
    with_fixtures("SELECT Holiday, HolidayType, COUNT(*) AS n_rows FROM calendar GROUP BY 1, 2", "calendar"),
)
def q_holiday_lookup(spark, sf):
    return cal.encode_calendar(_sales(spark, sf)).groupBy("Holiday", "HolidayType").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "encode_welfare",
    with_fixtures(f"""SELECT {KEY_SQL}, "YYYY-MMMM", {o.welfare_case('"YYYY-MMMM"')} AS Welfare FROM calendar""", "calendar"),
)
def q_encode_welfare(spark, sf):
    return cal.encode_welfare(cal.encode_calendar(_sales(spark, sf))).select(*KEY, "YYYY-MMMM", "Welfare")


_CALENDAR_COLS = [*KEY, "YYYY", "MMMM", "DDDD", "DDDD-MMMM", "YYYY-MMMM", "YY", "MM", "Holiday", "HolidayType"]


@register("calendar_table_default", REGISTRY["encode_calendar"].sql)
def q_calendar_table_default(spark, sf):
    """The literal calendar as a table: the same holidays, by a join."""
    return ct.encode_calendar(_sales(spark, sf)).select(*_CALENDAR_COLS)


@register("calendar_table_welfare", REGISTRY["encode_welfare"].sql)
def q_calendar_table_welfare(spark, sf):
    return ct.encode_welfare(cal.encode_calendar(_sales(spark, sf))).select(*KEY, "YYYY-MMMM", "Welfare")


# moving feasts by year, a feast that moved, one that ended, overlaps, and one across the turn of the year
_MOVING = [
    ("2015-03-04", None, False, None, 0, "Makha", "Religious"),
    ("2016-02-22", None, False, None, 0, "Makha", "Religious"),
    ("2017-02-11", None, False, None, 0, "Makha", "Religious"),
    ("2018-03-01", None, False, None, 0, "Makha", "Religious"),
    ("2019-02-19", None, False, None, 0, "Makha", "Religious"),
    ("2010-04-13", "2010-04-15", True, "2019-12-31", 0, "Songkran", "National"),
    ("2020-07-27", "2020-07-27", False, None, 0, "Songkran", "National"),
    ("2021-04-12", "2021-04-15", True, None, 0, "Songkran", "National"),
    ("2010-12-30", "2011-01-02", True, None, 0, "YearEnd", "Bank"),
    ("2014-01-01", None, True, None, 5, "NewYear", "National"),
    ("2017-04-14", "2017-04-20", False, None, 0, "Festival", "Regional"),
    ("2016-02-29", None, True, None, 0, "LeapDay", "Public"),
]


def _rule_values(rows) -> str:
    cells = ["(" + ", ".join("NULL" if v is None else str(v).upper() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows]
    return f"(VALUES {', '.join(cells)}) v(first, last, yearly, until, priority, name, type)"


def _interval_sql(source: str, rules: str, on: str) -> str:
    """The interval join spelled out: every occurrence of every rule against the days, the best one kept."""
    return f"""rules AS ({rules}),
occ AS (SELECT r.*, CAST(first + to_years(CAST(k AS INTEGER)) AS DATE) AS f, CAST(CAST(coalesce(last, first) AS DATE) - CAST(first AS DATE) AS INTEGER) AS len
        FROM rules r, range(0, 40) t(k)
        WHERE (k = 0 OR yearly) AND day(first) = day(first + to_years(CAST(k AS INTEGER)))),
hit AS (SELECT s.SalDate AS d, s.BranchCode AS b, name, type, row_number() OVER (PARTITION BY s.SalDate, s.BranchCode ORDER BY priority DESC, first DESC, name DESC, type DESC) AS rn
        FROM (SELECT DISTINCT SalDate, BranchCode FROM {source}) s
        JOIN occ ON s.SalDate BETWEEN f AND f + len AND (until IS NULL OR s.SalDate <= until){on})
SELECT {KEY_SQL}, coalesce(name, 'Normal') AS Holiday, coalesce(type, 'Normal') AS HolidayType
FROM {source} LEFT JOIN hit ON hit.d = SalDate AND hit.b = BranchCode AND rn = 1"""


_MOVING_SQL = f"""SELECT CAST(first AS DATE) AS first, CAST(last AS DATE) AS last, yearly, CAST(until AS DATE) AS until, priority, name, type
FROM {_rule_values(_MOVING)}"""


@register("calendar_table_moving", with_fixtures(_interval_sql("sales", _MOVING_SQL, ""), "sales"))
def q_calendar_table_moving(spark, sf):
    rows = [tuple(dt.date.fromisoformat(v) if v and i in (0, 1, 3) else v for i, v in enumerate(r)) for r in _MOVING]
    rules = spark.createDataFrame(rows, f"{ct.RULES}, name string, type string")
    return ct.encode_holidays(_sales(spark, sf), rules).select(*KEY, "Holiday", "HolidayType")


_BRANCH_RULES_SQL = """SELECT CAST(s_suppkey AS INTEGER) AS branch, make_date(CAST(2015 + s_suppkey % 3 AS INTEGER), CAST(1 + s_suppkey % 12 AS INTEGER), CAST(1 + s_suppkey % 28 AS INTEGER)) AS first,
       CAST(make_date(CAST(2015 + s_suppkey % 3 AS INTEGER), CAST(1 + s_suppkey % 12 AS INTEGER), CAST(1 + s_suppkey % 28 AS INTEGER)) + 4 AS DATE) AS last,
       TRUE AS yearly, CASE WHEN s_suppkey % 5 = 0 THEN DATE '2019-06-30' END AS until, 0 AS priority, 'Anniversary' AS name, 'Branch' AS type
FROM supplier"""


@register("calendar_table_by_branch", with_fixtures(_interval_sql("sales", _BRANCH_RULES_SQL, " AND occ.branch = s.BranchCode"), "sales"))
def q_calendar_table_by_branch(spark, sf):
    """Every branch has a calendar of its own (the rules grow with the branches)."""
    k = F.col("s_suppkey")
    first = F.make_date((F.lit(2015) + k % 3).cast("int"), (F.lit(1) + k % 12).cast("int"), (F.lit(1) + k % 28).cast("int"))
    rules = fx.table(spark, sf, "supplier").select(
        k.cast("int").alias("BranchCode"), first.alias("first"), F.date_add(first, 4).alias("last"), F.lit(True).alias("yearly"),
        F.when(k % 5 == 0, F.lit(dt.date(2019, 6, 30))).alias("until"), F.lit(0).alias("priority"), F.lit("Anniversary").alias("name"), F.lit("Branch").alias("type"),
    )
    return ct.encode_holidays(_sales(spark, sf), rules, keys=["BranchCode"]).select(*KEY, "Holiday", "HolidayType")


@register(
    "welfare_day_flag",
    with_fixtures(
        f"SELECT {KEY_SQL}, DayofMonth, CASE WHEN DayofMonth IN (1, 2, 3, 4, 5) THEN '1' ELSE '0' END AS welfareFlagDay FROM sales",
        "sales",
    ),
)
def q_welfare_day_flag(spark, sf):
    return cal.add_welfare_day_flag(_sales(spark, sf), "DayofMonth").select(*KEY, "DayofMonth", "welfareFlagDay")


@register(
    "extract_date",
    with_fixtures(
        f"""SELECT {KEY_SQL}, DayofMonth, CAST(dayofyear(SalDate) AS INTEGER) AS Yearday,
       CAST(month(SalDate) AS INTEGER) AS Month, CAST(dayofweek(SalDate) + 1 AS INTEGER) AS DayofWeek,
       CAST(year(SalDate) AS INTEGER) AS Year, CAST(quarter(SalDate) AS INTEGER) AS Quarter,
       CAST(weekofyear(SalDate) AS INTEGER) AS WeekOfYear,
       CASE WHEN DayofMonth <= 8 THEN 0 WHEN DayofMonth <= 16 THEN 1 WHEN DayofMonth <= 24 THEN 2 ELSE 3 END
         AS MonthQuarter
FROM sales""",
        "sales",
    ),
)
def q_extract_date(spark, sf):
    return cal.extract_date(_sales(spark, sf)).select(
        *KEY, "DayofMonth", "Yearday", "Month", "DayofWeek", "Year", "Quarter", "WeekOfYear", "MonthQuarter"
    )


@register(
    "price_sensitivity_dim",
    with_fixtures("SELECT Branch AS BC2, MaterialCode AS MC2, f0_ AS Price_Sensitivity FROM price_sensitivity", "price_sensitivity"),
)
def q_price_sensitivity_dim(spark, sf):
    return en.price_sensitivity_dim(fx.price_sensitivity(spark, sf))


@register(
    "tier_dim",
    with_fixtures("SELECT BranchCode AS BC3, MaterailCode AS MC3, CALYEAR, CALMONTH, Tier FROM tier", "tier"),
)
def q_tier_dim(spark, sf):
    return en.tier_dim(fx.tier(spark, sf))


_RAW_COLS = ["SalDate", "BranchCode", "MaterialCode", "TotalQtySale", "avgPrice", "avgPriceDis", "totalNetSale", "supPrice", "DayofMonth", "label"]
_NOT_NULL_RAW = " AND ".join(f"{c} IS NOT NULL" for c in _RAW_COLS)


@register("drop_incomplete", with_fixtures(f"SELECT * FROM sales_raw_text WHERE {_NOT_NULL_RAW}", "sales_raw_text"))
def q_drop_incomplete(spark, sf):
    return cl.drop_incomplete(fx.sales_raw_text(spark, sf))


@register(
    "drop_all_null",
    with_fixtures(
        """SELECT ps.BC2, ps.MC2, ps.Price_Sensitivity FROM sales s
LEFT JOIN (SELECT Branch AS BC2, MaterialCode AS MC2, f0_ AS Price_Sensitivity FROM price_sensitivity) ps
  ON s.BranchCode = ps.BC2 AND s.MaterialCode = ps.MC2
WHERE NOT (ps.BC2 IS NULL AND ps.MC2 IS NULL AND (ps.Price_Sensitivity IS NULL OR isnan(ps.Price_Sensitivity)))""",
        "sales",
        "price_sensitivity",
    ),
)
def q_drop_all_null(spark, sf):
    joined = en.join_price_sensitivity(_sales(spark, sf), en.price_sensitivity_dim(fx.price_sensitivity(spark, sf)))
    return cl.drop_all_null(joined.select("BC2", "MC2", "Price_Sensitivity"))


def _lenient_int(c: str) -> str:
    return f"CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER)"


def _clean_raw_sql(profile: dict[str, str]) -> str:
    sel = []
    for c in _RAW_COLS:
        t = profile.get(c)
        if t == "int":
            sel.append(f"{_lenient_int(c)} AS {c}")
        elif t == "double":
            sel.append(f"TRY_CAST({c} AS DOUBLE) AS {c}")
        else:
            sel.append(c)
    return with_fixtures(f"SELECT {', '.join(sel)} FROM sales_raw_text WHERE {_NOT_NULL_RAW}", "sales_raw_text")


@register("clean_basic", _clean_raw_sql(cl.CAST_PROFILES["basic_train"]))
def q_clean_basic(spark, sf):
    return cl.clean(fx.sales_raw_text(spark, sf), "basic_train")


@register("read_text_clean", _clean_raw_sql(cl.CAST_PROFILES["basic_train"]))
def q_read_text_clean(spark, sf):
    """The original entry path: a text file read without a schema (all columns text), then cleaned."""
    path = fresh_path(spark, "sales_text")
    fx.sales_raw_text(spark, sf).write.option("header", "true").csv(path)
    return cl.clean(files.read_file(spark, path, "csv"), "basic_train")


@register("clean_basic_score", _clean_raw_sql(cl.CAST_PROFILES["basic_score"]))
def q_clean_basic_score(spark, sf):
    return cl.clean(fx.sales_raw_text(spark, sf), "basic_score")


_BIN_COLS = [
    "SalDate", "BranchCode", "MaterialCode", "TotalQtySale", "avgPrice", "avgPriceDis", "totalNetSale", "supPrice",
    "label", "Year", "ZipCode", "welfareFlag", "welfareFlagDay",
]
_DOW_COLS = _BIN_COLS + [
    "DoW_Num", "Total_Bill_Dow", "Total_SumQTY_Dow", "AVG_SumQTY_Dow", "MED_SumQTY_Dow", "SD_SumQTY_Dow",
    "NumWeekSale", "MostSalesUnitFreq", "HighQualityFlag",
]
_DOUBLE_COLS = {"avgPrice", "avgPriceDis", "totalNetSale", "supPrice", "AVG_SumQTY_Dow", "MED_SumQTY_Dow", "SD_SumQTY_Dow", "MostSalesUnitFreq", "temp", "Price_Sensitivity"}


def _not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in _DOUBLE_COLS else "") for c in cols)


def _clean_typed_sql(source: str, cols, profile: dict[str, str], round_cols=()) -> str:
    sel = []
    for c in cols:
        t = profile.get(c)
        e = _lenient_int(c) if t == "int" else (f"TRY_CAST({c} AS DOUBLE)" if t == "double" else c)
        sel.append(f"{r6(e) if c in round_cols else e} AS {c}")
    return with_fixtures(f"SELECT {', '.join(sel)} FROM {source} WHERE {_not_null(cols)}", source)


@register("clean_binary", _clean_typed_sql("binary_features", _BIN_COLS, cl.CAST_PROFILES["binary_train"]))
def q_clean_binary(spark, sf):
    return cl.clean(_binary_features(spark, sf), "binary_train")


@register("clean_binary_score", _clean_typed_sql("binary_features", _BIN_COLS, cl.CAST_PROFILES["binary_score"]))
def q_clean_binary_score(spark, sf):
    return cl.clean(_binary_features(spark, sf), "binary_score")


_DOW_ROUND = ("AVG_SumQTY_Dow", "MED_SumQTY_Dow", "SD_SumQTY_Dow")


@register("clean_dow", _clean_typed_sql("dow_features", _DOW_COLS, cl.CAST_PROFILES["dow_train"], _DOW_ROUND))
def q_clean_dow(spark, sf):
    return round6(cl.clean(_dow_features(spark, sf).select(*_DOW_COLS), "dow_train"), *_DOW_ROUND)


@register("clean_dow_score", _clean_typed_sql("dow_features", _DOW_COLS, cl.CAST_PROFILES["dow_score"], _DOW_ROUND))
def q_clean_dow_score(spark, sf):
    return round6(cl.clean(_dow_features(spark, sf).select(*_DOW_COLS), "dow_score"), *_DOW_ROUND)


_DOW_FREQ_COLS = [c for c in _DOW_COLS if c != "Total_Bill_Dow"]


@register(
    "clean_dow_freq", _clean_typed_sql("dow_features", _DOW_FREQ_COLS, cl.CAST_PROFILES["dow_freq_score"], _DOW_ROUND)
)
def q_clean_dow_freq(spark, sf):
    return round6(cl.clean(_dow_features(spark, sf).select(*_DOW_FREQ_COLS), "dow_freq_score"), *_DOW_ROUND)


_FULL_COLS = [
    "SalDate", "BranchCode", "MaterialCode", "TotalQtySale", "avgPrice", "avgPriceDis", "totalNetSale", "supPrice",
    "DayofMonth", "label", "Year", "Month", "Day", '"DDDD-MMMM"', '"YYYY-MMMM"', "YY", "MM", "Holiday",
    "HolidayType", "BC2", "MC2", "Price_Sensitivity", "BC3", "MC3", "CALYEAR", "CALMONTH", "Tier", "TierNumeric",
    "Welfare", "welfareFlag", "welfareFlagDay", "name", "temp",
]
_FULL_OUT = [
    "SalDate", "BranchCode", "MaterialCode", "TotalQtySale", "supPrice", "avgPrice", "avgPriceDis",
    "Price_Sensitivity", "Tier", "TierNumeric", "Welfare", "welfareFlag", "welfareFlagDay", "Year", "Month", "Day",
    "Holiday", "HolidayType", "name", "temp",
]


def _clean_full_sql() -> str:
    prof = cl.CAST_PROFILES["full"]
    sel = []
    for c in _FULL_OUT:
        t = prof.get(c)
        sel.append(f"{_lenient_int(c) if t == 'int' else (f'TRY_CAST({c} AS DOUBLE)' if t == 'double' else c)} AS {c}")
    return with_fixtures(f"SELECT {', '.join(sel)} FROM features WHERE {_not_null(_FULL_COLS)}", "features")


@register("clean_full", _clean_full_sql())
def q_clean_full(spark, sf):
    return cl.clean(_features(spark, sf), "full").select(*_FULL_OUT)


@register("filter_range", with_fixtures("SELECT * FROM sales WHERE label BETWEEN 4 AND 6", "sales"))
def q_filter_range(spark, sf):
    return cl.filter_range(_sales(spark, sf), "label", 4, 6)


@register("filter_exact", with_fixtures("SELECT * FROM sales WHERE TotalQtySale = 2", "sales"))
def q_filter_exact(spark, sf):
    return cl.filter_exact(_sales(spark, sf), "TotalQtySale", 2)


def _profile_sql() -> str:
    types = {
        "SalDate": "date", "BranchCode": "int", "MaterialCode": "int", "TotalQtySale": "int", "avgPrice": "double",
        "avgPriceDis": "double", "totalNetSale": "double", "supPrice": "double", "DayofMonth": "int", "label": "int",
    }
    parts = [
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS n_null FROM sales"
        for c, t in types.items()
    ]
    return with_fixtures("\nUNION ALL ".join(parts), "sales")


@register("profile_columns", _profile_sql())
def q_profile_columns(spark, sf):
    return cl.profile_columns(_sales(spark, sf))


# --------------------------------------------------------------------------- joins and flags


def _ps_join_sql(how: str) -> str:
    return with_fixtures(
        f"""SELECT s.SalDate, s.BranchCode, s.MaterialCode, ps.BC2, ps.MC2, ps.Price_Sensitivity,
       CAST(year(s.SalDate) AS INTEGER) AS YY, CAST(month(s.SalDate) AS INTEGER) AS MM
FROM sales s {how} JOIN (SELECT Branch AS BC2, MaterialCode AS MC2, f0_ AS Price_Sensitivity FROM price_sensitivity) ps
  ON s.BranchCode = ps.BC2 AND s.MaterialCode = ps.MC2""",
        "sales",
        "price_sensitivity",
    )


@register("join_price_sensitivity", _ps_join_sql("LEFT"))
def q_join_price_sensitivity(spark, sf):
    ps = en.price_sensitivity_dim(fx.price_sensitivity(spark, sf))
    return en.join_price_sensitivity(_sales(spark, sf), ps).select(*KEY, "BC2", "MC2", "Price_Sensitivity", "YY", "MM")


@register("join_price_sensitivity_inner", _ps_join_sql("INNER"))
def q_join_price_sensitivity_inner(spark, sf):
    ps = en.price_sensitivity_dim(fx.price_sensitivity(spark, sf))
    return en.join_price_sensitivity(_sales(spark, sf), ps, "inner").select(
        *KEY, "BC2", "MC2", "Price_Sensitivity", "YY", "MM"
    )


def _tier_join_sql(how: str, extra: str = "") -> str:
    return with_fixtures(
        f"""SELECT c.SalDate, c.BranchCode, c.MaterialCode, t.CALYEAR, t.CALMONTH, t.Tier{extra}
FROM calendar c {how} JOIN (SELECT BranchCode AS BC3, MaterailCode AS MC3, CALYEAR, CALMONTH, Tier FROM tier) t
  ON c.BranchCode = t.BC3 AND c.MaterialCode = t.MC3 AND c.YY = t.CALYEAR AND c.MM = t.CALMONTH""",
        "calendar",
        "tier",
    )


def _tier_joined(spark, sf, how="left"):
    return en.join_tier(cal.encode_calendar(_sales(spark, sf)), en.tier_dim(fx.tier(spark, sf)), how)


@register("join_tier", _tier_join_sql("LEFT"))
def q_join_tier(spark, sf):
    return _tier_joined(spark, sf).select(*KEY, "CALYEAR", "CALMONTH", "Tier")


@register("join_tier_inner", _tier_join_sql("INNER"))
def q_join_tier_inner(spark, sf):
    return _tier_joined(spark, sf, "inner").select(*KEY, "CALYEAR", "CALMONTH", "Tier")


_SALT = 8


@register("join_tier_salted", _tier_join_sql("LEFT"))
def q_join_tier_salted(spark, sf):
    joined = en.join_tier(cal.encode_calendar(_sales(spark, sf)), en.tier_dim(fx.tier(spark, sf)), salt=_SALT)
    return joined.select(*KEY, "CALYEAR", "CALMONTH", "Tier")


@register("join_price_sensitivity_salted", _ps_join_sql("INNER"))
def q_join_price_sensitivity_salted(spark, sf):
    ps = en.price_sensitivity_dim(fx.price_sensitivity(spark, sf))
    return en.join_price_sensitivity(_sales(spark, sf), ps, "inner", salt=_SALT).select(
        *KEY, "BC2", "MC2", "Price_Sensitivity", "YY", "MM"
    )


@register("encode_tier", _tier_join_sql("LEFT", f", {o.tier_case('t.Tier')} AS TierNumeric"))
def q_encode_tier(spark, sf):
    return cal.encode_tier(_tier_joined(spark, sf)).select(*KEY, "CALYEAR", "CALMONTH", "Tier", "TierNumeric")


@register(
    "welfare_branch_flag",
    with_fixtures(
        f"""SELECT {KEY_SQL}, CASE WHEN BranchCode IN (SELECT branchcode FROM welfare_branches) THEN '1' ELSE '0' END
         AS welfareFlag FROM sales""",
        "sales",
        "welfare_branches",
    ),
)
def q_welfare_branch_flag(spark, sf):
    return en.welfare_branch_flag(_sales(spark, sf), fx.welfare_branches(spark, sf)).select(*KEY, "welfareFlag")


@register(
    "join_weather",
    with_fixtures(
        f"SELECT s.SalDate, s.BranchCode, s.MaterialCode, w.name, w.temp FROM sales s LEFT JOIN branch_weather w ON s.BranchCode = w.BranchCode",
        "sales",
        "branch_weather",
    ),
)
def q_join_weather(spark, sf):
    bw = _branch_weather(spark, sf).select("BranchCode", "name", "temp")
    return en.join_weather(_sales(spark, sf), bw).select(*KEY, "name", "temp")


# --------------------------------------------------------------------------- weather and stations


@register("store_location", with_fixtures("SELECT * FROM store_location", "store_location"))
def q_store_location(spark, sf):
    return we.store_location(fx.store_location_raw(spark, sf))


@register("weather_latest", with_fixtures("SELECT * FROM latest_weather", "latest_weather"))
def q_weather_latest(spark, sf):
    return we.weather_latest(fx.weather(spark, sf), fx.stations(spark, sf), "TH", WEATHER_YEAR)


@register("weather_partitioned", with_fixtures("SELECT * FROM latest_weather", "latest_weather"))
def q_weather_partitioned(spark, sf):
    """Weather stored partitioned by year (the original kept one table per year): the year filter
    of weather_latest becomes a partition filter, so other years are never listed or read."""
    path = fresh_path(spark, "weather_by_year")
    files.write_table(fx.weather(spark, sf).withColumn("year", F.year("date")), path, partition_by=["year"])
    stored = spark.read.parquet(path)
    return we.weather_latest(stored, fx.stations(spark, sf), "TH", WEATHER_YEAR).drop("year")


@register("weather_latest_state", with_fixtures("SELECT * FROM latest_weather", "latest_weather"))
def q_weather_latest_state(spark, sf):
    """Latest weather kept by station: the first days (some of them wrong), then the others in two merges."""
    w = fx.weather(spark, sf)
    path = fresh_path(spark, "weather_state")
    day = F.dayofmonth("date")
    ws.merge_days(w.where(day <= 20).withColumn("temp", F.lit(-1.0)), path)
    ws.merge_days(w.where((day >= 15) & (day <= 25)), path)
    ws.merge_days(w.where((day <= 14) | (day > 25)), path)
    return ws.latest_from(spark, path, fx.stations(spark, sf), "TH", WEATHER_YEAR)


@register(
    "nearest_station",
    with_fixtures(f"SELECT BranchCode, name, temp, {r6('dis_store')} AS dis_store FROM branch_weather", "branch_weather"),
)
def q_nearest_station(spark, sf):
    return round6(_branch_weather(spark, sf).select("BranchCode", "name", "temp", "dis_store"), "dis_store")


_K_NEAREST = 3


@register(
    "avg_rank",
    with_fixtures(
        f"""d AS (SELECT s.BranchCode, w.name, {o._dist("s", "w")} AS dis_store FROM store_location s, latest_weather w),
r AS (SELECT *, row_number() OVER (PARTITION BY BranchCode ORDER BY dis_store, name) AS rn,
             rank() OVER (PARTITION BY BranchCode ORDER BY dis_store) - 1
             + (COUNT(*) OVER (PARTITION BY BranchCode, dis_store) + 1) / CAST(2 AS DOUBLE) AS avg_rank
      FROM d)
SELECT BranchCode, name, {r6("dis_store")} AS dis_store, CAST(rn AS INTEGER) AS rank, avg_rank FROM r WHERE rn <= {_K_NEAREST}""",
        "store_location",
        "latest_weather",
    ),
)
def q_avg_rank(spark, sf):
    near = _branch_weather(spark, sf, k=_K_NEAREST)
    return round6(near.select("BranchCode", "name", "dis_store", "rank", "avg_rank"), "dis_store")


@register(
    "store_station_distance",
    with_fixtures(
        f"""d AS (SELECT s.BranchCode, w.usaf, w.name, {o._dist("s", "w")} AS dis_store
          FROM store_location s, (SELECT * FROM stations WHERE country = 'TH') w),
r AS (SELECT *, row_number() OVER (PARTITION BY BranchCode ORDER BY dis_store, name) AS rn FROM d)
SELECT BranchCode, usaf, name, {r6("dis_store")} AS dis_store, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 5""",
        "store_location",
        "stations",
    ),
)
def q_store_station_distance(spark, sf):
    stations = fx.stations(spark, sf).filter(F.col("country") == "TH")
    near = we.nearest_station(we.store_location(fx.store_location_raw(spark, sf)), stations, k=5)
    return round6(near.select("BranchCode", "usaf", "name", "dis_store", "rank"), "dis_store")


@register(
    "nearest_supplier",
    with_fixtures(
        f"""c AS (SELECT CAST(c_custkey AS INTEGER) AS Customer, 5 + (c_custkey * 41 % 1600) / CAST(100 AS DOUBLE) AS lat,
            97 + (c_custkey * 59 % 800) / CAST(100 AS DOUBLE) AS lng FROM customer),
d AS (SELECT c.Customer, s.BranchCode AS Supplier, sqrt((c.lat - s.lat) * (c.lat - s.lat) + (c.lng - s.lng) * (c.lng - s.lng)) AS dis_store
      FROM c, store_location s),
r AS (SELECT *, row_number() OVER (PARTITION BY Customer ORDER BY {r6("dis_store")}, Supplier) AS rn FROM d)
SELECT Customer, CAST(rn AS INTEGER) AS rank, {r6("dis_store")} AS dis_store FROM r WHERE rn <= {_K_NEAREST}""",
        "store_location",
    ),
)
def q_nearest_supplier(spark, sf):
    """The three nearest suppliers of every customer: both sides grow with the scale factor."""
    customers = we.store_location(fx.customer_locations(spark, sf)).withColumnRenamed("BranchCode", "Customer")
    suppliers = we.store_location(fx.store_location_raw(spark, sf)).select(
        F.col("BranchCode").alias("Supplier"), "lat", F.col("lng").alias("lon")
    )
    near = we.nearest_station(customers, suppliers, k=_K_NEAREST, store_key="Customer", tie_break=("Supplier",))
    return round6(near.select("Customer", "rank", "dis_store"), "dis_store")


def _on_globe(df, key, name, a, b):
    """Places spread over the whole globe, by key; the date line and both polar regions are met."""
    k = F.col(key)
    return df.select(k.cast("int").alias(name), ((k * a % 17999) / F.lit(100.0) - 89.99).alias("lat"), ((k * b % 36000) / F.lit(100.0) - 180).alias("lng"))


@register(
    "nearest_supplier_sphere",
    f"""WITH c AS (SELECT CAST(c_custkey AS INTEGER) AS Customer, (c_custkey * 4111 % 17999) / CAST(100 AS DOUBLE) - 89.99 AS lat,
            (c_custkey * 7919 % 36000) / CAST(100 AS DOUBLE) - 180 AS lng FROM customer),
s AS (SELECT CAST(s_suppkey AS INTEGER) AS Supplier, (s_suppkey * 6101 % 17999) / CAST(100 AS DOUBLE) - 89.99 AS lat,
            (s_suppkey * 3571 % 36000) / CAST(100 AS DOUBLE) - 180 AS lng FROM supplier),
h AS (SELECT c.Customer, s.Supplier, pow(sin(radians(c.lat - s.lat) / 2), 2)
             + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians(c.lng - s.lng) / 2), 2) AS h FROM c, s),
d AS (SELECT Customer, Supplier, {2 * sp.EARTH_KM} * asin(sqrt(least(h, CAST(1 AS DOUBLE)))) AS dis_km FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY Customer ORDER BY round(dis_km, 6), Supplier) AS rn FROM d)
SELECT Customer, Supplier, CAST(rn AS INTEGER) AS rank, round(dis_km, 3) AS dis_km FROM r WHERE rn <= {_K_NEAREST}""",
)
def q_nearest_supplier_sphere(spark, sf):
    """The three nearest suppliers of every customer by great-circle distance."""
    customers = _on_globe(fx.table(spark, sf, "customer"), "c_custkey", "Customer", 4111, 7919)
    suppliers = _on_globe(fx.table(spark, sf, "supplier"), "s_suppkey", "Supplier", 6101, 3571).withColumnRenamed("lng", "lon")
    near = sp.nearest_on_sphere(customers, suppliers, k=_K_NEAREST, store_key="Customer", tie_break=("Supplier",))
    return near.select("Customer", "Supplier", "rank", F.round("dis_km", 3).alias("dis_km"))


# --------------------------------------------------------------------------- reports kept by day

_REPLAYED = [dt.date(2019, 3, d) for d in range(1, 32)]


def _report_state(spark, sf):
    """State built from scores of which a month is wrong, then that month replayed from the right ones."""
    scored = _scored_two_stage(spark, sf, out="predict_qty")
    path = fresh_path(spark, "report_state")
    wrong = scored.withColumn("predict_qty", F.when(F.col("SalDate").isin(_REPLAYED), F.lit(99.0)).otherwise(F.col("predict_qty")))
    rs.replay(wrong, path, label="TotalQtySale", pred="predict_qty")
    rs.replay(scored, path, _REPLAYED, label="TotalQtySale", pred="predict_qty")
    return rs.read_state(spark, path)


@register("range_report_incremental", REGISTRY["range_report"].sql)
def q_range_report_incremental(spark, sf):
    return round6(rs.range_report_from(_report_state(spark, sf)), *_METRICS)


@register("over_under_incremental", REGISTRY["over_under_two_stage"].sql)
def q_over_under_incremental(spark, sf):
    return _ou_round(rs.over_under_report_from(_report_state(spark, sf), "predict_qty"))


_REPLAYED_MONTH = [dt.date(2018, 5, 9)]


def _weekday_state(spark, sf):
    """Weekday state of which one month was wrong and is replayed."""
    s = _sales(spark, sf)
    path = fresh_path(spark, "weekday_state")
    wrong = F.when(F.trunc("SalDate", "month") == F.lit(_REPLAYED_MONTH[0].replace(day=1)), F.lit(77)).otherwise(F.col("TotalQtySale"))
    ps.replay_weekdays(s.withColumn("TotalQtySale", wrong), path)
    ps.replay_weekdays(s, path, _REPLAYED_MONTH)
    return path


_DOW_SQL = with_fixtures(
    f"""SELECT BranchCode, MaterialCode, DoW_Num, Total_Bill_Dow, Total_SumQTY_Dow, {r6("AVG_SumQTY_Dow")} AS AVG_SumQTY_Dow,
       {r6("MED_SumQTY_Dow")} AS MED_SumQTY_Dow, {r6("SD_SumQTY_Dow")} AS SD_SumQTY_Dow, NumWeekSale, MostSalesUnitFreq
FROM dow_profile""",
    "dow_profile",
)


@register("dow_profile_incremental", _DOW_SQL)
def q_dow_profile_incremental(spark, sf):
    df = ps.weekday_profile_from(spark, _weekday_state(spark, sf)).drop("n_values")
    return round6(df, "AVG_SumQTY_Dow", "MED_SumQTY_Dow", "SD_SumQTY_Dow")


@register(
    "dow_profile_sketch",
    with_fixtures(
        """w AS (SELECT CAST(dayofweek(SalDate) + 1 AS INTEGER) AS DoW_Num, BranchCode, COUNT(*) AS n, COUNT(DISTINCT TotalQtySale) AS v FROM sales GROUP BY ALL)
SELECT BranchCode, DoW_Num, CAST(n AS INTEGER) AS Total_Bill_Dow, CAST(v AS INTEGER) AS n_values, TRUE AS median_in_bounds FROM w""",
        "sales",
    ),
)
def q_dow_profile_sketch(spark, sf):
    """Weekday profile per branch with sketched medians, each within the stated rank error of its quantities."""
    s = _sales(spark, sf)
    path = fresh_path(spark, "weekday_state")
    ps.replay_weekdays(s, path, keys=["BranchCode"])
    prof = ps.weekday_profile_from(spark, path, ["BranchCode"], exact_median=False)
    rows = s.select("BranchCode", F.dayofweek("SalDate").alias("DoW_Num"), "TotalQtySale").join(prof, ["BranchCode", "DoW_Num"])
    n, q, med = F.count(F.lit(1)), F.col("TotalQtySale"), F.col("MED_SumQTY_Dow")
    below, upto = F.sum((q < med).cast("int")) / n, F.sum((q <= med).cast("int")) / n
    ok = (below <= 0.5 + ps.RANK_ERROR + 1 / n) & (upto >= 0.5 - ps.RANK_ERROR - 1 / n)
    return rows.groupBy("BranchCode", "DoW_Num", "Total_Bill_Dow", "n_values").agg(ok.alias("median_in_bounds"))


@register("profile_columns_stored", _profile_sql())
def q_profile_columns_stored(spark, sf):
    """The column profile from stored months, one of them replayed."""
    s = _sales(spark, sf)
    path = fresh_path(spark, "column_state")
    ps.replay_columns(s.withColumn("supPrice", F.lit(None).cast("double")), path)
    for month in s.select(F.trunc("SalDate", "month").alias("m")).distinct().groupBy(F.year("m").alias("y")).agg(F.collect_list("m").alias("m")).collect():
        ps.replay_columns(s, path, month["m"])  # year by year
    return ps.column_profile_from(spark, path).drop("approx_distinct")


@register(
    "stratified_sample_by",
    with_fixtures("SELECT label, COUNT(*) AS n_rows, TRUE AS whole, TRUE AS in_bounds FROM sales GROUP BY 1", "sales"),
)
def q_stratified_sample_by(spark, sf):
    """Spark's stratified sampler: both halves make up the rows, and every label's share lies within six standard deviations."""
    s = _sales(spark, sf)
    sample, rest = sa.stratified_split(s, SPLIT_FRACTION, "label", KEY, seed=42, method="sampleBy")
    halves = sample.withColumn("drawn", F.lit(1)).unionByName(rest.withColumn("drawn", F.lit(0)))
    per_key = halves.groupBy("label", *KEY).agg(F.count(F.lit(1)).alias("n"), F.sum("drawn").alias("drawn"))
    n, k = F.sum("n"), F.sum("drawn")
    near = F.abs(k - SPLIT_FRACTION * n) <= 6 * F.sqrt(n * SPLIT_FRACTION * (1 - SPLIT_FRACTION)) + 1
    return per_key.groupBy("label").agg(n.alias("n_rows"), (F.max("n") == 1).alias("whole"), near.alias("in_bounds"))


# --------------------------------------------------------------------------- quarantine

_RAW_COLS = ["SalDate", "BranchCode", "MaterialCode", "TotalQtySale", "avgPrice", "avgPriceDis", "totalNetSale", "supPrice", "DayofMonth", "label"]
_RAW_PROFILE = {"SalDate": "date", **cl.CAST_PROFILES["basic_train"], "DayofMonth": "int"}
_TORN_MODULUS = 29  # lines of branches 3, 32, ... end before the last two fields


def _raw_file(spark, sf):
    """The raw sales as a headed text file with some damaged cells and some torn lines."""
    raw = fx.sales_raw_text(spark, sf)
    cells = [F.coalesce(F.col(c), F.lit("")) for c in _RAW_COLS]
    torn = F.col("BranchCode").cast("int") % _TORN_MODULUS == 3
    line = F.when(torn, F.concat_ws(",", *cells[:-2])).otherwise(F.concat_ws(",", *cells))
    path = fresh_path(spark, "raw_lines")
    raw.select(line.alias("value")).write.text(path)
    return qu.read_permissive(spark, path, _RAW_COLS, header="false")


def _quarantine(spark, sf):
    return qu.split(_raw_file(spark, sf), _RAW_PROFILE, fractions="reject")


_JUDGED_SQL = f"""raw AS (SELECT *, CAST(BranchCode AS INTEGER) % {_TORN_MODULUS} = 3 AS torn FROM sales_raw_text),
cells AS (
  SELECT r.*, c.col, c.raw, CASE
    WHEN c.raw IS NULL THEN 'missing'
    WHEN c.kind <> '' AND TRY_CAST(c.raw AS DOUBLE) IS NULL THEN 'not a number'
    WHEN c.kind = 'int' AND TRY_CAST(c.raw AS DOUBLE) <> floor(TRY_CAST(c.raw AS DOUBLE)) THEN 'fraction' END AS reason
  FROM raw r, LATERAL (SELECT * FROM (VALUES ('SalDate', r.SalDate, ''), ('BranchCode', r.BranchCode, 'int'), ('MaterialCode', r.MaterialCode, 'int'),
    ('TotalQtySale', r.TotalQtySale, 'int'), ('avgPrice', r.avgPrice, 'double'), ('avgPriceDis', r.avgPriceDis, 'double'),
    ('totalNetSale', r.totalNetSale, 'double'), ('supPrice', r.supPrice, 'double'), ('DayofMonth', r.DayofMonth, 'int'), ('label', r.label, 'int')) v(col, raw, kind)) c
  WHERE NOT r.torn)"""


@register(
    "quarantine_rejected",
    with_fixtures(
        f"""{_JUDGED_SQL},
found AS (SELECT col, raw, reason, SalDate, BranchCode, MaterialCode FROM cells WHERE reason IS NOT NULL
          UNION ALL SELECT NULL, concat_ws(',', SalDate, BranchCode, MaterialCode, coalesce(TotalQtySale, ''), coalesce(avgPrice, ''), avgPriceDis, totalNetSale,
                                           coalesce(supPrice, '')), 'corrupt record', SalDate, BranchCode, MaterialCode FROM raw WHERE torn)
SELECT col, CASE WHEN reason = 'corrupt record' THEN split_part(raw, ',', 1) || ',' || split_part(raw, ',', 2) || ',' || split_part(raw, ',', 3) ELSE raw END AS raw,
       reason, SalDate, BranchCode, MaterialCode FROM found""",
        "sales_raw_text",
    ),
)
def q_quarantine_rejected(spark, sf):
    """Every cell and line that keeps a row of a damaged text file out, with its reason."""
    cells = qu.rejected_cells(_quarantine(spark, sf)[1])
    torn = F.col("reason") == "corrupt record"
    raw = F.when(torn, F.substring_index("raw", ",", 3)).otherwise(F.col("raw"))  # the key part of a torn line
    return cells.select(F.col("column").alias("col"), raw.alias("raw"), "reason", *[F.col(f"record.{c}").alias(c) for c in KEY])


@register(
    "quarantine_kept",
    with_fixtures(
        f"""{_JUDGED_SQL},
bad AS (SELECT SalDate, BranchCode, MaterialCode FROM cells WHERE reason IS NOT NULL)
SELECT CAST(r.SalDate AS DATE) AS SalDate, CAST(r.BranchCode AS INTEGER) AS BranchCode, CAST(r.MaterialCode AS INTEGER) AS MaterialCode,
       CAST(TotalQtySale AS INTEGER) AS TotalQtySale, CAST(avgPrice AS DOUBLE) AS avgPrice, CAST(avgPriceDis AS DOUBLE) AS avgPriceDis,
       CAST(totalNetSale AS DOUBLE) AS totalNetSale, CAST(supPrice AS DOUBLE) AS supPrice, CAST(DayofMonth AS INTEGER) AS DayofMonth, CAST(label AS INTEGER) AS label
FROM raw r ANTI JOIN bad USING (SalDate, BranchCode, MaterialCode) WHERE NOT torn""",
        "sales_raw_text",
    ),
)
def q_quarantine_kept(spark, sf):
    return _quarantine(spark, sf)[0]


# --------------------------------------------------------------------------- sampling


def _split_sql(rest: bool) -> str:
    thr = sa.threshold_hex(SPLIT_FRACTION)
    h = f"substr(md5(concat_ws('|', CAST(SalDate AS VARCHAR), CAST(BranchCode AS VARCHAR), CAST(MaterialCode AS VARCHAR), '42')), 1, 8)"
    if not rest:
        return with_fixtures(f"SELECT * FROM sales WHERE {h} < '{thr}'", "sales")
    return with_fixtures(
        f"""smp AS (SELECT * FROM sales WHERE {h} < '{thr}')
SELECT * FROM sales s WHERE NOT EXISTS (
  SELECT 1 FROM smp WHERE smp.SalDate = s.SalDate AND smp.BranchCode = s.BranchCode AND smp.MaterialCode = s.MaterialCode)""",
        "sales",
    )


@register("stratified_sample", _split_sql(False))
def q_stratified_sample(spark, sf):
    return sa.stratified_split(_sales(spark, sf), SPLIT_FRACTION, "label", KEY, seed=42)[0]


@register("stratified_rest", _split_sql(True))
def q_stratified_rest(spark, sf):
    return sa.stratified_split(_sales(spark, sf), SPLIT_FRACTION, "label", KEY, seed=42)[1]


_EXACT_SQL = """
h AS (SELECT *, md5(concat_ws('|', CAST(SalDate AS VARCHAR), CAST(BranchCode AS VARCHAR), CAST(MaterialCode AS VARCHAR), '42')) AS h FROM sales),
n AS (SELECT label AS l, CAST(ceil(COUNT(*) * CAST({f} AS DOUBLE)) AS BIGINT) AS want FROM sales GROUP BY 1),
r AS (SELECT h.*, row_number() OVER (PARTITION BY label ORDER BY h, SalDate, BranchCode, MaterialCode) AS rn FROM h)
SELECT r.* EXCLUDE (h, rn) FROM r JOIN n ON r.label = n.l WHERE rn {op} want"""


@register("stratified_exact", with_fixtures(_EXACT_SQL.format(f=SPLIT_FRACTION, op="<="), "sales"))
def q_stratified_exact(spark, sf):
    return sa.stratified_split(_sales(spark, sf), SPLIT_FRACTION, "label", KEY, seed=42, exact=True)[0]


@register("stratified_exact_rest", with_fixtures(_EXACT_SQL.format(f=SPLIT_FRACTION, op=">"), "sales"))
def q_stratified_exact_rest(spark, sf):
    return sa.stratified_split(_sales(spark, sf), SPLIT_FRACTION, "label", KEY, seed=42, exact=True)[1]


@register(
    "distinct_labels",
    with_fixtures(f"SELECT DISTINCT label, CAST({SPLIT_FRACTION} AS DOUBLE) AS fraction FROM sales", "sales"),
)
def q_distinct_labels(spark, sf):
    return sa.distinct_labels(_sales(spark, sf), "label", SPLIT_FRACTION)


# --------------------------------------------------------------------------- encoders


def _index_sql(source: str, col: str, out: str, extra_cols: str, vec: bool) -> str:
    vec_cols = f", CAST(n_labels AS INTEGER) AS vec_size, CAST(idx AS INTEGER) AS vec_active" if vec else ""
    return f"""lab AS (SELECT CAST({col} AS VARCHAR) AS v, COUNT(*) AS n FROM {source} GROUP BY 1),
ix AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx, COUNT(*) OVER () AS n_labels FROM lab)
SELECT {extra_cols}, {col}, idx AS {out}{vec_cols}
FROM {source} JOIN ix ON CAST({source}.{col} AS VARCHAR) = ix.v"""


@register(
    "one_hot",
    with_fixtures(_index_sql("categories", "ProvinceEN", "ProvinceEN_idx", KEY_SQL, True), "categories"),
)
def q_one_hot(spark, sf):
    df = enc.one_hot(fx.categories(spark, sf), "ProvinceEN")
    return df.select(
        *KEY, "ProvinceEN", "ProvinceEN_idx", enc.one_hot_size(F.col("ProvinceEN_vec")).alias("vec_size"),
        enc.one_hot_active(F.col("ProvinceEN_vec")).alias("vec_active"),
    )


@register(
    "one_hot_zipcode",
    with_fixtures(_index_sql("categories", "ZipCode", "ZipCode_idx", KEY_SQL, True), "categories"),
)
def q_one_hot_zipcode(spark, sf):
    df = enc.one_hot(fx.categories(spark, sf), "ZipCode")
    return df.select(
        *KEY, "ZipCode", "ZipCode_idx", enc.one_hot_size(F.col("ZipCode_vec")).alias("vec_size"),
        enc.one_hot_active(F.col("ZipCode_vec")).alias("vec_active"),
    )


def _register_one_hot(name: str, source: str, col: str, key_sql: str, key: list[str], rows) -> None:
    @register(name, with_fixtures(_index_sql(source, col, f"{col}_idx", key_sql, True), source))
    def run(spark, sf):
        df = enc.one_hot(rows(spark, sf), col)
        return df.select(
            *key, col, f"{col}_idx", enc.one_hot_size(F.col(f"{col}_vec")).alias("vec_size"),
            enc.one_hot_active(F.col(f"{col}_vec")).alias("vec_active"),
        )


for _col in ("Holiday", "HolidayType"):
    _register_one_hot(f"one_hot_{_col.lower()}", "calendar", _col, KEY_SQL, KEY, lambda spark, sf: cal.encode_calendar(_sales(spark, sf)))
_TIER_KEY = ["BranchCode", "MaterailCode", "CALYEAR", "CALMONTH"]
_register_one_hot("one_hot_tier", "tier", "Tier", ", ".join(_TIER_KEY), _TIER_KEY, lambda spark, sf: fx.tier(spark, sf))


_MULTI_HOT = ["ProvinceEN", "DistrictEN", "ZipCode", "promotion"]


def _multi_hot_sql() -> str:
    ctes, sel, joins = [], [], []
    for i, c in enumerate(_MULTI_HOT):
        ctes.append(
            f"""lab{i} AS (SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n FROM categories GROUP BY 1),
ix{i} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx,
                 CAST(COUNT(*) OVER () AS INTEGER) AS sz FROM lab{i})"""
        )
        sel.append(f"c.{c}, ix{i}.idx AS {c}_idx, ix{i}.sz AS {c}_size, CAST(ix{i}.idx AS INTEGER) AS {c}_active")
        joins.append(f"JOIN ix{i} ON CAST(c.{c} AS VARCHAR) = ix{i}.v")
    body = ",\n".join(ctes) + f"\nSELECT c.SalDate, c.BranchCode, c.MaterialCode, {', '.join(sel)}\nFROM categories c " + " ".join(joins)
    return with_fixtures(body, "categories")


@register("one_hot_multi", _multi_hot_sql())
def q_one_hot_multi(spark, sf):
    df = enc.one_hot_many(fx.categories(spark, sf), _MULTI_HOT)
    out = [*KEY]
    for c in _MULTI_HOT:
        vec = F.col(f"{c}_vec")
        out += [c, f"{c}_idx", enc.one_hot_size(vec).alias(f"{c}_size"), enc.one_hot_active(vec).alias(f"{c}_active")]
    return df.select(*out)


@register(
    "string_index",
    with_fixtures(
        _index_sql("tier", "Tier", "tier_vec", "BranchCode, MaterailCode, CALYEAR, CALMONTH", False), "tier"
    ),
)
def q_string_index(spark, sf):
    return enc.string_index(fx.tier(spark, sf), "Tier", "tier_vec")


@register(
    "string_index_multi",
    with_fixtures(
        """lab1 AS (SELECT Holiday AS v, COUNT(*) AS n FROM calendar GROUP BY 1),
ix1 AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx FROM lab1),
lab2 AS (SELECT HolidayType AS v, COUNT(*) AS n FROM calendar GROUP BY 1),
ix2 AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx FROM lab2)
SELECT c.SalDate, c.BranchCode, c.MaterialCode, c.Holiday, c.HolidayType,
       ix1.idx AS Holiday_NUMERIC, ix2.idx AS HolidayType_NUMERIC
FROM calendar c JOIN ix1 ON c.Holiday = ix1.v JOIN ix2 ON c.HolidayType = ix2.v""",
        "calendar",
    ),
)
def q_string_index_multi(spark, sf):
    df = enc.string_index_multi(cal.encode_calendar(_sales(spark, sf)), ["Holiday", "HolidayType"])
    return df.select(*KEY, "Holiday", "HolidayType", "Holiday_NUMERIC", "HolidayType_NUMERIC")


_DICT_COLS = ["ProvinceEN", "DistrictEN", "ZipCode", "promotion"]
_KEY_HASH = "substr(md5(concat_ws('|', CAST(SalDate AS VARCHAR), CAST(BranchCode AS VARCHAR), CAST(MaterialCode AS VARCHAR), '42')), 1, 8)"


def _dictionary_sql() -> str:
    cells = " UNION ALL ".join(f"SELECT half, '{c}' AS col, CAST({c} AS VARCHAR) AS label FROM halves" for c in _DICT_COLS)
    return f"""halves AS (SELECT *, CASE WHEN {_KEY_HASH} < '{sa.threshold_hex(0.02)}' THEN 'sample' ELSE 'rest' END AS half FROM categories),
cells AS ({cells}),
lab AS (SELECT col, label, CAST(row_number() OVER (PARTITION BY col ORDER BY COUNT(*) DESC, label) - 1 AS INTEGER) AS idx
        FROM cells WHERE half = 'sample' AND label IS NOT NULL GROUP BY 1, 2),
size AS (SELECT col, CAST(COUNT(*) AS INTEGER) AS n FROM lab GROUP BY 1)
SELECT half, c.col AS col, c.label AS label, COALESCE(lab.idx, s.n) AS idx, s.n + 1 AS vec_size, COUNT(*) AS n_rows
FROM cells c JOIN size s ON s.col = c.col LEFT JOIN lab ON lab.col = c.col AND lab.label = c.label GROUP BY ALL"""


@register("label_dictionary", with_fixtures(_dictionary_sql(), "categories"))
def q_label_dictionary(spark, sf):
    """Encoders fitted on a small sample, saved, loaded, and applied to the sample and to all other rows."""
    sample, rest = sa.stratified_split(fx.categories(spark, sf), 0.02, "promotion", KEY, seed=42)
    path = fresh_path(spark, "label_model")
    enc.fit_one_hot(sample, _DICT_COLS, "keep").write().save(path)
    model = lb.LabelEncoderModel.load(path)
    both = sample.withColumn("half", F.lit("sample")).unionByName(rest.withColumn("half", F.lit("rest")))
    coded = model.transform(both)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("col"), F.col(c).cast("string").alias("label"), enc.one_hot_active(F.col(f"{c}_vec")).alias("idx"),
                enc.one_hot_size(F.col(f"{c}_vec")).alias("vec_size"),
            )
            for c in _DICT_COLS
        ]
    )
    return coded.select("half", F.explode(cells).alias("c")).groupBy("half", "c.col", "c.label", "c.idx", "c.vec_size").agg(F.count(F.lit(1)).alias("n_rows"))


_DICT_CUTS = ("2016-01-01", "2018-06-01")


@register(
    "label_dictionary_versions",
    with_fixtures(
        f"""cells AS (SELECT CASE WHEN SalDate < DATE '{_DICT_CUTS[0]}' THEN 1 WHEN SalDate < DATE '{_DICT_CUTS[1]}' THEN 2 ELSE 3 END AS v,
                 unnest([{{'col': 'MaterialCode', 'label': CAST(MaterialCode AS VARCHAR)}}, {{'col': 'TotalQtySale', 'label': CAST(TotalQtySale AS VARCHAR)}}]) AS c
          FROM sales),
n AS (SELECT c.col AS col, c.label AS label, v, COUNT(*) AS n FROM cells GROUP BY ALL),
seen AS (SELECT col, label, MIN(v) AS version, arg_min(n, v) AS n FROM n GROUP BY 1, 2)
SELECT col AS "column", label, CAST(row_number() OVER (PARTITION BY col ORDER BY version, n DESC, label) - 1 AS DOUBLE) AS idx,
       CAST(version AS INTEGER) AS version FROM seen""",
        "sales",
    ),
)
def q_label_dictionary_versions(spark, sf):
    """A dictionary fitted on the oldest sales, saved, and extended twice by newer ones in its folder."""
    s = _sales(spark, sf)
    cols = ["MaterialCode", "TotalQtySale"]
    first, second = (F.lit(x).cast("date") for x in _DICT_CUTS)
    path = fresh_path(spark, "label_model")
    lb.LabelEncoder(inputCols=cols, outputCols=[f"{c}_idx" for c in cols]).fit(s.where(F.col("SalDate") < first)).save(path)
    for newer in (s.where((F.col("SalDate") >= first) & (F.col("SalDate") < second)), s.where(F.col("SalDate") >= second)):
        lb.LabelEncoderModel.load(path).extended(newer).append_to(path)
    return lb.LabelEncoderModel.load(path).labels


# --------------------------------------------------------------------------- profile, models


@register(
    "dow_sales_profile",
    with_fixtures(
        f"""SELECT BranchCode, MaterialCode, DoW_Num, Total_Bill_Dow, Total_SumQTY_Dow, {r6("AVG_SumQTY_Dow")} AS AVG_SumQTY_Dow,
       {r6("MED_SumQTY_Dow")} AS MED_SumQTY_Dow, {r6("SD_SumQTY_Dow")} AS SD_SumQTY_Dow, NumWeekSale, MostSalesUnitFreq
FROM dow_profile""",
        "dow_profile",
    ),
)
def q_dow_sales_profile(spark, sf):
    return round6(pr.dow_sales_profile(_sales(spark, sf)), *_DOW_ROUND)


_TRAIN_FEATURES = ["avgPrice", "avgPriceDis", "supPrice", "DayofMonth"]


def _trained(spark, sf):
    train, test = sa.stratified_split(_sales(spark, sf), SPLIT_FRACTION, "label", KEY, seed=42)
    return mo.train_two_stage(train, _TRAIN_FEATURES, "TotalQtySale", classifier="gbt", regressor="rf"), test


_REST_SQL = _split_sql(True)


@register(
    "two_stage_trained",
    f"""WITH rest AS ({_REST_SQL}),
src AS (SELECT {o.band_case("TotalQtySale")} AS band_id FROM rest),
agg AS (SELECT band_id, COUNT(*) AS n FROM src GROUP BY band_id),
bands AS ({o.bands_values()})
SELECT b.band_id, b.Range, b.lower, b.upper, COALESCE(a.n, 0) AS count, COALESCE(a.n, 0) AS n_scored,
       CAST((SELECT SUM(n) FROM agg) AS BIGINT) AS "all"
FROM bands b LEFT JOIN agg a ON a.band_id = b.band_id""",
)
def q_two_stage_trained(spark, sf):
    """Train on the sample, score the rest: every row of the rest is scored, in its band."""
    (m1, m2), test = _trained(spark, sf)
    report = ev.range_report(mo.two_stage_score(test, m1, m2), "TotalQtySale", "pred_final")
    return report.select("band_id", "Range", "lower", "upper", "count", "n_scored", "all")


@register("model_roundtrip", f"SELECT COUNT(*) AS n_rows, COUNT(*) AS n_equal FROM ({_REST_SQL}) rest")
def q_model_roundtrip(spark, sf):
    """Predictions of the fitted and of the saved and loaded models, row by row."""
    models, test = _trained(spark, sf)
    path = fresh_path(spark, "two_stage_model")
    mo.save_two_stage(models, path)
    preds = ("pred_lv1", "pred_lv2", "pred_final")
    fitted = mo.two_stage_score(test, *models).withColumnsRenamed({c: f"fitted_{c}" for c in preds})
    both = mo.two_stage_score(fitted, *mo.load_two_stage(path))
    same = F.lit(True)
    for c in preds:
        same = same & (F.col(c) == F.col(f"fitted_{c}"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(same, 1)).alias("n_equal"))


@register(
    "stream_features",
    with_fixtures(
        f"""SELECT {KEY_SQL}, YYYY, MMMM, DDDD, Holiday, HolidayType, {o.welfare_case('"YYYY-MMMM"')} AS Welfare,
       CASE WHEN DDDD IN (1, 2, 3, 4, 5) THEN '1' ELSE '0' END AS welfareFlagDay FROM calendar""",
        "calendar",
    ),
)
def q_stream_features(spark, sf):
    """Sales land as parquet files; a file stream encodes them into a parquet sink, read back."""
    from bandwise.streaming.features import sales_stream, stream_features, write_stream

    s = _sales(spark, sf)
    src, sink = fresh_path(spark, "stream_src"), fresh_path(spark, "stream_sink")
    s.write.parquet(src)
    q = write_stream(stream_features(sales_stream(spark, src, s.schema)), sink)
    q.awaitTermination()
    return spark.read.parquet(sink).select(
        *KEY, "YYYY", "MMMM", "DDDD", "Holiday", "HolidayType", "Welfare", "welfareFlagDay"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
