"""Calendar, holiday, welfare and tier encoders as column expressions.

The original module applies these as row-at-a-time Python UDFs; here each lookup is
a literal map or CASE expression evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original module's lookup tables).
# Holiday calendar: 'day-month' key, holiday name, holiday type.
# ('Goverment' is spelled as in the source data.)
HOLIDAYS = [
    ("1-1", "NewYear", "National"),
    ("5-2", "ChineseDay", "Regional"),
    ("8-4", "Chakri", "National"),
    ("13-4", "Songkran", "National"),
    ("14-4", "Songkran", "National"),
    ("15-4", "Songkran", "National"),
    ("16-4", "Songkran", "National"),
    ("1-5", "Labour", "National"),
    ("6-5", "King", "National"),
    ("9-5", "Ploughing", "Goverment"),
    ("3-6", "Queen", "National"),
    ("12-8", "Mother", "Public"),
    ("14-10", "King9Passing", "National"),
    ("23-10", "Chulalongkorn", "National"),
    ("5-12", "King9", "Public"),
    ("10-12", "Constitution", "National"),
    ("24-12", "BeforeChristmas", "Public"),
    ("25-12", "Christmas", "Public"),
    ("30-12", "NewYearEve", "National"),
    ("31-12", "NewYearEve", "National"),
]
NORMAL_DAY = "Normal"
# Welfare amount: 500 in these 'year-month' keys, 700 otherwise.
WELFARE_LOW_MONTHS = ["2019-5", "2019-6", "2020-10", "2020-11", "2020-12", "2021-1"]
WELFARE_LOW, WELFARE_HIGH = 500, 700
# Tier label -> number; anything else (NULL included) is 5.
TIER_NUMBERS = [("T1", 1), ("T2", 2), ("T3", 3), ("T4", 4)]
TIER_DEFAULT = 5
# Days of month that count as welfare-payment days.
WELFARE_DAYS = [1, 2, 3, 4, 5]
# MonthQuarter: day <= 8 -> 0, <= 16 -> 1, <= 24 -> 2, else 3.
MONTH_QUARTER_EDGES = [8, 16, 24]
# ---------------------------------------------------------------------------


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def as_date(df: DataFrame, col: str) -> Column:
    """``col`` as a DateType column (strings 'YYYY-MM-DD' parse, bad text -> NULL)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.DateType):
        return F.col(col)
    if isinstance(dtype, T.StringType):
        return F.try_to_date(F.col(col))
    return F.to_date(F.col(col))


def holiday_name(day_month: Column) -> Column:
    return F.coalesce(F.try_element_at(_map((k, n) for k, n, _ in HOLIDAYS), day_month), F.lit(NORMAL_DAY))


def holiday_type(day_month: Column) -> Column:
    return F.coalesce(F.try_element_at(_map((k, t) for k, _, t in HOLIDAYS), day_month), F.lit(NORMAL_DAY))


def welfare_amount(year_month: Column) -> Column:
    """Welfare amount as the original module's string-typed column ('500'/'700')."""
    return F.when(year_month.isin(*WELFARE_LOW_MONTHS), F.lit(str(WELFARE_LOW))).otherwise(F.lit(str(WELFARE_HIGH)))


def tier_number(tier: Column) -> Column:
    """Tier label to its number, as a string ('1'..'5')."""
    expr = F.when(F.lit(False), F.lit(None))
    for label, num in TIER_NUMBERS:
        expr = expr.when(tier == label, F.lit(str(num)))
    return expr.otherwise(F.lit(str(TIER_DEFAULT)))


def welfare_day_flag(day: Column) -> Column:
    """'1' on welfare-payment days of the month, else '0' (NULL -> '0')."""
    return F.when(day.isin(*WELFARE_DAYS), F.lit("1")).otherwise(F.lit("0"))


def month_quarter(day: Column) -> Column:
    a, b, c = MONTH_QUARTER_EDGES
    return F.when(day <= a, 0).when(day <= b, 1).when(day <= c, 2).otherwise(3)


def encode_calendar(df: DataFrame, date_col: str = "SalDate") -> DataFrame:
    """Date parts, 'D-M' / 'YYYY-M' keys, YY/MM, Holiday, HolidayType; codes cast to int.

    Adds YYYY, MMMM, DDDD, ``DDDD-MMMM``, ``YYYY-MMMM``, YY, MM, Holiday and
    HolidayType; renames ``Branchcode`` to ``BranchCode`` and casts BranchCode
    and MaterialCode to int (bad text becomes NULL).
    """
    d = as_date(df, date_col)
    y, m, dd = F.year(d), F.month(d), F.dayofmonth(d)
    dm = F.concat(dd.cast("string"), F.lit("-"), m.cast("string"))
    out = df.withColumns(
        {
            "YYYY": y,
            "MMMM": m,
            "DDDD": dd,
            "DDDD-MMMM": dm,
            "YYYY-MMMM": F.concat(y.cast("string"), F.lit("-"), m.cast("string")),
            "YY": y,
            "MM": m,
            "Holiday": holiday_name(dm),
            "HolidayType": holiday_type(dm),
        }
    )
    return normalise_codes(out)


def normalise_codes(df: DataFrame) -> DataFrame:
    """``Branchcode`` -> ``BranchCode``; both codes as int via a lenient cast."""
    if "Branchcode" in df.columns and "BranchCode" not in df.columns:
        df = df.withColumnRenamed("Branchcode", "BranchCode")
    casts = {c: cast_to(df, c, "int") for c in ("BranchCode", "MaterialCode") if c in df.columns}
    return df.withColumns(casts) if casts else df


_INTEGRAL = ("int", "integer", "bigint", "long", "smallint", "tinyint")


def lenient_cast(c: Column, to: str) -> Column:
    """The non-ANSI cast the original module relies on: '3.7' -> 3 for int, 'abc' -> NULL."""
    if to in _INTEGRAL:
        return c.try_cast("double").try_cast(to)
    return c.try_cast(to)


def cast_to(df: DataFrame, col: str, to: str) -> Column:
    """Lenient cast of ``df[col]``; a no-op when the column already has the type,
    and only text takes the detour through double."""
    src = df.schema[col].dataType
    target = T._parse_datatype_string("int" if to == "integer" else to)
    if src == target:
        return F.col(col)
    if isinstance(src, T.StringType):
        return lenient_cast(F.col(col), to)
    return F.col(col).try_cast(to)


def encode_welfare(df: DataFrame, year_month_col: str = "YYYY-MMMM") -> DataFrame:
    return df.withColumn("Welfare", welfare_amount(F.col(year_month_col)))


def encode_tier(df: DataFrame, tier_col: str = "Tier") -> DataFrame:
    return df.withColumn("TierNumeric", tier_number(F.col(tier_col)))


def add_welfare_day_flag(df: DataFrame, day_col: str = "DDDD") -> DataFrame:
    return df.withColumn("welfareFlagDay", welfare_day_flag(F.col(day_col)))


def extract_date(df: DataFrame, date_col: str = "SalDate", day_col: str = "DayofMonth") -> DataFrame:
    """Drop all-NULL rows, then add Yearday, Month, DayofWeek (1 = Sunday), Year,
    Quarter, WeekOfYear (ISO) and MonthQuarter. DayofMonth is derived if absent."""
    df = df.na.drop(how="all")
    d = as_date(df, date_col)
    if day_col not in df.columns:
        df = df.withColumn(day_col, F.dayofmonth(d))
    return df.withColumns(
        {
            "Yearday": F.dayofyear(d),
            "Month": F.month(d),
            "DayofWeek": F.dayofweek(d),
            "Year": F.year(d),
            "Quarter": F.quarter(d),
            "WeekOfYear": F.weekofyear(d),
            "MonthQuarter": month_quarter(F.col(day_col)),
        }
    )


def rename_parts(df: DataFrame) -> DataFrame:
    """DDDD -> Day, MMMM -> Month, YYYY -> Year."""
    return df.withColumnsRenamed({"DDDD": "Day", "MMMM": "Month", "YYYY": "Year"})
