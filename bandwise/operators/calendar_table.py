"""Calendars as tables: holidays, welfare amounts and other values that hold for intervals of days.

A rule is a row (``RULES``): the days from ``first`` to ``last`` (NULL: one day), once or ``yearly`` (the same days of every later
year), never after ``until`` (NULL: no end), with a ``priority`` among rules that meet on a day, and value columns such as ``name`` and
``type``. Key columns (a country, a branch) make a rule hold for their rows only. So another country, another year's moving
holidays or a change of a holiday's date are data, not code.

``expand`` turns rules into one row for each (key, day) of the days asked for; the facts are joined to it by equality. The expanded table
is written once and counted: up to ``BROADCAST_DAYS`` rows it is broadcast, beyond that (calendars by key that grow with
the data) the planner chooses.

Defined results: among rules that meet on a day the highest priority wins, then the latest ``first``, then the values that sort last; a yearly rule of 29 February
holds in leap years only; rows with a NULL date or key, and days without a rule, get the defaults; a rule without ``first`` holds never.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions import calendar as cal
from bandwise.session import written

RULES = "first date, last date, yearly boolean, until date, priority int"
BROADCAST_DAYS = 100_000
_HOLIDAY_RULES = f"{RULES}, name string, type string"
_AMOUNT_RULES = f"{RULES}, amount string"
_SINCE = 1900  # the literal calendar has no first year


def default_holidays(spark: SparkSession) -> DataFrame:
    """The literal holiday calendar (``functions.calendar.HOLIDAYS``) as yearly rules."""
    rows = []
    for key, name, kind in cal.HOLIDAYS:
        day, month = map(int, key.split("-"))
        rows.append((dt.date(_SINCE, month, day), None, True, None, 0, name, kind))
    return spark.createDataFrame(rows, _HOLIDAY_RULES)


def default_amounts(spark: SparkSession) -> DataFrame:
    """The months of the lower welfare amount as rules."""
    rows = []
    for key in cal.WELFARE_LOW_MONTHS:
        year, month = map(int, key.split("-"))
        end = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)
        rows.append((dt.date(year, month, 1), end, False, None, 0, str(cal.WELFARE_LOW)))
    return spark.createDataFrame(rows, _AMOUNT_RULES)


def read_rules(spark: SparkSession, path: str, values: str = "name string, type string", keys: str | None = None) -> DataFrame:
    """Rules from a headed CSV file; a line that does not fit is an error, not a silently missing holiday."""
    schema = ", ".join(x for x in (keys, RULES, values) if x)
    return spark.read.option("header", "true").option("mode", "FAILFAST").schema(schema).csv(path)


def expand(rules: DataFrame, since: dt.date, until: dt.date, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, day, values): the rule that holds on each day from ``since`` to ``until``."""
    first, last = F.col("first"), F.greatest(F.col("first"), F.coalesce("last", "first"))
    years = F.when(F.coalesce("yearly", F.lit(False)), F.lit(until.year) - F.year(first)).otherwise(F.lit(0))
    rows = rules.where("first IS NOT NULL").select(
        *keys, *values, F.coalesce("priority", F.lit(0)).alias("priority"), "first", "until",
        F.date_diff(last, first).alias("_length"), F.explode(F.sequence(F.lit(0), F.greatest(years, F.lit(0)))).alias("_k"),
    )
    same_day = F.try_to_date(F.format_string("%04d-%02d-%02d", F.year("first") + F.col("_k"), F.month("first"), F.dayofmonth("first")))
    rows = rows.withColumn("_from", F.when(F.col("_k") == 0, F.col("first")).otherwise(same_day)).where("_from IS NOT NULL")
    begin = F.greatest(F.col("_from"), F.lit(since))
    end = F.least(F.date_add("_from", F.col("_length")), F.lit(until), F.coalesce("until", F.lit(until)))
    rows = rows.where(begin <= end).select("*", F.explode(F.sequence(begin, end)).alias("day"))
    best = F.max_by(F.struct(*values), F.struct("priority", "first", *values)).alias("_v")
    return rows.groupBy(*keys, "day").agg(best).select(*keys, "day", "_v.*")


def lookup(
    df: DataFrame,
    rules: DataFrame,
    outputs: Mapping[str, tuple[str, object]],
    date_col: str = "SalDate",
    keys: Sequence[str] = (),
    between: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """``df`` with ``outputs`` ({new column: (value column of the rules, default)}); a column of that name is replaced.

    ``between`` are the first and last day of ``df``; without it one aggregate finds them.
    """
    if between is None:
        day = cal.as_date(df, date_col)
        between = tuple(df.agg(F.min(day), F.max(day)).first())
    values = list(dict.fromkeys(v for v, _ in outputs.values()))
    if between[0] is None:  # no dates at all
        return df.withColumns({out: F.lit(default) for out, (_, default) in outputs.items()})
    days = written(expand(rules, *between, values, keys), "calendar")
    own = {c: f"_rule_{c}" for c in (*keys, "day", *values)}
    days = days.withColumnsRenamed(own)
    if days.count() <= BROADCAST_DAYS:
        days = F.broadcast(days)
    same = days[own["day"]] == cal.as_date(df, date_col)
    for k in keys:
        same = same & (days[own[k]] == df[f"`{k}`"])
    joined = df.join(days, same, "left")
    kept = [df[f"`{c}`"] for c in df.columns if c not in outputs]
    return joined.select(*kept, *[F.coalesce(days[own[v]], F.lit(default)).alias(out) for out, (v, default) in outputs.items()])


def encode_holidays(df: DataFrame, rules: DataFrame | None = None, date_col: str = "SalDate", keys: Sequence[str] = (), between=None) -> DataFrame:
    """Holiday and HolidayType by a holiday table (default: the literal calendar)."""
    rules = default_holidays(df.sparkSession) if rules is None else rules
    return lookup(df, rules, {"Holiday": ("name", cal.NORMAL_DAY), "HolidayType": ("type", cal.NORMAL_DAY)}, date_col, keys, between)


def encode_calendar(df: DataFrame, rules: DataFrame | None = None, date_col: str = "SalDate", keys: Sequence[str] = (), between=None) -> DataFrame:
    """``functions.calendar.encode_calendar`` with the holidays of a table."""
    return encode_holidays(cal.encode_calendar(df, date_col), rules, date_col, keys, between)


def encode_welfare(df: DataFrame, rules: DataFrame | None = None, date_col: str = "SalDate", default: str = str(cal.WELFARE_HIGH), keys: Sequence[str] = (), between=None) -> DataFrame:
    """Welfare (text, as in the literal encoder) by a table of amounts."""
    rules = default_amounts(df.sparkSession) if rules is None else rules
    return lookup(df, rules, {"Welfare": ("amount", default)}, date_col, keys, between)
