"""The weekday sales profile and the column profile, kept by month in mergeable parts.

``replay_weekdays`` stores, for each (keys, weekday, month), the count of every quantity, the weeks with a sale and a KLL
quantile sketch; ``weekday_profile_from`` merges them. All exact columns of ``profile.dow_sales_profile`` follow from the
merged counts (their number is that of the distinct quantities, not of rows; weeks are told by their place in the month); with ``exact_median=False``
the median comes from the sketches, whose rank error is at most ``RANK_ERROR`` (KLL with k = 200; 99 % of the time).

``replay_columns`` stores, for each month and column, row and non-null counts and an HLL sketch;
``column_profile_from`` adds the counts and unites the sketches (relative error of the distinct
count about ``DISTINCT_ERROR``, one standard deviation at lgK = 12), without rescanning old months.

Both replace exactly the months they are given (dynamic partition overwrite), and read no other month of the source.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.functions.calendar import as_date

RANK_ERROR = 0.0165
DISTINCT_ERROR = 1.04 / 64
SLICES = 8  # of a month: groups are dealt to them by hash
STRETCH = 4096  # copies of a quantity that one array holds
_KEYS = ("BranchCode", "MaterialCode")


def _months(df: DataFrame, date_col: str, months: Sequence[dt.date] | None) -> DataFrame:
    """Rows of the months (any day of each), as ranges of the date column that reach the scan; with their first day as ``month``."""
    if months is not None:
        d, wanted = F.col(date_col), F.lit(False)
        for m in sorted({x.replace(day=1) for x in months}):
            after = (m + dt.timedelta(days=32)).replace(day=1)
            wanted = wanted | ((d >= F.lit(m)) & (d < F.lit(after)))
        df = df.where(wanted)
    return df.withColumn("month", F.trunc(as_date(df, date_col), "month"))


def _store(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def _weekday_parts(rows: DataFrame, keys: Sequence[str], d: Column, qty: str) -> DataFrame:
    """The state's rows, from one pass over the source: counts and weeks merge map-side by quantity, the rest follows from them.

    Each month is dealt in ``SLICES`` slices of whole groups, so that the last aggregate and the write share one shuffle.
    """
    group, q, c = [*keys, "DoW_Num", "month"], F.col("q"), F.col("c")
    monday = F.date_trunc("week", "month").cast("date")  # of the week that holds the month's first day
    week = (F.datediff(F.date_trunc("week", d).cast("date"), monday) / 7).cast("int")  # 0 to 5
    rows = rows.select(*keys, F.dayofweek(d).alias("DoW_Num"), "month", F.col(qty).alias("q"), week.alias("week"))
    sold = F.bit_or(F.when(q > 0, F.call_function("shiftleft", F.lit(1), F.col("week")))).alias("sold")
    values = rows.groupBy(*group, "q").agg(F.count(F.lit(1)).alias("c"), sold)
    values = values.withColumn("_slice", F.pmod(F.xxhash64(*keys, "DoW_Num"), F.lit(SLICES))).repartition("month", "_slice")
    # the sketch takes every quantity as often as it was counted, in stretches of bounded length
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.when(q.isNull(), F.lit(0).cast("long")).otherwise(c - 1), F.lit(STRETCH).cast("long")))
    place = F.explode(F.sequence("start", F.when(q.isNull(), F.col("start")).otherwise(F.least(F.col("start") + STRETCH, c) - 1)))
    copies = values.select("*", start.alias("start")).select(*group, "_slice", "q", "c", "sold", place.alias("place"))
    first = F.col("place") == 0
    parts = copies.groupBy(*group, "_slice").agg(
        F.sort_array(F.collect_list(F.when(first & q.isNotNull(), F.struct("q", "c")))).alias("counts"),
        F.sum(F.when(q.isNull(), c).otherwise(0)).alias("no_quantity"),
        F.bit_or("sold").alias("sold"),
        F.kll_sketch_agg_double(q.cast("double")).alias("sketch"),
    )
    weeks = F.transform(F.filter(F.sequence(F.lit(0), F.lit(5)), lambda i: F.getbit("sold", i) == 1), lambda i: F.date_add(monday, i * 7))
    return parts.select(*group, "counts", "no_quantity", weeks.alias("weeks"), "sketch")


def replay_weekdays(
    sales: DataFrame, path: str, months: Sequence[dt.date] | None = None, keys: Sequence[str] = _KEYS, date_col: str = "SalDate", qty: str = "TotalQtySale"
) -> None:
    """Replace the months of the state at ``path`` (None: all that ``sales`` has) by what ``sales`` holds for them."""
    _store(_weekday_parts(_months(sales, date_col, months), keys, as_date(sales, date_col), qty), path)


def weekday_profile_from(spark: SparkSession, path: str, keys: Sequence[str] = _KEYS, exact_median: bool = True) -> DataFrame:
    """``profile.dow_sales_profile`` of all rows that the state has seen, and ``n_values`` (distinct quantities).

    The state has one row per group and month, so a group's rows are few: one shuffle brings them together.
    """
    state, group = spark.read.parquet(path), [*keys, "DoW_Num"]
    value, no_week = state.schema["counts"].dataType.elementType, F.lit(None).cast("date")
    entry = f"struct<q:{value['q'].dataType.simpleString()},c:bigint,week:date>"

    def part(q, c, week) -> Column:
        return F.struct(q, c.cast("long"), week).cast(entry)

    none = F.lit(None).cast(value["q"].dataType)
    entries = F.concat(
        F.transform("counts", lambda x: part(x["q"], x["c"], no_week)),
        F.transform("weeks", lambda w: part(none, F.lit(0), w)),
        F.when(F.col("no_quantity") > 0, F.array(part(none, F.col("no_quantity"), no_week))).otherwise(F.array().cast(f"array<{entry}>")),
    )
    rows = state.select(*group, "counts", "weeks", "no_quantity").repartition(*group).select(*group, F.explode(entries).alias("v"))
    values = rows.groupBy(*group, "v.q", "v.week").agg(F.sum("v.c").alias("c"))
    q, c = F.col("q"), F.col("c")
    rows = values.groupBy(*group).agg(
        F.sum(F.when(q.isNull(), c).otherwise(0)).alias("no_quantity"),
        F.count("week").cast("int").alias("NumWeekSale"),
        F.sort_array(F.collect_list(F.when(q.isNotNull(), F.struct("q", "c")))).alias("v"),
    )
    if not exact_median:
        sketches = state.groupBy(*group).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in group]  # a NULL key is a group too
        rows = rows.alias("a").join(sketches.alias("b"), same).select("a.*", "b.sketch")
    n = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x["c"])
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x["q"] * x["c"])
    rows = rows.select("*", n.alias("n"), total.alias("total")).withColumn("mean", F.try_divide("total", "n"))
    m2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x["c"] * F.pow(x["q"] - F.col("mean"), 2))
    lower, upper = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)

    def passed(s, x) -> Column:
        """The rows passed so far, and the quantities at the two middle places (from 0) of the sorted rows."""
        upto = s["n"] + x["c"]
        q = x["q"].cast("double")
        return F.struct(
            upto.alias("n"),
            F.when((s["n"] <= lower) & (upto > lower), q).otherwise(s["a"]).alias("a"),
            F.when((s["n"] <= upper) & (upto > upper), q).otherwise(s["b"]).alias("b"),
        )

    if exact_median:
        unseen = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
        median = F.when(F.col("n") > 0, F.aggregate("v", unseen, passed, lambda s: (s["a"] + s["b"]) / 2))
    else:
        median = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    most = F.array_max(F.transform("v", lambda x: F.struct(x["c"].alias("c"), (-x["q"]).alias("q"))))
    return rows.select(
        *group,
        (F.col("n") + F.col("no_quantity")).cast("int").alias("Total_Bill_Dow"),
        F.when(F.col("n") > 0, F.col("total").cast("long")).alias("Total_SumQTY_Dow"),
        F.col("mean").alias("AVG_SumQTY_Dow"),
        median.alias("MED_SumQTY_Dow"),
        F.when(F.col("n") == 1, F.lit(0.0)).when(F.col("n") > 1, F.sqrt(m2 / (F.col("n") - 1))).alias("SD_SumQTY_Dow"),
        "NumWeekSale",
        (-most["q"]).cast("double").alias("MostSalesUnitFreq"),
        F.size("v").alias("n_values"),
    )


def replay_columns(df: DataFrame, path: str, months: Sequence[dt.date] | None = None, date_col: str = "SalDate") -> None:
    """Replace the months of the column profile at ``path``: one aggregate over the months' rows, whatever the number of columns."""
    names, types = df.columns, dict(df.dtypes)
    rows = _months(df, date_col, months)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(names):
        # the text of a value tells values apart, whatever its type
        aggs += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.hll_sketch_agg(F.col(f"`{c}`").cast("string")).alias(f"s{i}")]
    wide = rows.groupBy("month").agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"n{i}").alias("non_null"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(names)]
    _store(wide.select("month", "n_rows", F.explode(F.array(*cells)).alias("c")).select("month", "n_rows", "c.*").repartition("month"), path)


def column_profile_from(spark: SparkSession, path: str) -> DataFrame:
    """column_name, data_type, non_null, n_null and approx_distinct of all months, from the stored rows alone."""
    state = spark.read.parquet(path)
    merged = state.groupBy("column_name", "data_type").agg(
        F.sum("non_null").alias("non_null"), F.sum(F.col("n_rows") - F.col("non_null")).alias("n_null"), F.hll_union_agg("sketch").alias("sketch")
    )
    return merged.select("column_name", "data_type", "non_null", "n_null", F.hll_sketch_estimate("sketch").alias("approx_distinct"))
