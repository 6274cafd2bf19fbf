"""Weekday sales profile per (branch, material, weekday).

Every aggregate here merges map-side: count/sum/avg/stddev by sums, median and
mode through a value -> count map (its size is the number of distinct
quantities, not rows), and the distinct weeks as a set bounded by the calendar.
One hot (branch, material) group costs no more than its distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.calendar import as_date


def dow_sales_profile(
    sales: DataFrame,
    keys: Sequence[str] = ("BranchCode", "MaterialCode"),
    date_col: str = "SalDate",
    qty: str = "TotalQtySale",
    exact_median: bool = True,
) -> DataFrame:
    """DoW_Num (1 = Sunday), Total_Bill_Dow, Total_SumQTY_Dow, AVG/MED/SD_SumQTY_Dow,
    NumWeekSale (distinct weeks with a sale) and MostSalesUnitFreq (most frequent
    quantity, smallest on ties). A single observation has standard deviation 0."""
    d = as_date(sales, date_col)
    q = F.col(qty)
    med = F.median(q) if exact_median else F.percentile_approx(q, 0.5).cast("double")
    return sales.groupBy(*keys, F.dayofweek(d).alias("DoW_Num")).agg(
        F.count(F.lit(1)).cast("int").alias("Total_Bill_Dow"),
        F.sum(q).cast("long").alias("Total_SumQTY_Dow"),
        F.avg(q).alias("AVG_SumQTY_Dow"),
        med.alias("MED_SumQTY_Dow"),
        F.coalesce(F.stddev_samp(q), F.when(F.count(q) == 1, F.lit(0.0))).alias("SD_SumQTY_Dow"),
        F.size(F.collect_set(F.when(q > 0, F.date_trunc("week", d)))).alias("NumWeekSale"),
        F.mode(q, deterministic=True).cast("double").alias("MostSalesUnitFreq"),
    )
