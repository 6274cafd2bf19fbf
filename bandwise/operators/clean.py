"""Row filters, projections and typed cleaning driven by cast profiles.

The original module has ten near-identical ``clean*`` functions: drop incomplete
rows, then cast a fixed list of columns. Here one ``clean(df, profile)`` does
that; each profile is a column -> type table. Casts are lenient (the old
non-ANSI behaviour): '3.7' becomes 3 for an int column, 'abc' becomes NULL.
Nulls created by the casts after the drop are kept, as in the original module.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwise.functions.calendar import cast_to

_INT, _DBL = "int", "double"


def _profile(ints: Sequence[str], doubles: Sequence[str]) -> dict[str, str]:
    return {**{c: _INT for c in ints}, **{c: _DBL for c in doubles}}


_BASIC_KEYS = ["BranchCode", "MaterialCode"]
_BASIC_PRICES = ["avgPriceDis", "avgPrice", "supPrice"]
_LABELS_INT = ["TotalQtySale", "label"]
_BINARY_INTS = ["Year", "welfareFlag", "welfareFlagDay", "ZipCode"]
_DOW_INTS = ["DoW_Num", "Total_Bill_Dow", "Total_SumQTY_Dow", "NumWeekSale", "HighQualityFlag"]
_DOW_DOUBLES = ["AVG_SumQTY_Dow", "MED_SumQTY_Dow", "SD_SumQTY_Dow"]

# Which column gets which type (one profile per original clean* variant).
CAST_PROFILES: dict[str, dict[str, str]] = {
    # clean: the full feature table
    "full": _profile(
        [
            "welfareFlag",
            "welfareFlagDay",
            "supPrice",
            "BranchCode",
            "MaterialCode",
            "TotalQtySale",
            "Month",
            "Day",
            "Year",
            "Welfare",
            "TierNumeric",
        ],
        ["avgPriceDis", "avgPrice", "Price_Sensitivity", "temp"],
    ),
    # clean_basic: training rows
    "basic_train": _profile(_BASIC_KEYS + _LABELS_INT, _BASIC_PRICES + ["totalNetSale"]),
    # clean_basic_v2 / clean_basic2: scoring rows (no label columns)
    "basic_score": _profile(_BASIC_KEYS, _BASIC_PRICES),
    # clean_binary
    "binary_train": _profile(_BASIC_KEYS + _LABELS_INT + _BINARY_INTS, _BASIC_PRICES + ["totalNetSale"]),
    # clean_binary_2 / clean_binary_2_2
    "binary_score": _profile(_BASIC_KEYS + _BINARY_INTS, _BASIC_PRICES),
    # clean_binary_3
    "dow_train": _profile(
        _BASIC_KEYS + _LABELS_INT + _BINARY_INTS + _DOW_INTS, _BASIC_PRICES + ["totalNetSale"] + _DOW_DOUBLES
    ),
    # clean_binary_3_2
    "dow_score": _profile(_BASIC_KEYS + _BINARY_INTS + _DOW_INTS, _BASIC_PRICES + _DOW_DOUBLES),
    # clean_binary_4: no Total_Bill_Dow, plus MostSalesUnitFreq
    "dow_freq_score": _profile(
        _BASIC_KEYS + _BINARY_INTS + [c for c in _DOW_INTS if c != "Total_Bill_Dow"],
        _BASIC_PRICES + _DOW_DOUBLES + ["MostSalesUnitFreq"],
    ),
}


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column.

    Spelled out per column, so that the optimizer sees which columns cannot be
    NULL: outer joins below become inner ones and filters reach the scans.
    """
    ok = F.lit(True)
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        ok = ok & c.isNotNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(c)
    return df.filter(ok)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows that are NULL (or NaN) in every column."""
    return df.na.drop(how="all")


def cast_columns(df: DataFrame, profile: dict[str, str]) -> DataFrame:
    """Lenient casts of the profile's columns; a column that ``df`` lacks is an error (names match as Spark's do)."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    have = {c if sensitive else c.lower(): c for c in df.columns}
    found = {c: have.get(c if sensitive else c.lower()) for c in profile}
    if missing := [c for c, own in found.items() if own is None]:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.withColumns({own: cast_to(df, own, profile[c]) for c, own in found.items()})


def clean(df: DataFrame, profile: str | dict[str, str] = "full") -> DataFrame:
    """Drop incomplete rows, then cast by ``profile`` (a name in CAST_PROFILES or a dict)."""
    prof = CAST_PROFILES[profile] if isinstance(profile, str) else profile
    return cast_columns(drop_incomplete(df), prof)


def select_variable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range ``lo <= col <= hi`` (pushed to the scan when ``col`` is stored)."""
    return df.filter(F.col(col).between(lo, hi))


def filter_exact(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == value)


def profile_columns(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per column: data type, non-null count, null count (one scan, one tiny aggregate).

    Re-aims the original module's metadata-only "columns per type" table at the data:
    one ``agg`` computes every count, then ``unpivot`` turns it into one row
    per column. ``approx_distinct`` adds an HLL distinct estimate.
    """
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.col(c)).alias(f"nn_{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"ad_{i}"))
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col(f"nn_{i}").alias("non_null"),
            *([F.col(f"ad_{i}").alias("approx_distinct")] if approx_distinct else []),
        )
        for i, c in enumerate(df.columns)
    ]
    long = wide.select(F.col("__rows"), F.explode(F.array(*rows)).alias("c")).select("c.*", "__rows")
    return long.select(
        "column_name",
        "data_type",
        F.col("non_null"),
        (F.col("__rows") - F.col("non_null")).alias("n_null"),
        *(["approx_distinct"] if approx_distinct else []),
    )


def column_type_counts(df: DataFrame) -> DataFrame:
    """The original module's table literally: columns per data type, names joined by ' | '."""
    spark = df.sparkSession
    rows = [(c, t) for c, t in df.dtypes]
    meta = spark.createDataFrame(rows, T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())]))
    return meta.groupBy("type").agg(
        F.count(F.lit(1)).alias("count"), F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("names")
    )
