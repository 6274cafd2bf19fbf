"""Scoring-side column functions: uplift, error classes, sales bands, distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the original module's).
# Sales-quantity bands of the error reports, closed intervals (lower, upper),
# in report order.
SALES_BANDS = [
    (0, 0),
    (1, 1),
    (2, 2),
    (3, 3),
    (4, 6),
    (7, 10),
    (11, 15),
    (16, 25),
    (26, 40),
    (41, 60),
    (61, 100),
    (101, 200),
    (201, 400),
    (401, 700),
    (701, 1200),
    (1201, 1800),
    (1801, 3000),
]
# Post-score uplift: day 1 -> p + p / 2; days 2..5 -> p + p / 2.5; else p.
UPLIFT_FIRST_DAY_DIVISOR = 2.0
UPLIFT_DAYS_2_TO_5_DIVISOR = 2.5
# Over/under labels of a prediction against the actual value.
UPPER, LOWER = "Upper", "Lower"
# ---------------------------------------------------------------------------


def band_label(lo: int, hi: int) -> str:
    """Report-1 display label: '3' for a single value, '4 to 6' for a span."""
    return str(lo) if lo == hi else f"{lo} to {hi}"


def band_key(lo: int, hi: int) -> str:
    """Report-2 label 'lo-hi'."""
    return f"{lo}-{hi}"


def bands_frame(spark: SparkSession, bands=None, with_outside: bool = False) -> DataFrame:
    """The band table: band_id, Range (display), bounds ('lo-hi'), lower, upper.

    A literal VALUES relation (a local table scan, no Python worker) with one
    row per band. ``with_outside`` adds band 0 for values in no band.
    """
    bands = SALES_BANDS if bands is None else bands
    rows = [(i + 1, band_label(lo, hi), band_key(lo, hi), lo, hi) for i, (lo, hi) in enumerate(bands)]
    if with_outside:
        rows.insert(0, (0, "outside", "outside", None, None))

    def lit(v):
        return "NULL" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'")

    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(
        f"SELECT CAST(band_id AS INT) AS band_id, Range, bounds, CAST(lower AS INT) AS lower, "
        f"CAST(upper AS INT) AS upper FROM VALUES {values} AS t(band_id, Range, bounds, lower, upper)"
    )


def band_of(value: Column, bands=None) -> Column:
    """band_id of the first band with lower <= value <= upper, else NULL."""
    bands = SALES_BANDS if bands is None else bands
    expr = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, (lo, hi) in enumerate(bands):
        expr = expr.when(value.between(lo, hi), F.lit(i + 1))
    return expr


def uplift(pred: Column, day: Column) -> Column:
    """Post-score uplift for the first days of the month."""
    return (
        F.when(day == 1, pred + pred / UPLIFT_FIRST_DAY_DIVISOR)
        .when(day.between(2, 5), pred + pred / UPLIFT_DAYS_2_TO_5_DIVISOR)
        .otherwise(pred)
    )


def post_score(df: DataFrame, pred: str = "predict_qty", day: str = "Day", out: str | None = None) -> DataFrame:
    """Apply the uplift to ``pred``; write to ``out`` (default: overwrite ``pred``)."""
    return df.withColumn(out or pred, uplift(F.col(pred), F.col(day)))


def prediction_type(pred: Column, actual: Column) -> Column:
    """'Upper' when the prediction is at or above the actual value, else 'Lower'."""
    return F.when(pred >= actual, F.lit(UPPER)).otherwise(F.lit(LOWER))


def classify_error(df: DataFrame, label: str = "label", pred: str = "predict_qty") -> DataFrame:
    """Add prediction_type and prediction_diff = |pred - label| (double)."""
    return df.withColumns(
        {
            "prediction_type": prediction_type(F.col(pred), F.col(label)),
            "prediction_diff": F.abs(F.col(pred) - F.col(label)).cast("double"),
        }
    )


def planar_distance(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Euclidean distance in degrees, as the original module measures store-to-station."""
    dlat, dlng = lat1 - lat2, lng1 - lng2
    return F.sqrt(dlat * dlat + dlng * dlng)
