"""Error reports kept up to date by day, without rescoring history.

The state is a table partitioned by day. A row holds the mergeable moments of one (day, band, prediction type): counts, sums of
squared and absolute errors, n / mean / M2 of the labels (for r2), and counts and sums of the averaged
columns. ``replay`` recomputes given days from scored rows and replaces exactly their
partitions (dynamic partition overwrite); the day filter reaches the scored table's scan, so no other day is read.
``range_report_from`` and ``over_under_report_from`` add up the state: label variances are merged pairwise
(Chan, Golub and LeVeque: M2 = M2a + M2b + d² na nb / (na + nb)), here for all days at once around the common mean.

A day without rows any more keeps an empty marker row, so it is replaced too. Rows without a day cannot be placed:
they belong to the NULL partition, replayed as ``None``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwise.functions.scoring import SALES_BANDS, band_of, bands_frame, classify_error
from bandwise.operators.evaluate import _L, _P, _metrics_from_parts

AVERAGED = ("avgPriceDis", "avgPrice", "supPrice")
_MOMENTS = ("n", "n_scored", "_sse", "_sae", "_mean", "_m2", "_lmin", "_lmax")
OUTSIDE = 0  # band of the rows in no band


def _moments() -> list[Column]:
    err = F.col(_P) - F.col(_L)
    label = F.when(err.isNotNull(), F.col(_L))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(err).alias("n_scored"),
        F.sum(err * err).alias("_sse"),
        F.sum(F.abs(err)).alias("_sae"),
        F.avg(label).alias("_mean"),
        (F.var_pop(label) * F.count(label)).alias("_m2"),
        F.min(label).alias("_lmin"),
        F.max(label).alias("_lmax"),
    ]


def day_state(
    scored: DataFrame,
    day_col: str = "SalDate",
    label: str = "TotalQtySale",
    pred: str = "pred_final",
    value_cols: Sequence[str] = AVERAGED,
    bands: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """Moments of every (day, band, prediction type): at most 2 x (bands + 1) rows a day, merged map-side."""
    bands = SALES_BANDS if bands is None else list(bands)
    if "prediction_type" not in scored.columns:
        scored = classify_error(scored, label, pred)
    averaged = {"pred": F.col(pred), "diff": F.col("prediction_diff"), **{c: F.col(c) for c in value_cols}}
    rows = scored.select(
        F.col(day_col).cast("date").alias("day"),
        F.coalesce(band_of(F.col(label), bands), F.lit(OUTSIDE)).alias("band_id"),
        "prediction_type",
        F.col(label).cast("double").alias(_L),
        F.col(pred).cast("double").alias(_P),
        *[c.cast("double").alias(f"v_{k}") for k, c in averaged.items()],
    )
    sums = [f(F.col(f"v_{k}")).alias(f"{name}_{k}") for k in averaged for name, f in (("c", F.count), ("s", F.sum))]
    return rows.groupBy("day", "band_id", "prediction_type").agg(*_moments(), *sums)


def replay(scored: DataFrame, path: str, days: Sequence[dt.date | None] | None = None, day_col: str = "SalDate", **params) -> None:
    """Replace the given days of the state at ``path`` by what ``scored`` holds for them now (None: every day it holds).

    ``day_col`` must be the stored date column for the filter to prune partitions; ``params`` go to ``day_state``.
    """
    spark = scored.sparkSession
    if days is not None:
        day = F.col(day_col)
        wanted = day.isin(*[d for d in days if d is not None]) if any(d is not None for d in days) else F.lit(False)
        scored = scored.where(wanted | day.isNull() if None in days else wanted)
    state = day_state(scored, day_col, **params)
    if days is not None:  # markers, so that a day that lost all its rows is replaced as well
        schema = T.StructType([T.StructField("day", T.DateType())])
        state = state.unionByName(spark.createDataFrame([(d,) for d in days], schema).select("day", F.lit(0).cast("long").alias("n")), allowMissingColumns=True)
    # one file for each day
    state.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_state(spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """The state's rows, of days from ``since`` up to and including ``until``; other partitions are not listed for reading."""
    state = spark.read.parquet(path)
    if since is not None:
        state = state.where(F.col("day") >= F.lit(since))
    if until is not None:
        state = state.where(F.col("day") <= F.lit(until))
    return state.where("band_id IS NOT NULL")  # markers hold nothing


def _merged(state: DataFrame, *keys: str) -> DataFrame:
    """Moments by ``keys`` (bands: a few rows, so their means may be broadcast back to the state's rows)."""
    scored = F.sum("n_scored")
    means = state.groupBy(*keys).agg((F.sum(F.col("_mean") * F.col("n_scored")) / F.when(scored > 0, scored)).alias("_all_mean"))
    rows = state.select(*keys, *_MOMENTS).join(F.broadcast(means), list(keys))
    apart = F.coalesce("_m2", F.lit(0.0)) + F.coalesce(F.col("n_scored") * F.pow(F.col("_mean") - F.col("_all_mean"), 2), F.lit(0.0))
    parts = rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_scored").alias("n_scored"), F.sum("_sse").alias("_sse"), F.sum("_sae").alias("_sae"),
        F.sum(apart).alias("_m2"), F.min("_lmin").alias("_lmin"), F.max("_lmax").alias("_lmax"),
    )
    return parts.withColumn("_var", F.try_divide(F.col("_m2"), F.col("n_scored")))


def range_report_from(state: DataFrame, bands: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """``evaluate.range_report`` of all rows that the state has seen."""
    per_band = _merged(state, "band_id")  # at most bands + 1 rows
    table = bands_frame(state.sparkSession, SALES_BANDS if bands is None else list(bands), with_outside=True)
    out = table.select("band_id", "Range", "lower", "upper").join(F.broadcast(per_band), "band_id", "left")
    out = out.select(
        "band_id", "Range", "lower", "upper", *[c.alias(k) for k, c in _metrics_from_parts().items()],
        F.coalesce(F.col("n"), F.lit(0)).alias("count"), F.coalesce(F.col("n_scored"), F.lit(0)).alias("n_scored"),
    )
    # the un-partitioned window sees bands + 1 rows
    return out.withColumn("all", F.sum("count").over(Window.partitionBy())).where(F.col("band_id") != OUTSIDE)


def over_under_report_from(state: DataFrame, pred: str = "pred_final", value_cols: Sequence[str] = AVERAGED, bands: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """``evaluate.over_under_report`` of all rows that the state has seen."""
    names = {**{c: c for c in value_cols}, "pred": pred, "diff": "prediction_diff"}
    sums = [F.try_divide(F.sum(f"s_{k}"), F.sum(f"c_{k}")).alias(f"avg({c})") for k, c in names.items()]
    per_type = state.where(F.col("band_id") != OUTSIDE).groupBy("band_id", "prediction_type").agg(*sums, F.sum("n").alias("count_of_each_part"))
    table = bands_frame(state.sparkSession, SALES_BANDS if bands is None else list(bands)).select("band_id", F.col("bounds").alias("Range"))
    return table.join(F.broadcast(per_type), "band_id").select(
        "band_id", "Range", "prediction_type", *[f"avg({c})" for c in names.values()], "count_of_each_part"
    )
