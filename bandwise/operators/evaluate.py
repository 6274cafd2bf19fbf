"""Forecast-error reports.

The original module loops over the sales bands and runs several Spark jobs per band
(filter, count, one evaluator job per metric). Here every report is one
grouped aggregate keyed by the band id: rows are bucketed by a CASE
expression, partially aggregated on the map side (at most one row per band
and partition leaves each task), and the band table (one row per band) is
joined to the tiny result. A band holding most of the rows is therefore no
hot spot: the shuffle carries per-band partial sums, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.functions.scoring import SALES_BANDS, band_of, bands_frame, classify_error
from bandwise.session import checkpointed

_L, _P = "_label", "_pred"


def _metric_parts() -> list[Column]:
    """Mergeable sums behind rmse / mse / r2 / mae.

    A pair counts only when label and prediction are both present; ``n`` counts
    every row.
    """
    err = F.col(_P) - F.col(_L)
    scored_label = F.when(err.isNotNull(), F.col(_L))
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(err).alias("n_scored"),
        F.sum(err * err).alias("_sse"),
        F.sum(F.abs(err)).alias("_sae"),
        F.var_pop(scored_label).alias("_var"),
        # constant labels are detected exactly: merged variance buffers can leave 1e-35 instead of 0
        F.min(scored_label).alias("_lmin"),
        F.max(scored_label).alias("_lmax"),
    ]


def _metrics_from_parts() -> dict[str, Column]:
    n = F.col("n_scored")
    mse = F.try_divide(F.col("_sse"), n)
    sst = F.col("_var") * n
    return {
        "mae": F.try_divide(F.col("_sae"), n),
        "rmse": F.sqrt(mse),
        "mse": mse,
        # NULL, not -Infinity/NaN, when the labels in the band are constant
        "r2": F.when(F.col("_lmin") < F.col("_lmax"), F.lit(1.0) - F.try_divide(F.col("_sse"), sst)),
    }


def _pairs(df: DataFrame, label: str, pred: str, extra: Sequence[Column] = ()) -> DataFrame:
    return df.select(*extra, F.col(label).cast("double").alias(_L), F.col(pred).cast("double").alias(_P))


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "predict_qty") -> DataFrame:
    """One row: mae, rmse, mse, r2, count, n_scored (what RegressionEvaluator reports, in one job)."""
    parts = _pairs(df, label, pred).agg(*_metric_parts())
    return parts.select(
        *[c.alias(k) for k, c in _metrics_from_parts().items()],
        F.col("n").alias("count"),
        "n_scored",
    )


def range_metrics(
    scored: DataFrame,
    label: str = "label",
    pred: str = "predict_qty",
    bands: Sequence[tuple[int, int]] | None = None,
    with_total: bool = False,
) -> DataFrame:
    """Error metrics per sales band, every band present (empty -> count 0, NULL metrics).

    Columns: band_id, Range, lower, upper, mae, rmse, mse, r2, count, n_scored
    and, with ``with_total``, ``all`` = every input row, in a band or not.
    """
    bands = SALES_BANDS if bands is None else list(bands)
    band = F.coalesce(band_of(F.col(label), bands), F.lit(0)) if with_total else band_of(F.col(label), bands)
    # at most len(bands) + 1 rows: proven small, so it is the broadcast side
    per_band = _pairs(scored, label, pred, [band.alias("band_id")]).groupBy("band_id").agg(*_metric_parts())
    table = bands_frame(scored.sparkSession, bands, with_outside=with_total).select("band_id", "Range", "lower", "upper")
    out = table.join(F.broadcast(per_band), "band_id", "left").select(
        "band_id",
        "Range",
        "lower",
        "upper",
        *[c.alias(k) for k, c in _metrics_from_parts().items()],
        F.coalesce(F.col("n"), F.lit(0)).alias("count"),
        F.coalesce(F.col("n_scored"), F.lit(0)).alias("n_scored"),
    )
    if with_total:
        # `all` counts every row, band 0 (outside every band) included; the un-partitioned window
        # sees one row per band (len(bands) + 1 rows), never data rows
        out = out.withColumn("all", F.sum("count").over(Window.partitionBy())).filter(F.col("band_id") > 0)
    return out


def range_report(
    scored: DataFrame,
    label: str = "TotalQtySale",
    pred: str = "pred_final",
    bands: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """Report 1: per-band mae, rmse, mse, r2, count and the overall row count ``all``."""
    return range_metrics(scored, label, pred, bands, with_total=True)


def over_under_report(
    classified: DataFrame,
    label: str = "label",
    pred: str = "predict_qty",
    value_cols: Sequence[str] = ("avgPriceDis", "avgPrice", "supPrice"),
    bands: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """Report 2: per band and prediction_type ('Lower'/'Upper'), averages and row count.

    ``classified`` must carry ``prediction_type`` and ``prediction_diff``
    (see ``classify_error``); it is added when missing. Only non-empty
    (band, type) groups appear, as in the original module.
    """
    bands = SALES_BANDS if bands is None else list(bands)
    if "prediction_type" not in classified.columns:
        classified = classify_error(classified, label, pred)
    lo, hi = min(b[0] for b in bands), max(b[1] for b in bands)
    averaged = [*value_cols, pred, "prediction_diff"]
    per_group = (
        classified.filter(F.col(label).between(lo, hi))  # pushable bound on the label
        .select(band_of(F.col(label), bands).alias("band_id"), "prediction_type", *averaged)
        .filter(F.col("band_id").isNotNull())
        .groupBy("band_id", "prediction_type")
        .agg(*[F.avg(c).alias(f"avg({c})") for c in averaged], F.count(F.lit(1)).alias("count_of_each_part"))
    )
    table = bands_frame(classified.sparkSession, bands).select("band_id", F.col("bounds").alias("Range"))
    return table.join(F.broadcast(per_group), "band_id").select(
        "band_id", "Range", "prediction_type", *[f"avg({c})" for c in averaged], "count_of_each_part"
    )


def union_reports(*reports: DataFrame) -> DataFrame:
    """Stack report frames (UNION ALL by column name)."""
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def band_reports(
    scored: DataFrame,
    label: str = "TotalQtySale",
    pred: str = "predict_qty",
    value_cols: Sequence[str] = ("avgPriceDis", "avgPrice", "supPrice"),
    bands: Sequence[tuple[int, int]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Report 1 and report 2 from **one** pass: ``(range_report, over_under_report)``.

    ``rollup(band_id, prediction_type)`` yields the (band, type) rows of
    report 2, the band rows of report 1 and the grand total for ``all`` in a
    single aggregate (at most 3 x (bands + 1) rows). It is checkpointed once to
    the shared folder, and both reports are projections of it.
    """
    bands = SALES_BANDS if bands is None else list(bands)
    classified = scored if "prediction_type" in scored.columns else classify_error(scored, label, pred)
    averaged = [*value_cols, pred, "prediction_diff"]
    base = classified.select(
        F.coalesce(band_of(F.col(label), bands), F.lit(0)).alias("band_id"),
        "prediction_type",
        F.col(label).cast("double").alias(_L),
        F.col(pred).cast("double").alias(_P),
        *averaged,
    )
    agg = checkpointed(  # tiny; both reports read it
        base.rollup("band_id", "prediction_type").agg(
            F.grouping_id().alias("_level"),
            *_metric_parts(),
            *[F.avg(c).alias(f"avg({c})") for c in averaged],
        )
    )
    spark = scored.sparkSession
    # windows below run over the checkpointed rollup (at most 3 x (bands + 1) rows), never data rows
    total = F.max(F.when(F.col("_level") == 3, F.col("n"))).over(Window.partitionBy())
    per_band = agg.withColumn("all", total).filter((F.col("_level") == 1) & (F.col("band_id") > 0))
    table = bands_frame(spark, bands).select("band_id", "Range", "lower", "upper")
    report1 = (
        table.join(F.broadcast(per_band), "band_id", "left")
        .select(
            "band_id",
            "Range",
            "lower",
            "upper",
            *[c.alias(k) for k, c in _metrics_from_parts().items()],
            F.coalesce(F.col("n"), F.lit(0)).alias("count"),
            F.coalesce(F.col("n_scored"), F.lit(0)).alias("n_scored"),
            "all",
        )
        .withColumn("all", F.max("all").over(Window.partitionBy()))
    )
    per_type = agg.filter((F.col("_level") == 0) & (F.col("band_id") > 0))
    keys = bands_frame(spark, bands).select("band_id", F.col("bounds").alias("Range"))
    report2 = keys.join(F.broadcast(per_type), "band_id").select(
        "band_id",
        "Range",
        "prediction_type",
        *[f"avg({c})" for c in averaged],
        F.col("n").alias("count_of_each_part"),
    )
    return report1, report2
