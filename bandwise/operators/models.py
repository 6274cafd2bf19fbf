"""Two-stage ("does it sell" x "how many") scoring, training and persistence.

The original module scores the classifier and the regressor separately and joins
the two outputs back on (SalDate, BranchCode, MaterialCode): a shuffle of
both copies, and sum(n^2) rows when a key repeats. Chaining the two
transforms is a narrow plan: one pass, no shuffle, one row per input row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.session import checkpointed


def two_stage_score(
    df: DataFrame,
    classifier: Transformer,
    regressor: Transformer,
    lv1: str = "pred_lv1",
    lv2: str = "pred_lv2",
    out: str = "pred_final",
) -> DataFrame:
    """``out = lv1 * lv2`` where ``lv1`` comes from ``classifier`` and ``lv2`` from ``regressor``.

    After each stage only the input columns and the prediction are kept, so
    helper columns of the two models (features, rawPrediction, ...) never
    collide.
    """
    cols = list(df.columns)
    s1 = classifier.transform(df).select(*cols, lv1)
    s2 = regressor.transform(s1).select(*cols, lv1, lv2)
    return s2.withColumn(out, F.col(lv1) * F.col(lv2))


def score(df: DataFrame, model: Transformer, pred: str = "predict_qty") -> DataFrame:
    """Single-model scoring: input columns plus ``pred``."""
    return model.transform(df).select(*df.columns, pred)


_CLASSIFIERS = {"gbt": GBTClassifier, "rf": RandomForestClassifier, "dt": DecisionTreeClassifier}
_REGRESSORS = {"rf": RandomForestRegressor, "gbt": GBTRegressor, "dt": DecisionTreeRegressor}


def fit_bins(df: DataFrame, features: Sequence[str], max_bins: int = 32, prefix: str = "bin_", handle_invalid: str = "keep") -> Bucketizer:
    """Bins as MLlib's trees make them: one per value of a feature with at most ``max_bins`` values, else ``max_bins`` with about equally many rows.

    The quantiles are taken over all rows (to a thousandth of them), where MLlib takes them over a sample. NULL, NaN and infinite values
    place no border.
    """
    probs = [i / max_bins for i in range(1, max_bins)]
    value = {c: F.col(c).cast("double") for c in features}
    value = {c: F.when(F.abs(x) < float("inf"), x) for c, x in value.items()}
    found = df.agg(
        *[
            F.struct(F.approx_count_distinct(x).alias("n"), F.min(x).alias("low"), F.percentile_approx(x, probs, 1000).alias("at")).alias(f"_{i}")
            for i, x in enumerate(value.values())
        ]
    ).first()
    splits = []
    for (c, x), f in zip(value.items(), found, strict=True):
        borders = f["at"] or []
        if 0 < f["n"] <= 2 * max_bins:  # an estimate, but close for so few values
            own = sorted(r[0] for r in df.select(x.alias(c)).where(F.col(c).isNotNull()).distinct().limit(max_bins + 1).collect())
            if len(own) <= max_bins:  # as MLlib: a value up to the middle goes left
                borders = [math.nextafter(a / 2 + b / 2, math.inf) for a, b in zip(own, own[1:])]
        # a bin starts at its border, so the smallest value is none
        borders = sorted({b for b in borders if b > f["low"]}) or [f["low"] or 0.0]
        splits.append([-float("inf"), *borders, float("inf")])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[f"{prefix}{c}" for c in features], handleInvalid=handle_invalid)


def _mergeable(est: Estimator) -> bool:
    """True if rows of equal bins and label count as one row with their number as weight: the fit draws and counts no single rows."""
    draws = est.hasParam("subsamplingRate") and (est.getOrDefault("subsamplingRate") < 1 or isinstance(est, (RandomForestClassifier, RandomForestRegressor)))
    own = any(est.hasParam(p) and est.isSet(p) for p in ("weightCol", "validationIndicatorCol"))
    return not draws and not own and est.getOrDefault("minInstancesPerNode") == 1


def _fit_trees(rows: DataFrame, features: Sequence[str], est: Estimator, handle_invalid: str) -> PipelineModel:
    """Assemble ``features`` and fit the tree learner ``est`` on all rows.

    Trees only see a feature's bin. So a learner that reads the rows once per tree and level gets one row per combination of bins and label,
    weighted by the rows it stands for: same sums, same splits, and bins ** features * labels rows at most, however large the input.
    """
    vector = est.getFeaturesCol()
    if not _mergeable(est):
        return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=vector, handleInvalid=handle_invalid), est]).fit(rows)
    bins = fit_bins(rows, features, est.getMaxBins(), f"_{vector}_", handle_invalid)
    assembler = VectorAssembler(inputCols=bins.getOutputCols(), outputCol=vector, handleInvalid=handle_invalid)
    # bins are marked as nominal, where MLlib would take them as categories without order: drop the mark
    keys = [F.col(c).alias(c, metadata={}) for c in bins.getOutputCols()]
    cells = checkpointed(bins.transform(rows).groupBy(*keys, est.getLabelCol()).agg(F.count(F.lit(1)).cast("double").alias("_n_rows")))
    # MLlib looks for split candidates in maxBins ** 2 rows or more: in all cells, so that no bin is missed
    params = {est.maxBins: max(est.getMaxBins(), math.isqrt(cells.count()) + 1), est.weightCol: "_n_rows"}
    model = est.copy(params).fit(assembler.transform(cells))
    return PipelineModel(stages=[bins, assembler, model])


def train_two_stage(
    train: DataFrame,
    features: Sequence[str],
    label: str = "TotalQtySale",
    classifier: str = "gbt",
    regressor: str = "rf",
    lv1: str = "pred_lv1",
    lv2: str = "pred_lv2",
    seed: int = 42,
    classifier_params: dict | None = None,
    regressor_params: dict | None = None,
    handle_invalid: str = "keep",
) -> tuple[PipelineModel, PipelineModel]:
    """Fit the classifier on ``label > 0`` (all rows) and the regressor on ``label`` (rows that sold).

    Label and features are written once to the shared folder: both fits scan that table many times (boosted and single trees scan its
    merged bins instead, see ``_fit_trees``).
    ``handle_invalid`` says what NULL features do: ``keep`` (NaN), ``skip`` (drop the row) or ``error``.
    """
    sells = "_sells"
    clf = _CLASSIFIERS[classifier](
        featuresCol="features_lv1", labelCol=sells, predictionCol=lv1, seed=seed, **(classifier_params or {})
    )
    reg = _REGRESSORS[regressor](
        featuresCol="features_lv2", labelCol=label, predictionCol=lv2, seed=seed, **(regressor_params or {})
    )
    base = checkpointed(train.select(*features, F.col(label).cast("double").alias(label), (F.col(label) > 0).cast("double").alias(sells)))
    m1 = _fit_trees(base, features, clf, handle_invalid)
    m2 = _fit_trees(base.filter(F.col(label) > 0), features, reg, handle_invalid)
    return m1, m2


def save_two_stage(models: tuple[PipelineModel, PipelineModel], path: str) -> None:
    models[0].write().overwrite().save(f"{path}/lv1")
    models[1].write().overwrite().save(f"{path}/lv2")


def load_two_stage(path: str) -> tuple[PipelineModel, PipelineModel]:
    return PipelineModel.load(f"{path}/lv1"), PipelineModel.load(f"{path}/lv2")
