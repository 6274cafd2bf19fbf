"""Categorical encoders in one call: fit a label dictionary on the frame and encode the same frame.

To encode other rows with the same indexes later, keep the fitted model: ``fit_one_hot`` returns it, and
``operators.labels`` can save, load and extend it. No label domain goes to the driver; vectors are sparse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.operators.labels import LabelEncoder, LabelEncoderModel


def string_index(df: DataFrame, input_col: str = "Tier", output_col: str = "tier_vec", handle_invalid: str = "error") -> DataFrame:
    """Scalar label index of ``input_col``. NULL is an error, dropped (``skip``) or the last index (``keep``)."""
    return LabelEncoder(inputCols=[input_col], outputCols=[output_col], handleInvalid=handle_invalid).fit(df).transform(df)


def string_index_multi(df: DataFrame, columns: Sequence[str], suffix: str = "_NUMERIC", handle_invalid: str = "error") -> DataFrame:
    """``<c>_NUMERIC`` for every column; the labels of all are counted in one pass."""
    return LabelEncoder(inputCols=list(columns), outputCols=[c + suffix for c in columns], handleInvalid=handle_invalid).fit(df).transform(df)


def one_hot(df: DataFrame, input_col: str, prefix: str | None = None, handle_invalid: str = "error") -> DataFrame:
    """Add ``<prefix>_idx`` and a sparse one-hot ``<prefix>_vec`` for ``input_col``."""
    return one_hot_many(df, [input_col], handle_invalid, {input_col: prefix or input_col})


def one_hot_many(df: DataFrame, columns: Sequence[str], handle_invalid: str = "error", prefixes: dict[str, str] | None = None) -> DataFrame:
    """``<c>_idx`` and ``<c>_vec`` for several columns."""
    return fit_one_hot(df, columns, handle_invalid, prefixes).transform(df)


def fit_one_hot(df: DataFrame, columns: Sequence[str], handle_invalid: str = "error", prefixes: dict[str, str] | None = None) -> LabelEncoderModel:
    """The fitted encoder of ``one_hot_many``, for other rows."""
    names = [(prefixes or {}).get(c, c) for c in columns]
    encoder = LabelEncoder(
        inputCols=list(columns), outputCols=[f"{p}_idx" for p in names], vectorCols=[f"{p}_vec" for p in names], handleInvalid=handle_invalid
    )
    return encoder.fit(df)


def one_hot_size(vec: Column) -> Column:
    """Length of a sparse vector, read from its fields (no dense copy)."""
    return F.unwrap_udt(vec)["size"]


def one_hot_active(vec: Column) -> Column:
    """Index of the set position of a one-hot vector (-1 if none)."""
    return F.coalesce(F.get(F.unwrap_udt(vec)["indices"], F.lit(0)), F.lit(-1)).cast("int")
