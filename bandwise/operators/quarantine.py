"""Cleaning with two outputs: the rows that pass, typed, and the rows that do not, with what is wrong in them.

``clean`` drops incomplete rows and lets text that is no number become NULL; both vanish without a trace. Here
every row is judged once, in one scan: ``split`` writes it to the shared folder as kept or as
rejected (a partition each), so both outputs are read from the store and never judge again. Every input row is in exactly
one of them.

Reasons, per cell (``problems`` of a rejected row, in column order):

* ``missing``: NULL, or NaN in a float column;
* ``not a number`` / ``not a date`` / ``not a boolean``: text that the profile's type cannot read;
* ``out of range``: a number that does not fit the profile's integer type;
* ``fraction``: only with ``fractions="reject"``; otherwise '3.7' is 3 in an int column, as in ``clean``;
* ``corrupt record``: the reader could not split the line into the schema's columns (no column; raw is the line).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwise.functions.calendar import _INTEGRAL, cast_to
from bandwise.operators.clean import CAST_PROFILES, cast_columns
from bandwise.session import fresh_path

CORRUPT = "_corrupt_record"
PROBLEMS = "array<struct<column:string,raw:string,reason:string>>"


def read_permissive(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "csv", corrupt_col: str = CORRUPT, **options) -> DataFrame:
    """All ``columns`` as text, and the raw line in ``corrupt_col`` where a line does not fit them."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, corrupt_col]])
    reader = spark.read.format(fmt).schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return reader.options(**{"header": "true", **options} if fmt == "csv" else options).load(path)


def _problem(column: str | None, raw: Column, reason: Column) -> Column:
    return F.when(reason.isNotNull(), F.struct(F.lit(column).cast("string").alias("column"), raw.cast("string").alias("raw"), reason.alias("reason")))


def _cell_reason(df: DataFrame, column: str, to: str | None, required: bool, fractions: str) -> Column:
    """Why the cell cannot be kept; NULL if it can."""
    c, source = F.col(f"`{column}`"), df.schema[column].dataType
    missing = c.isNull() | F.isnan(c) if isinstance(source, (T.DoubleType, T.FloatType)) else c.isNull()
    reason = F.when(missing, F.lit("missing") if required else F.lit(None).cast("string"))
    if to is None:
        return reason
    target = T._parse_datatype_string("int" if to == "integer" else to)
    if target == source:
        return reason
    if isinstance(target, T.NumericType):
        number = c.try_cast("double")
        reason = reason.when(number.isNull() | F.isnan(number), F.lit("not a number"))
        if to in _INTEGRAL:
            reason = reason.when(number.try_cast(to).isNull(), F.lit("out of range"))
            if fractions == "reject":
                reason = reason.when(number != F.floor(number), F.lit("fraction"))
        return reason
    return reason.when(c.try_cast(to).isNull(), F.lit(f"not a {to}"))


def problems(
    df: DataFrame,
    profile: dict[str, str],
    required: Sequence[str] | None = None,
    corrupt_col: str | None = None,
    fractions: str = "truncate",
) -> Column:
    """Array of (column, raw, reason) of a row; empty if it can be kept. ``required`` defaults to all columns."""
    if fractions not in ("truncate", "reject"):
        raise ValueError(f"fractions: {fractions}")
    names = [c for c in df.columns if c != corrupt_col]
    must = set(names if required is None else required)
    if missing := sorted((must | set(profile)) - set(names)):
        raise ValueError(f"columns missing: {', '.join(missing)}")
    cells = [_problem(c, F.col(f"`{c}`"), _cell_reason(df, c, profile.get(c), c in must, fractions)) for c in names]
    found = F.filter(F.array(*cells), lambda p: p.isNotNull()) if cells else F.array().cast(PROBLEMS)
    if corrupt_col is None:
        return found
    line = F.col(f"`{corrupt_col}`")
    return F.when(line.isNotNull(), F.array(_problem(None, line, F.lit("corrupt record")))).otherwise(found)


def split(
    df: DataFrame,
    profile: str | dict[str, str] = "full",
    required: Sequence[str] | None = None,
    corrupt_col: str | None = None,
    fractions: str = "truncate",
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected), both read from one write at ``path`` (default: a new folder in the shared one).

    ``kept`` has the columns of ``df`` (without ``corrupt_col``), cast by the profile; ``rejected`` has ``record`` (the
    columns as they came, a struct) and ``problems``.
    """
    prof = CAST_PROFILES[profile] if isinstance(profile, str) else profile
    corrupt_col = corrupt_col or (CORRUPT if CORRUPT in df.columns else None)
    names = [c for c in df.columns if c != corrupt_col]
    raw = F.struct(*[F.col(f"`{c}`") for c in names])
    judged = df.select("*", problems(df, prof, required, corrupt_col, fractions).alias("__problems"))
    ok = F.size("__problems") == 0
    cast = F.struct(*[(cast_to(df, c, prof[c]) if c in prof else F.col(f"`{c}`")).alias(c) for c in names])
    rows = judged.select(F.when(ok, cast).alias("kept"), F.when(~ok, raw).alias("record"), F.col("__problems").alias("problems"), ok.alias("ok"))
    path = path or fresh_path(df.sparkSession, "quarantine")
    rows.write.partitionBy("ok").parquet(path)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    return stored.where("ok").select("kept.*"), stored.where("NOT ok").select("record", "problems")


def rejected_cells(rejected: DataFrame) -> DataFrame:
    """One row for each problem: column, raw, reason and the record it is in."""
    return rejected.select(F.explode("problems").alias("p"), "record").select("p.column", "p.raw", "p.reason", "record")


def reject_summary(rejected: DataFrame) -> DataFrame:
    """Rows and cells by (column, reason)."""
    return rejected_cells(rejected).groupBy("column", "reason").agg(F.count(F.lit(1)).alias("cells"), F.approx_count_distinct("raw").alias("texts"))


def readmit(rejected: DataFrame, repairs: dict[str, Column], profile: str | dict[str, str] = "full", **judging) -> tuple[DataFrame, DataFrame]:
    """Judge rejected records again after ``repairs`` (column -> expression over the record's columns).

    Records that the reader could not split have no trustworthy columns: they stay rejected.
    """
    torn = F.exists("problems", lambda p: p["reason"] == "corrupt record")
    again, still = split(rejected.where(~torn).select("record.*").withColumns(repairs), profile, **judging)
    return again, still.unionByName(rejected.where(torn))


def clean_kept(df: DataFrame, profile: str | dict[str, str] = "full", required: Sequence[str] | None = None, fractions: str = "truncate") -> DataFrame:
    """The kept side alone, lazily (no write): for streams and for callers who need no reasons."""
    prof = CAST_PROFILES[profile] if isinstance(profile, str) else profile
    return cast_columns(df.where(F.size(problems(df, prof, required, None, fractions)) == 0), prof)
