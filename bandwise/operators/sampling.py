"""Repeatable stratified train/test split.

The original module draws a Bernoulli sample per label (``sampleBy``) and takes the
rest with an anti join. ``sampleBy`` depends on how rows are partitioned, and
the anti join shuffles both sides. The default here decides each row from a
hash of its key columns and the seed: the same rows are chosen under any
partitioning (and by the DuckDB oracle), and both halves are narrow filters
of the input, no shuffle at all.

With one fraction for every label the decision depends only on the key, so
the complement equals the anti join exactly: a key is in the sample iff all
its rows are. Rows with a NULL key never match in an anti join, so they are
also kept in the rest, as there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.session import written

_HEX_DIGITS = 8


def threshold_hex(frac: float) -> str:
    """Fixed-width lowercase hex bound: hash prefix < bound <=> uniform draw < frac."""
    frac = min(max(float(frac), 0.0), 1.0)
    if frac >= 1.0:
        return "g" * _HEX_DIGITS  # above every hex string: all rows
    top = 16**_HEX_DIGITS
    # a fraction just below 1 must not round up to a 9-digit bound
    return format(min(int(round(frac * top)), top - 1), f"0{_HEX_DIGITS}x")


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """First 8 hex digits of md5('k1|k2|...|seed')."""
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, _HEX_DIGITS)


def _bound(frac: float | Mapping, label: str | None) -> Column:
    if isinstance(frac, Mapping):
        expr = F.when(F.lit(False), F.lit(None).cast("string"))
        for value, f in frac.items():
            expr = expr.when(F.col(label) == F.lit(value), F.lit(threshold_hex(f)))
        return expr.otherwise(F.lit(threshold_hex(0.0)))
    return F.lit(threshold_hex(frac))


def stratified_split(
    df: DataFrame,
    frac: float | Mapping,
    label: str,
    join_on: Sequence[str] | str,
    seed: int = 42,
    exact: bool = False,
    method: str = "hash",
) -> tuple[DataFrame, DataFrame]:
    """(sample, rest). ``frac`` is one fraction or a {label value: fraction} map.

    ``exact=True`` takes exactly ceil(frac * n) rows of every label instead of deciding each key by itself.
    ``method="sampleBy"`` draws rows, not keys, with Spark's own stratified sampler (``sample_by``).
    """
    if method not in ("hash", "sampleBy"):
        raise ValueError(f"method: {method}")
    if method == "sampleBy":
        return sample_by(df, frac, label, seed)
    keys = [join_on] if isinstance(join_on, str) else list(join_on)
    if exact:
        return exact_split(df, frac, label, keys, seed)
    chosen = key_hash(keys, seed) < _bound(frac, label)
    sample = df.filter(chosen)
    if isinstance(frac, Mapping):
        # per-label fractions: a key's rows may split, so take the literal anti join
        return sample, df.join(sample.select(*keys), keys, "left_anti")
    any_null_key = F.lit(False)
    for k in keys:
        any_null_key = any_null_key | F.col(k).isNull()
    return sample, df.filter(~chosen | any_null_key)


def sample_by(df: DataFrame, frac: float | Mapping, label: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(sample, rest) by ``df.stat.sampleBy``: every row is drawn by itself with its label's fraction.

    The sampler's draws depend on partitions and row order. So the rows are written once, numbered, and so are the
    numbers drawn: both halves read the same draw however often their tasks run, and share no row. Labels without a fraction, and NULL
    labels, are in the rest.
    """
    rows = written(df.withColumn("__row", F.monotonically_increasing_id()), "sample_by")
    fractions = frac if isinstance(frac, Mapping) else {r[0]: frac for r in rows.select(label).where(F.col(label).isNotNull()).distinct().collect()}
    drawn = written(rows.stat.sampleBy(label, dict(fractions), seed).select("__row"), "drawn")
    return rows.join(drawn, "__row", "left_semi").select(*df.columns), rows.join(drawn, "__row", "left_anti").select(*df.columns)


_BUCKET_DIGITS = 3  # 4096 hash buckets for each label


def exact_split(df: DataFrame, frac: float | Mapping, label: str, keys: Sequence[str], seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(sample, rest) with exactly ceil(frac * n) rows of every label, those with the smallest key hashes.

    Rows are counted by label and hash bucket (a third of all rows on one label is 4096 small counts). Buckets
    below a label's cut are taken whole; only the rows of its one boundary bucket are ranked.
    """
    names = list(df.columns)
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    rows = df.withColumn("_h", digest).withColumn("_b", F.substring("_h", 1, _BUCKET_DIGITS))
    share = _share(frac, label)
    running = Window.partitionBy("_label").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy(F.col(label).alias("_label"), F.col("_b").alias("_cut")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumnRenamed("_cut", "_b").withColumn("_upto", F.sum("_n").over(running))
    counts = counts.withColumn("_want", F.ceil(F.sum("_n").over(Window.partitionBy("_label")) * share).cast("long"))
    edge = counts.where("_want > 0 AND _upto >= _want AND _upto - _n < _want")
    cuts = edge.select("_label", F.col("_b").alias("_cut"), (F.col("_want") - (F.col("_upto") - F.col("_n"))).alias("_take"))
    cut = rows.join(cuts, rows[label].eqNullSafe(F.col("_label")), "left").drop("_label")
    order = Window.partitionBy(label).orderBy("_h", *keys, F.xxhash64(*names))
    inside = cut.where("_b = _cut").withColumn("_place", F.row_number().over(order))
    sample = cut.where("_b < _cut").select(*names).unionByName(inside.where("_place <= _take").select(*names))
    rest = cut.where("_cut IS NULL OR _b > _cut").select(*names).unionByName(inside.where("_place > _take").select(*names))
    return sample, rest


def _share(frac: float | Mapping, label: str) -> Column:
    if not isinstance(frac, Mapping):
        return F.lit(float(frac))
    expr = F.when(F.lit(False), F.lit(0.0))
    for value, f in frac.items():
        expr = expr.when(F.col("_label") == F.lit(value), F.lit(float(f)))
    return expr.otherwise(F.lit(0.0))


def distinct_labels(df: DataFrame, label: str, frac: float) -> DataFrame:
    """The label domain with its sampling fraction (what the original module builds its map from)."""
    return df.select(label).distinct().withColumn("fraction", F.lit(float(frac)))
