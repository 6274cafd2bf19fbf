"""A fitted, versioned label dictionary: the same label has the same index wherever rows are encoded.

``LabelEncoder`` (an MLlib Estimator) counts the labels of all its columns in one shuffle: rows are exploded to
(column, label), counted map-side, range-sorted once by (column, count descending, label) and numbered with
per-partition offsets. The order is StringIndexer's. ``LabelEncoderModel`` holds the dictionary as a
distributed table (column, label, idx, version), so a label domain that grows with the data is fine.

``extended`` gives the labels that a newer frame adds the next free indexes and the next version; an index
that was given stays. ``at_version`` is the dictionary as it was. A saved model stores its versions as partitions;
saving an extended model over its own folder with ``append_to`` writes only the new ones.

NULL and labels that are not in the dictionary are invalid: ``handleInvalid`` is ``error``, ``skip`` (the row is
dropped) or ``keep`` (one further index, behind all labels of the version).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.session import written

POLICIES = ("error", "skip", "keep")
LABELS = "`column` string, label string, idx double, version int"
_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id: partition number above, row number in the lower 33 bits


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, n) of all columns' labels as text; NULLs are no labels."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in columns])
    return df.select(F.explode(cells).alias("_c")).select("_c.*").where("label IS NOT NULL").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))


def numbered(counts: DataFrame, start: dict[str, int], version: int) -> tuple[DataFrame, dict[str, int]]:
    """The labels of ``label_counts`` with indexes from ``start`` (0 where a column has none) on, and the columns' sizes then.

    One range sort; only the number of rows of each (partition, column) comes to the driver.
    """
    place = F.monotonically_increasing_id()
    ranged = counts.orderBy("column", F.desc("n"), "label")
    ranged = ranged.select("column", "label", F.shiftright(place, 33).alias("_p"), place.bitwiseAND(F.lit(_IN_PARTITION)).alias("_i"))
    ranged = written(ranged, "labels")  # a stored table has a size: the planner broadcasts a small dictionary at once
    sizes = sorted((r["_p"], r["column"], r["n"]) for r in ranged.groupBy("_p", "column").agg(F.count(F.lit(1)).alias("n")).collect())
    before, columns, total, now = {}, {}, 0, dict(start)
    for p, column, n in sizes:
        before.setdefault(p, total)
        columns.setdefault(column, total)  # where the column begins among all rows
        now[column] = now.get(column, 0) + n
        total += n
    if not sizes:
        return ranged.select("column", "label", F.lit(0.0).alias("idx"), F.lit(version).alias("version")), now
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("_p"))
    first = F.element_at(F.create_map(*[F.lit(x) for c, n in columns.items() for x in (c, n - start.get(c, 0))]), F.col("column"))
    idx = (F.col("_i") + offset - first).cast("double")
    return ranged.select("column", "label", idx.alias("idx"), F.lit(version).alias("version")), now


class _EncoderParams(HasInputCols, HasOutputCols, HasHandleInvalid):
    vectorCols = Param(Params._dummy(), "vectorCols", "names of one-hot vector columns, one for each input; empty: none", TypeConverters.toListString)

    def _set_encoder(self, inputCols, outputCols, vectorCols, handleInvalid):
        self._setDefault(handleInvalid="error", vectorCols=[])
        given = {"inputCols": inputCols, "outputCols": outputCols, "vectorCols": vectorCols, "handleInvalid": handleInvalid}
        self._set(**{k: v for k, v in given.items() if v is not None})

    def _checked(self) -> list[str]:
        columns, policy = self.getInputCols(), self.getHandleInvalid()
        if policy not in POLICIES:
            raise ValueError(f"handleInvalid: {policy}")
        if len(set(columns)) < len(columns) or any(len(x) != len(columns) for x in (self.getOutputCols(), self.getVectorCols() or columns)):
            raise ValueError("inputCols must be distinct, with one output (and vector) column each")
        return columns

    def getVectorCols(self) -> list[str]:
        return self.getOrDefault("vectorCols")


class LabelEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a ``LabelEncoderModel`` on the labels of ``inputCols``."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, vectorCols=None, handleInvalid=None):
        super().__init__()
        self._set_encoder(inputCols, outputCols, vectorCols, handleInvalid)

    def _fit(self, dataset: DataFrame) -> LabelEncoderModel:
        labels, sizes = numbered(label_counts(dataset, self._checked()), {}, 1)
        return self._copyValues(LabelEncoderModel(labels, (sizes, 1)))


class LabelEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    def __init__(self, labels: DataFrame | None = None, known: tuple[dict[str, int], int] | None = None):
        super().__init__()
        self._set_encoder(None, None, None, None)
        self.labels = labels
        self._known = known  # labels of each column, and the version; counted when first needed

    def _size_and_version(self) -> tuple[dict[str, int], int]:
        if self._known is None:  # one row for each column
            rows = self.labels.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.max("version").alias("v")).collect()
            self._known = {r["column"]: r["n"] for r in rows}, max((r["v"] for r in rows), default=1)
        return self._known

    @property
    def version(self) -> int:
        return self._size_and_version()[1]

    @property
    def sizes(self) -> dict[str, int]:
        """Number of labels of every column."""
        known = self._size_and_version()[0]
        return {c: known.get(c, 0) for c in self.getInputCols()}

    def copy(self, extra=None) -> LabelEncoderModel:
        return self._copyValues(LabelEncoderModel(self.labels, self._known), extra)

    def extended(self, df: DataFrame) -> LabelEncoderModel:
        """The model of the next version: labels that ``df`` adds come behind the known ones (by frequency in ``df``)."""
        counts = label_counts(df, self._checked()).join(self.labels.select("column", "label"), ["column", "label"], "left_anti")
        sizes = self._size_and_version()[0]
        more, now = numbered(counts, sizes, self.version + 1)
        version = self.version + (now != sizes)  # without new labels it stays as it is
        return self._copyValues(LabelEncoderModel(self.labels.unionByName(more), (now, version)))

    def at_version(self, version: int) -> LabelEncoderModel:
        return self._copyValues(LabelEncoderModel(self.labels.where(F.col("version") <= version)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        policy, sizes = self.getHandleInvalid(), None
        columns = self._checked()
        for column, out in zip(columns, self.getOutputCols(), strict=True):
            own = self.labels.where(F.col("column") == column).select(F.col("label").alias("_label"), F.col("idx").alias("_idx"))
            key, idx = dataset[f"`{column}`"], own["_idx"]
            joined = dataset.join(own, key.cast("string") == own["_label"], "inner" if policy == "skip" else "left")
            if policy == "keep":
                sizes = sizes or self.sizes
                idx = F.coalesce(idx, F.lit(float(sizes[column])))
            elif policy == "error":
                unseen = F.concat(F.lit(f"NULL label or label not in the dictionary in {column}: "), F.coalesce(key.cast("string"), F.lit("NULL label")))
                idx = F.coalesce(idx, F.raise_error(unseen).cast("double"))
            dataset = joined.select(*[dataset[f"`{c}`"] for c in dataset.columns], idx.alias(out))
        return self._vectors(dataset) if self.getVectorCols() else dataset

    def _vectors(self, df: DataFrame) -> DataFrame:
        """Sparse one-hot vectors. The encoder is fitted on the sizes, not on the rows."""
        extra = 1 if self.getHandleInvalid() == "keep" else 0
        most = [float(max(0, self.sizes[c] + extra - 1)) for c in self.getInputCols()]
        encoder = OneHotEncoder(inputCols=self.getOutputCols(), outputCols=self.getVectorCols(), dropLast=False)
        sizes = df.sparkSession.createDataFrame([tuple(most)], ", ".join(f"`{c}` double" for c in self.getOutputCols()))
        return encoder.fit(sizes).transform(df)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()

    def append_to(self, path: str) -> None:
        """Add the versions that the model saved at ``path`` does not have yet; its files stay as they are."""
        spark = self.labels.sparkSession
        have = _ModelReader().load(path)
        known = have._size_and_version()
        mine = self.at_version(known[1])._size_and_version()
        if known != mine:
            raise ValueError(f"the model at {path} is no earlier version of this one")
        more = self.labels.where(F.col("version") > known[1])
        more.write.mode("append").partitionBy("version").parquet(f"{path}/labels")
        spark.catalog.refreshByPath(f"{path}/labels")


class _ModelWriter(MLWriter):
    def __init__(self, instance: LabelEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.labels.write.partitionBy("version").parquet(f"{path}/labels")


class _ModelReader(MLReader):
    def load(self, path: str) -> LabelEncoderModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = LabelEncoderModel(spark.read.schema(LABELS).parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
