"""Stateless feature encoding and scoring over a stream of daily sales files."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bandwise.functions.calendar import add_welfare_day_flag, encode_calendar, encode_welfare
from bandwise.operators.models import two_stage_score
from bandwise.session import fresh_path


def sales_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A file stream of sales rows (new files in ``source_dir`` become micro-batches)."""
    return spark.readStream.format(fmt).schema(schema).load(source_dir)


def stream_features(df: DataFrame) -> DataFrame:
    """Calendar, holiday, welfare amount and welfare-day flag: row-local, so stream-safe."""
    return encode_calendar(df).transform(encode_welfare).transform(add_welfare_day_flag)


def stream_scores(df: DataFrame, classifier: Transformer, regressor: Transformer) -> DataFrame:
    """Two-stage scoring of each micro-batch (both stages are narrow transforms)."""
    return two_stage_score(df, classifier, regressor)


def write_stream(
    df: DataFrame, sink_dir: str, checkpoint_dir: str | None = None, available_now: bool = True, fmt: str = "parquet"
) -> StreamingQuery:
    """Append to ``sink_dir``; the checkpoint lives in the shared folder so a restarted query resumes."""
    spark = df.sparkSession
    w = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir or fresh_path(spark, "stream_checkpoint"))
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
