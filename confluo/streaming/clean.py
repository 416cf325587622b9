"""Cleaning and scoring of records as they arrive; the batch expressions serve streams as they are."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from confluo.operators.model import score
from confluo.operators.records import clean
from confluo.sources.tables import RECORD


def clean_stream(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Parquet files of raw records appearing in source become clean records in target; ends once all present are done."""
    stream = clean(spark.readStream.schema(RECORD).parquet(source))
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def score_stream(spark: SparkSession, model: PipelineModel, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Pair features appearing in source become pair scores in target."""
    stream = score(model, spark.readStream.schema(schema).parquet(source))
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
