"""Scoring new data as a stream (F11 on Structured Streaming).

The fitted feature state is three small tables (encoders, selected columns,
scaler statistics), and applying it is stream-static equi-joins plus column
expressions, so the same ``FeatureProcessor.transform`` runs unchanged on a
streaming frame. No streaming state is kept. This is the scoring side of the
batch pipeline, not a separate streaming operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.features import FeatureProcessor


def read_new_data(spark: SparkSession, path: str, schema: StructType,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """File source for new rows (schema is fixed at fit time)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(stream: DataFrame, processor: FeatureProcessor, model=None,
                 keep: list[str] | None = None) -> DataFrame:
    """Encode (unseen -> 0), select, scale, and optionally run an MLlib model."""
    features = processor.transform(stream, keep=keep)
    if model is None:
        return features
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=processor.selected, outputCol="features",
                         handleInvalid="keep")
    return model.transform(va.transform(features))


def start_sink(scored: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append scored rows to parquet; the checkpoint folder makes restarts exactly-once."""
    w = (scored.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
