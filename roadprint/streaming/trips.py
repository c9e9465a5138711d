"""Incremental ingestion of step files with Structured Streaming.

The reference has no streaming operator; its input arrives as one step file
per driver.  This module runs the same batch feature plan over such files as
they land: a file-stream source picks up new files, and ``foreachBatch``
computes the trip features of each micro-batch and writes them under the
batch id (overwrite), so a replayed batch after a failure rewrites the same
output instead of duplicating it.  Each file must hold whole trips (the
per-driver file layout guarantees that).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadprint.operators import features
from roadprint.sources.files import STEP_CSV_SCHEMA


def read_step_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(STEP_CSV_SCHEMA).option("header", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(path)
    return raw.select(F.col("driverID").cast("bigint").alias("driver"),
                      F.col("tripID").alias("trip"), "step", "x", "y")


def trip_feature_stream(spark: SparkSession, source: str, sink: str, checkpoint: str,
                        version: int = 1, max_files_per_trigger: int | None = None,
                        available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        feats = features.features_for_version(batch, version)
        feats.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    writer = (read_step_stream(spark, source, max_files_per_trigger).writeStream
              .foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
