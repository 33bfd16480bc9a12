"""Batch scoring of arriving rows (E4 on a stream).

A fitted ``PipelineModel`` is applied to each micro-batch of a streaming
source through ``foreachBatch``; every batch replaces the partition of its epoch id, so an epoch
that a restarted query (same checkpoint location) runs again does not duplicate output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_stream(model, stream: DataFrame, keep: list[str], output_path: str, checkpoint: str,
                 prediction_col: str = "prediction", available_now: bool = True):
    """Start a streaming query that scores ``stream`` with ``model`` and writes
    ``keep + [prediction]``, one partition an epoch, to Parquet under ``output_path``."""

    def write(batch: DataFrame, epoch: int) -> None:
        scored = model.transform(batch).select(*keep, prediction_col).withColumn("epoch", F.lit(epoch))
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(output_path)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
