"""Incremental runs over growing folders: a file stream whose batches go through the batch flow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_incrementally(spark: SparkSession, folder: str, schema: str, flow: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 1000):
    """Processes files that have not been seen yet, once each, and returns when none is left.

    A batch that is run again writes to the same place, so its rows are never doubled.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        flow(batch).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
