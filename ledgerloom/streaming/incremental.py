"""Incremental processing of files: what is new since the last run, each batch committed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_available(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, form: str = "json") -> None:
    """Runs work over the files not seen before and appends its rows; a second run over the same files writes nothing.

    Each batch goes to a folder of its own that a repeated batch overwrites, so a batch that failed after writing leaves
    no doubles.
    """

    def sink(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).format(form).load(source)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by event-time window and key; rows later than the watermark are dropped when streaming."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
