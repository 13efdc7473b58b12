"""Additions beyond batch: incremental append and ratings over streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def timed(stream: DataFrame, event_time: str) -> DataFrame:
    """Watermarks need a timestamp with a time zone."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp"))


def append_once(stream: DataFrame, key: str, event_time: str, late: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append every key once; a repeat within ``late`` of its first event is dropped, with state no longer than that."""
    once = timed(stream, event_time).withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])
    return once.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, event_time: str, late: str, width: str, by: str) -> DataFrame:
    """Events and their values by tumbling window and key; late ones count until the watermark has passed."""
    return timed(stream, event_time).withWatermark(event_time, late).groupBy(F.window(event_time, width), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
