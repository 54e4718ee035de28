"""Incremental contribution totals: the batch aggregation over a stream of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def windowed_totals(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts and sums per window and type; rows later than ``late`` are dropped by the watermark when streaming."""
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("window_start"), "event_type", "n", "total"
    )
