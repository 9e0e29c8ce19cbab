"""A usage ledger that grows while it is read: windowed totals with a watermark for late lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_usage(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(window_start, stage, calls, amount) of a batch or stream of (ts, stage, amount); on a stream, closed windows only."""
    own = F.window("ts", width)
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(own.alias("w"), "stage").agg(F.count("*").alias("calls"), F.sum("amount").alias("amount")).select(
        F.col("w.start").alias("window_start"), "stage", "calls", "amount"
    )


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).json(path)
