"""Event counts per window as a stream, with late rows dropped behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(events: DataFrame, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
