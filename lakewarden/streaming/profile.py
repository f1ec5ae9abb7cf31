"""Daily counts of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def profile_stream(stream: DataFrame, ts: str, columns: Sequence[str], width: str = "1 day",
                   delay: str = "1 hour") -> DataFrame:
    """Rows and NULLs per column and tumbling window, for append mode.

    A window is written when the watermark has passed its end, so the newest one is still open
    when a run stops.
    """
    timed = stream.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark(
        "_event_time", delay)
    return timed.groupBy(F.window("_event_time", width).alias("w")).agg(
        F.count(F.lit(1)).alias("num_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
    ).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "num_rows",
             *[f"nulls_{c}" for c in columns])
