"""Warehouse sizing from query starts per minute."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions import since, trunc
from lakewarden.operators.shape import first_rows

# Estimated queries per minute one cluster of each size handles.
CAPACITY = {
    "2X-Small": 50, "X-Small": 86, "Small": 147, "Medium": 147, "Large": 250,
    "X-Large": 425, "2X-Large": 722, "3X-Large": 1228, "4X-Large": 2087,
}


def _per_minute(history: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return since(history, "start_time", as_of, days).groupBy(
        trunc(history, "minute", "start_time").alias("start_time_minute")).agg(F.count("*").alias("query_count"))


def qpm(history: DataFrame, as_of: datetime, days: int = 30, n: int | None = None) -> DataFrame:
    """Query starts per minute, newest first; minutes without a query do not appear."""
    return first_rows(_per_minute(history, as_of, days), [F.desc("start_time_minute")], n)


def qpm_stats(history: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Minimum, maximum and mean over active minutes."""
    return _per_minute(history, as_of, days).agg(
        F.min("query_count").alias("min_qpm"), F.max("query_count").alias("max_qpm"),
        F.avg("query_count").alias("avg_qpm"), F.count("*").alias("minutes"))


def cluster_need(stats: DataFrame, capacity: int = CAPACITY["Large"]) -> DataFrame:
    return stats.select(
        (F.col("min_qpm") / capacity).alias("min_scaling"),
        (F.col("max_qpm") / capacity).alias("max_scaling"),
        (F.col("avg_qpm") / capacity).alias("avg_clusters"),
        F.col("min_qpm").alias("min_queries_per_min"),
        F.col("max_qpm").alias("max_queries_per_min"),
        F.round("avg_qpm", 1).alias("avg_queries_per_min"),
        F.col("minutes").alias("total_minutes_analyzed"))


def need_by_size(stats: DataFrame, ladder: Mapping[str, int] = CAPACITY) -> DataFrame:
    """Cluster need for every size. The one statistics row is expanded by the ladder in place."""
    rungs = F.array(*[F.struct(F.lit(size).alias("size"), F.lit(q).alias("qpm"))
                      for size, q in ladder.items()])

    def need(column: str) -> Column:
        return F.round(F.col(column) / F.col("rung.qpm"), 2)

    return stats.withColumn("rung", F.explode(rungs)).select(
        F.col("rung.size").alias("warehouse_size"),
        F.col("rung.qpm").alias("queries_per_min_capacity"),
        need("min_qpm").alias("min_clusters"), need("max_qpm").alias("max_clusters"),
        need("avg_qpm").alias("avg_clusters"))


def load_by_hour(history: DataFrame, as_of: datetime, days: int = 30,
                 capacity: int = CAPACITY["Large"]) -> DataFrame:
    """Load per hour of day; the minute fixes the hour, so it is read off after counting."""
    return _per_minute(history, as_of, days).groupBy(
        F.hour("start_time_minute").alias("hour_of_day")
    ).agg(
        F.round(F.avg("query_count"), 1).alias("avg_queries_per_min"),
        F.max("query_count").alias("peak_queries_per_min"),
        F.count("*").alias("sample_count"),
        F.round(F.max("query_count") / capacity, 2).alias("peak_clusters_needed"),
    ).orderBy("hour_of_day")
