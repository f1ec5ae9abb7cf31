"""Reports on how evenly keys and shuffle partitions are filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def key_skew(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per key, percentage of all rows and ratio to the median key."""
    counts = df.groupBy(*key).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("t")).scalar()
    median = counts.agg(F.percentile_approx("row_count", 0.5, 100_000).alias("m")).scalar()
    return counts.select(
        *key, "row_count",
        F.round(F.col("row_count") * 100.0 / total, 2).alias("pct"),
        F.round(F.col("row_count") / median, 2).alias("to_median"))


def partition_skew(df: DataFrame, key: Sequence[str], parts: int) -> DataFrame:
    """Rows each of ``parts`` hash partitions would get when shuffled on ``key``.

    Counts per key are combined before they are placed, so the report itself does not move the
    rows it is about.
    """
    place = F.pmod(F.hash(*key), F.lit(parts)).cast("int")
    counts = df.groupBy(place.alias("partition_id")).agg(F.count("*").alias("row_count"))
    median = counts.agg(F.percentile_approx("row_count", 0.5, 100_000).alias("m")).scalar()
    return counts.withColumn("to_median", F.round(F.col("row_count") / median, 2))
