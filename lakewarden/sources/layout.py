"""Rewrites of a dataset: compaction and clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.sources.files import file_inventory


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 1 << 30) -> None:
    """Rewrite many small files into files of about ``target_bytes``.

    The scan itself packs small files into one task up to the target size, so rows are copied
    without a shuffle. The settings live in a session of their own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.read.parquet(path).write.parquet(out)


def cluster(df: DataFrame, columns: Sequence[str], spread: str, out: str, files: int) -> None:
    """Write ``df`` sorted over ``files`` files by ``columns``.

    A hash of ``spread`` is the last range column: rows with one and the same clustering value
    can then fill several files instead of one.
    """
    tie = F.xxhash64(spread)
    df.repartitionByRange(files, *columns, tie).sortWithinPartitions(*columns).write.parquet(out)


def file_count(spark: SparkSession, path: str, target_bytes: int) -> int:
    """Files of ``target_bytes`` needed for the data now below ``path``."""
    total = file_inventory(spark, path).agg(F.sum("size_bytes").alias("b")).first()["b"] or 0
    return max(1, -(-total // target_bytes))
