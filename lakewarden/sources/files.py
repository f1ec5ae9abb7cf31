"""Files below a folder: inventory, log lines, layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.operators.shape import first_rows
from lakewarden.sources.tables import opened


def file_inventory(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """Path, size and modification time of every file, newest first. File content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listing = opened(path, reader.load).select(
        F.col("path").alias("file_path"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"))
    return first_rows(listing, [F.desc("modified_at"), F.col("file_path")], n)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all log files below ``path`` with the file each one is from."""
    reader = spark.read.option("recursiveFileLookup", True)
    return opened(path, reader.text).select(
        F.col("_metadata.file_path").alias("log_file"), F.col("value").alias("log_line"))


def log_search(lines: DataFrame, patterns: Sequence[str], n: int | None = None) -> DataFrame:
    """Lines that contain any of ``patterns``."""
    hit = F.lit(False)
    for text in patterns:
        hit = hit | F.col("log_line").contains(text)
    found = lines.filter(hit)
    return found if n is None else found.limit(n)


def log_stream(lines: DataFrame, suffix: str, n: int | None = None) -> DataFrame:
    """Lines of the files whose path ends with ``suffix``."""
    found = lines.filter(F.col("log_file").endswith(suffix)).select("log_line")
    return found if n is None else found.limit(n)


# Part of a log file's path and the class of its lines.
LOG_CLASSES = {"stdout": "stdout", "stderr": "stderr", "log4j": "engine"}


def classify_logs(lines: DataFrame) -> DataFrame:
    """Class of each line by its file, with the level and time found in the text."""
    kind = F.lit("other")
    for part, name in LOG_CLASSES.items():
        kind = F.when(F.col("log_file").contains(part), F.lit(name)).otherwise(kind)
    level = F.regexp_extract("log_line", r"\b(FATAL|ERROR|WARN|INFO|DEBUG)\b", 1)
    time = F.regexp_extract("log_line", r"(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})", 1)
    return lines.select(
        "log_file", kind.alias("log_class"), F.nullif(level, F.lit("")).alias("level"),
        F.try_to_timestamp(F.replace(F.nullif(time, F.lit("")), F.lit("T"), F.lit(" ")))
        .cast("timestamp_ntz").alias("logged_at"), "log_line")


def layout_report(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Per file: bytes, rows and the range of ``column``."""
    return (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file_path"),
                F.col("_metadata.file_size").alias("size_bytes"), F.col(column))
        .groupBy("file_path", "size_bytes")
        .agg(F.count("*").alias("row_count"), F.min(column).alias("min_value"),
             F.max(column).alias("max_value"))
    )


def skip_share(layout: DataFrame, low: Column | None = None,
               high: Column | None = None) -> DataFrame:
    """Files, bytes and rows in total, and the share of files a range predicate would skip."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col("max_value") < low)
    if high is not None:
        outside = outside | (F.col("min_value") > high)
    return layout.agg(
        F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"),
        F.sum("row_count").alias("row_count"),
        (F.count_if(outside) / F.count("*")).alias("skip_share"))
