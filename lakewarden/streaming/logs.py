"""Raw log folders to one parsed table per log class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewarden.sources.files import LOG_CLASSES, classify_logs
from lakewarden.sources.tables import ANY_AGE, opened

CLASSES = [*LOG_CLASSES.values(), "other"]


def centralise_logs(spark: SparkSession, path: str, out: str, checkpoint: str,
                    files_per_batch: int = 1000) -> StreamingQuery:
    """Append new log lines, parsed, to ``out``, one partition folder per log class.

    One partitioned write per batch splits the classes, so the raw files are read once.
    """
    reader = spark.readStream.option("recursiveFileLookup", True).option("maxFileAge", ANY_AGE) \
        .option("maxFilesPerTrigger", files_per_batch)
    lines = opened(path, reader.text).select(
        F.col("_metadata.file_path").alias("log_file"), F.col("value").alias("log_line"))
    query = (
        classify_logs(lines).writeStream.format("parquet").option("path", out)
        .partitionBy("log_class").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def log_table(spark: SparkSession, out: str, log_class: str) -> DataFrame:
    """The table of one log class; only its folder is read."""
    return spark.read.parquet(out).filter(F.col("log_class") == log_class)
