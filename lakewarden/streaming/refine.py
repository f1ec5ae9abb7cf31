"""Append-only telemetry folders streamed through the stateless report models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from lakewarden.sources.tables import ANY_AGE, opened
from lakewarden.streaming.medallion import run_once


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 glob: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """Stream of an append-only Parquet folder."""
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE) \
        .option("maxFilesPerTrigger", files_per_batch)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return opened(path, reader.parquet)


def stream_project(stream: DataFrame, model: Callable[[DataFrame], DataFrame], out: str,
                   checkpoint: str) -> DataFrame:
    """Append the refined rows of everything new and return the table written so far."""
    run_once(model(stream), out, checkpoint)
    return stream.sparkSession.read.parquet(out)
