"""Stored intermediate tables in the shared folder, removed as soon as they are not needed."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from lakewarden.session import fresh_dir


class Scratch:
    """Writes tables below ``spark.checkpoint.dir`` and reads them back, which cuts the lineage: a
    lost executor repeats only what came after. ``drop`` removes tables by the store's own calls."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, fresh_dir(spark, label), 0

    def save(self, df: DataFrame, name: str, rows: int = 0) -> DataFrame:
        """``rows`` is the most of one file (0: any number), for rows that are work for a task each."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.option("maxRecordsPerFile", rows).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        jvm = self.spark._jvm
        for t in tables:
            if t is not None and (path := getattr(t, "_scratch", None)):
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def release(self) -> None:
        """Let the driver notice shuffles of finished steps, whose files are removed only when its
        garbage is collected."""
        gc.collect()
        self.spark._jvm.System.gc()
