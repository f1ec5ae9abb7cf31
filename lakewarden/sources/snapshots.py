"""Dataset kept as whole snapshots: one folder per version and a small manifest.

A version counts only when its manifest row exists, and that row is written after the data. One
writer at a time is assumed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.functions import ago
from lakewarden.operators.sets import snapshot_diff
from lakewarden.sources.files import file_inventory

MANIFEST = "version bigint, committed_at timestamp_ntz, operation string, row_count bigint"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Versions with commit time, operation and row count."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _newest(spark: SparkSession, path: str) -> int:
    try:
        return manifest(spark, path).agg(F.max("version").alias("v")).first()["v"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1


def commit(df: DataFrame, path: str, operation: str, at: datetime) -> int:
    """Write ``df`` as the next version and return its number.

    ``overwrite`` replaces the remains of a commit that was cut off before its manifest row.
    """
    spark = df.sparkSession
    version = _newest(spark, path) + 1
    data = f"{path}/data/v={version}"
    df.write.mode("overwrite").parquet(data)
    rows = spark.read.parquet(data).count()
    spark.createDataFrame([(version, at, operation, rows)], MANIFEST).coalesce(1).write.mode(
        "append").parquet(f"{path}/manifest")
    return version


def as_of(spark: SparkSession, path: str, version: int | None = None,
          ts: datetime | None = None) -> DataFrame:
    """Rows of a version, of the newest version at ``ts``, or of the newest version."""
    known = manifest(spark, path)
    if version is not None:
        known = known.filter(F.col("version") == version)
    if ts is not None:
        moment = F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
        known = known.filter(F.col("committed_at") <= moment)
    chosen = known.agg(F.max("version").alias("v")).first()["v"]
    if chosen is None:
        raise ValueError(f"no such version of {path}: version={version}, ts={ts}")
    return spark.read.parquet(f"{path}/data/v={chosen}")


def restore(spark: SparkSession, path: str, version: int, at: datetime) -> int:
    """Write an earlier version again as the newest one."""
    return commit(as_of(spark, path, version), path, f"RESTORE {version}", at)


def history(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Operation of every version with the rows it added, removed and changed.

    The loop runs over manifest entries; rows are compared by Spark.
    """
    versions = [r["version"] for r in manifest(spark, path).select("version").orderBy("version")
                .collect()]
    changes = None
    for before, after in zip(versions, versions[1:]):
        diff = snapshot_diff(as_of(spark, path, before), as_of(spark, path, after), keys)
        counted = diff.agg(*[
            F.coalesce(F.count_if(F.col("change") == c), F.lit(0)).alias(f"rows_{c}")
            for c in ("added", "removed", "changed")]).withColumn("version", F.lit(after))
        changes = counted if changes is None else changes.unionByName(counted)
    known = manifest(spark, path)
    if changes is None:
        return known
    return known.join(changes, "version", "left").orderBy("version")


def version_counts(spark: SparkSession, path: str) -> DataFrame:
    return manifest(spark, path).select("version", "row_count").orderBy("version")


def expired(spark: SparkSession, path: str, now: datetime, days: int = 7,
            keep: int = 1) -> DataFrame:
    """Files a cleanup could remove (nothing is deleted).

    These are files of versions committed before the retention time, except the newest ``keep``
    versions, and files of versions without a manifest row.
    """
    edge = F.lit(ago(now, days, "days").isoformat(sep=" ")).cast("timestamp_ntz")
    known = manifest(spark, path)
    newest = known.agg(F.max("version").alias("v")).select("v").scalar()
    kept = known.filter((F.col("committed_at") >= edge) | (F.col("version") > newest - keep))
    files = file_inventory(spark, f"{path}/data").withColumn(
        "version", F.regexp_extract("file_path", r"/v=(\d+)/", 1).cast("bigint"))
    return files.join(kept.select("version"), "version", "left_anti").select(
        "version", "file_path", "size_bytes")
