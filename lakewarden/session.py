"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, name: str = "lakewarden") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster the caller brings the session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local session may fall back to a temporary folder: on a cluster other executors
    could not read it back, so a missing setting is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakewarden-"))
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the work folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage so that values which depend on task layout (partition ids) stay the same
    when an executor is lost and a stage runs again.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
