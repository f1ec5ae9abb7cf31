"""Reading, writing and storing tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.functions import ago, at, bucket


class PathMissing(Exception):
    """The folder to read does not exist."""


#: File age limit of streams: none. The file source would skip files more than a week older than the
#: newest one it has seen, for ever and without an error.
ANY_AGE = "100000d"


def opened(path: str, load: Callable[[str], DataFrame]) -> DataFrame:
    """``load(path)``, with an error that names the path when nothing is there."""
    try:
        return load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise PathMissing(f"path not found: {path}") from e
        raise


def read_table(spark: SparkSession, name: str, ts: str | None = None,
               since: datetime | None = None) -> DataFrame:
    """A Parquet folder (when ``name`` has a slash) or a catalog table, from ``since`` on."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if since is None:
        return df
    return df.filter(F.col(ts) >= at(df, ts, since))


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; without a schema it is inferred from the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return opened(path, reader.json)


def write_table(df: DataFrame, path: str, mode: str) -> None:
    """Write a Parquet folder; ``mode`` is ``overwrite`` or ``append``."""
    df.write.mode(mode).parquet(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Store a query result and return the stored table."""
    write_table(df, path, "overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json_sample(df: DataFrame, n: int, path: str) -> None:
    df.limit(n).write.mode("overwrite").json(path)


def run_noop(df: DataFrame) -> None:
    """Execute the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def snapshot_tables(tables: Mapping[str, DataFrame], out: str, as_of: datetime,
                    bounds: Mapping[str, tuple[str, int]]) -> dict[str, str]:
    """Copy tables to ``out``. ``bounds`` names a time column and days for the bounded ones."""
    written = {}
    for name, df in tables.items():
        if name in bounds:
            ts, days = bounds[name]
            df = df.filter(F.col(ts) >= at(df, ts, ago(as_of, days, "days")))
        written[name] = f"{out}/{name}"
        write_table(df, written[name], "overwrite")
    return written


# Hours without a refresh after which a stored aggregate is stale or ageing.
FRESHNESS = [(24, "STALE"), (4, "AGING")]


def refresh(df: DataFrame, path: str, now: datetime) -> DataFrame:
    """Recompute a stored aggregate and stamp it with the refresh time."""
    stamp = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return materialise(df.withColumn("_last_refreshed", stamp), path)


def refresh_parts(df: DataFrame, path: str, part: str, now: datetime) -> DataFrame:
    """Replace only the days or months that occur in ``df``, one folder per value of ``part``.

    Compute ``df`` from the changed part of the source; the other folders stay as they are.
    """
    stamp = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    stamped = df.withColumn("_last_refreshed", stamp)
    stamped.repartition(part).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return df.sparkSession.read.schema(stamped.schema).parquet(path)


def freshness(stored: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Last refresh, age and status of each stored aggregate."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    report = None
    for name, df in stored.items():
        last = F.max("_last_refreshed").alias("last_refresh")
        row = df.agg(last).select(
            F.lit(name).alias("name"), "last_refresh",
            F.timestamp_diff("MINUTE", "last_refresh", now).alias("minutes_since_refresh"),
            bucket(F.timestamp_diff("HOUR", "last_refresh", now), FRESHNESS, "FRESH")
            .alias("status"))
        report = row if report is None else report.unionByName(row)
    return report
