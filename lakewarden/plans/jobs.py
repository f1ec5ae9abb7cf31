"""Job health from job definitions and run timelines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from lakewarden.functions import at, ago, seconds_between, since
from lakewarden.operators.latest import latest, with_latest
from lakewarden.operators.shape import first_rows

VERSION = ["change_time", "version_id"]
KEYS = ["workspace_id", "job_id"]


def stale_jobs(jobs: DataFrame, runs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Jobs that ran at some time but not in the last ``days``.

    Job ids repeat over workspaces, so runs are matched on both. The last run per job decides both
    conditions, so one aggregate replaces the join to the recent runs.
    """
    last = runs.groupBy(*KEYS).agg(F.max("period_start_time").alias("last_run"))
    silent = last.filter(F.col("last_run") < at(runs, "period_start_time", ago(as_of, days, "days")))
    return latest(jobs, KEYS, VERSION).join(silent, KEYS).select(
        "job_id", "name", "creator_id", "create_time", "last_run").orderBy(F.desc("last_run"))


def idle_jobs(jobs: DataFrame, runs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Existing jobs whose last job run is at least ``days`` old, or that never ran."""
    current = latest(jobs, KEYS, VERSION).filter("delete_time IS NULL").select(
        *KEYS, "name", F.col("change_time").alias("last_modified_at"), "tags")
    last = runs.filter("run_type = 'JOB_RUN'").groupBy(*KEYS).agg(
        F.max("period_start_time").alias("last_executed_at"))
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    edge = at(runs, "period_start_time", ago(midnight, days, "days"))
    return current.join(last, KEYS, "left").filter(
        F.col("last_executed_at").isNull() | (F.col("last_executed_at") <= edge)
    ).orderBy("last_executed_at", *KEYS)


def runs_by_outcome(runs: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return since(runs, "period_start_time", as_of, days, strict=True).filter(
        "result_state IS NOT NULL"
    ).groupBy("workspace_id", "result_state", F.to_date("period_start_time").alias("date")).agg(
        F.countDistinct("run_id").alias("job_count"))


def _names(jobs: DataFrame) -> DataFrame:
    """Current name per workspace and job."""
    return latest(jobs.select(*KEYS, "name", *VERSION), KEYS, VERSION).select(*KEYS, "name")


def run_counts(runs: DataFrame, jobs: DataFrame, prefix: str, as_of: datetime, days: int = 60,
               n: int | None = 20) -> DataFrame:
    """Runs per job name; runs are counted per job before they meet the names."""
    counts = since(runs, "period_start_time", as_of, days, strict=True).groupBy(*KEYS).agg(
        F.count("*").alias("n"))
    names = _names(jobs).filter(F.col("name").startswith(prefix))
    report = counts.join(names, KEYS).groupBy(F.col("name").alias("job_name")).agg(
        F.sum("n").alias("run_count"))
    return first_rows(report, [F.desc("run_count"), F.col("job_name")], n)


def run_history(runs: DataFrame, jobs: DataFrame, name: str, as_of: datetime,
                days: int = 60) -> DataFrame:
    """Run time of every run of one job as an interval sum."""
    names = _names(jobs).filter(F.col("name") == name)
    rows = since(runs, "period_start_time", as_of, days, strict=True).join(names, KEYS)
    return rows.groupBy(
        "workspace_id", F.col("name").alias("job_name"), "run_id", "result_state",
        F.col("period_start_time").alias("started_at"),
    ).agg(F.sum(F.col("period_end_time") - F.col("period_start_time")).alias("run_time")
          ).orderBy(F.desc("started_at"))


def retried_runs(runs: DataFrame, as_of: datetime | None = None, days: int = 30,
                 n: int | None = None) -> DataFrame:
    """Runs that were retried or failed, with the reason."""
    rows = runs if as_of is None else since(runs, "period_start_time", as_of, days)
    grouped = rows.filter("result_state IS NOT NULL").groupBy(*KEYS, "run_id").agg(
        (F.count("*") - 1).alias("retries_count"),
        F.max(F.when(F.col("result_state") == "FAILED", 1).otherwise(0)).alias("_failed"))
    retried, failed = F.col("retries_count") > 0, F.col("_failed") == 1
    reason = (F.when(retried & failed, "failed and retried").when(retried, "retried")
              .when(failed, "failed"))
    report = grouped.withColumn("reason", reason).filter("reason IS NOT NULL").drop("_failed")
    return first_rows(report, [F.desc("retries_count"), *map(F.col, (*KEYS, "run_id"))], n)


def recent_runs(runs: DataFrame, jobs: DataFrame, as_of: datetime, days: int = 7,
                pattern: str = "%", n: int | None = None) -> DataFrame:
    """Finished runs with termination code and duration, newest first.

    Names are joined per workspace and job.
    """
    rows = since(runs, "period_start_time", as_of, days).filter("result_state IS NOT NULL")
    named = with_latest(rows, jobs, KEYS, VERSION, ["name"], "left").filter(
        F.col("name").like(pattern))
    report = named.select(
        "job_id", F.col("name").alias("job_name"), "run_id", "result_state", "termination_code",
        "compute_type", F.col("period_start_time").alias("started_at"),
        F.col("period_end_time").alias("ended_at"),
        seconds_between("period_start_time", "period_end_time").alias("duration_sec"))
    return first_rows(report, [F.desc("started_at"), F.col("run_id")], n)
