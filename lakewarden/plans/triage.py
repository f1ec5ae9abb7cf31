"""Short questions asked while looking into an incident."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from lakewarden.functions import ago, since
from lakewarden.operators.latest import with_latest
from lakewarden.operators.shape import first_rows
from lakewarden.plans.cost import price_at


def recent_failures(runs: DataFrame, jobs: DataFrame, as_of: datetime, hours: int) -> DataFrame:
    failed = since(runs, "period_start_time", as_of, hours, "hours").filter(
        "result_state = 'FAILED'")
    return with_latest(failed, jobs, ["workspace_id", "job_id"], ["change_time", "version_id"],
                       ["name"], "left").select(
        "job_id", F.col("name").alias("job_name"), "run_id", "termination_code",
        "period_start_time")


def units_per_day(usage: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    edge = F.lit(ago(as_of, days, "days").date())
    return usage.filter(F.col("usage_date") >= edge).groupBy("usage_date").agg(
        F.sum("usage_quantity").alias("units"))


def costliest_job_user(usage: DataFrame, prices: DataFrame, as_of: datetime, days: int = 30,
                       n: int | None = 1) -> DataFrame:
    """User behind the most expensive job. Usage is summed before it is priced."""
    edge = F.lit(ago(as_of, days, "days").date())
    summed = usage.filter(
        (F.col("usage_date") >= edge) & F.col("usage_metadata.job_id").isNotNull()
    ).groupBy(F.col("usage_metadata.job_id").alias("job_id"),
              F.col("identity_metadata.run_as").alias("run_as"), "sku_name", "usage_start_time"
              ).agg(F.sum("usage_quantity").alias("usage_quantity"))
    newest = usage.agg(F.max("usage_start_time").alias("m")).scalar()
    cost = price_at(summed, prices, newest=newest).groupBy("job_id", "run_as").agg(
        F.sum(F.col("usage_quantity") * F.col("price")).alias("cost"))
    return first_rows(cost, [F.desc_nulls_last("cost"), F.col("job_id"), F.col("run_as")], n)


def slowest_warehouse(history: DataFrame, n: int | None = 1) -> DataFrame:
    means = history.filter("compute.warehouse_id IS NOT NULL").groupBy(
        F.col("compute.warehouse_id").alias("warehouse_id")).agg(
        F.avg("total_duration_ms").alias("avg_duration_ms"))
    return first_rows(means, [F.desc("avg_duration_ms"), F.col("warehouse_id")], n)


def top_user_units(usage: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Units by product of the user who consumed most."""
    edge = F.lit(ago(as_of, days, "days").date())
    per_user = usage.filter(
        (F.col("usage_date") >= edge) & F.col("identity_metadata.run_as").isNotNull()
    ).groupBy(F.col("identity_metadata.run_as").alias("run_as"), "billing_origin_product").agg(
        F.sum("usage_quantity").alias("units"))
    totals = per_user.groupBy("run_as").agg(F.sum("units").alias("t"))
    # Smallest name wins a tie, as max_by would leave it open.
    best = totals.agg(F.min_by("run_as", F.struct(-F.col("t"), F.col("run_as"))).alias("u")).scalar()
    return per_user.filter(F.col("run_as") == best)


def week_over_week(usage: DataFrame, as_of: datetime) -> DataFrame:
    """Units of the last seven days and of the seven before, in one pass."""
    day = F.col("usage_date")
    week, before = (F.lit(ago(as_of, d, "days").date()) for d in (7, 14))
    this = F.sum(F.when(day >= week, F.col("usage_quantity")))
    prior = F.sum(F.when(day < week, F.col("usage_quantity")))
    return usage.filter((day >= before) & (day < F.lit(as_of.date()))).agg(
        this.alias("this_week"), prior.alias("last_week"), (this - prior).alias("change"))
