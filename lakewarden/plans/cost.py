"""Consumption and cost from usage records and price lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions import ago
from lakewarden.operators.joins import validity_join
from lakewarden.operators.latest import latest
from lakewarden.operators.shape import first_rows

RUN = ["workspace_id", "job_id", "run_id"]


def price_at(usage: DataFrame, prices: DataFrame, currency: str = "USD", closed: str = "left",
             width: str = "month", newest: Column | None = None) -> DataFrame:
    """Usage with the price in force at its start; usage without a price is kept."""
    card = prices.filter(F.col("currency_code") == currency).select(
        "sku_name", "price_start_time", "price_end_time", F.col("pricing.default").alias("price"))
    return validity_join(usage, card, ["sku_name"], "usage_start_time", "price_start_time",
                         "price_end_time", closed=closed, width=width, newest=newest)


def cost_per_run(usage: DataFrame, prices: DataFrame, runs: DataFrame, product: str = "JOBS",
                 currency: str = "USD", closed: str = "left", n: int | None = None) -> DataFrame:
    """Cost per job run and SKU with start, end and final state of the run.

    Usage is summed per run, SKU, user and start time before it meets the prices, which keeps the
    interval join small. Runs are reduced per state, then to one row each, before the last join;
    the state is the one that ended last. Names and states are grouping keys in the first step:
    text in an aggregate would make Spark sort all rows instead of hashing them.
    """
    flat = usage.filter(F.col("billing_origin_product") == product).select(
        "workspace_id", F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("run_id"), "sku_name", "usage_start_time",
        "usage_quantity", F.col("identity_metadata.run_as").alias("run_as"))
    summed = flat.groupBy(*RUN, "sku_name", "usage_start_time", "run_as").agg(
        F.sum("usage_quantity").alias("usage_quantity"))
    newest = usage.agg(F.max("usage_start_time").alias("m")).scalar()
    priced = price_at(summed, prices, currency, closed, newest=newest).groupBy(
        *RUN, "sku_name", "run_as").agg(
        F.sum(F.col("usage_quantity") * F.col("price")).alias("usage_cost"),
        F.sum("usage_quantity").alias("usage_quantity"))
    costs = priced.groupBy(*RUN, "sku_name").agg(
        F.max("run_as").alias("run_as"), F.sum("usage_cost").alias("usage_cost"),
        F.sum("usage_quantity").alias("usage_quantity"))
    per_state = runs.groupBy(*RUN, "result_state").agg(
        F.min("period_start_time").alias("start"), F.max("period_end_time").alias("end"))
    ended = F.when(F.col("result_state").isNotNull(), F.struct("end", "result_state"))
    run_rows = per_state.groupBy(*RUN).agg(
        F.min("start").alias("run_start_time"), F.max("end").alias("run_end_time"),
        F.max_by("result_state", ended).alias("result_state"))
    report = costs.join(run_rows, RUN, "left").select(
        *RUN, "sku_name", "run_as", "usage_cost", "usage_quantity", "run_start_time",
        "run_end_time", "result_state")
    order = [F.desc_nulls_last("usage_cost"), *map(F.col, (*RUN, "sku_name"))]
    return first_rows(report, order, n)


def usage_mix(usage: DataFrame, as_of: datetime, days: int = 30, n: int | None = None) -> DataFrame:
    """Days used, total and mean units per active day for each SKU."""
    total, active = F.sum("usage_quantity"), F.countDistinct("usage_date")
    report = _since_day(usage, as_of, days).groupBy("sku_name").agg(
        active.alias("days_used"), F.round(total, 1).alias("total_units"),
        F.round(total / active, 1).alias("avg_units_per_day"))
    return first_rows(report, [F.desc("total_units"), F.col("sku_name")], n)


def top_jobs(usage: DataFrame, jobs: DataFrame, as_of: datetime, days: int = 30,
             n: int | None = 10) -> DataFrame:
    """Jobs with most units; units are summed per job before the names are joined."""
    units = _since_day(usage, as_of, days).filter("usage_metadata.job_id IS NOT NULL").groupBy(
        "workspace_id", F.col("usage_metadata.job_id").alias("job_id")).agg(
        F.sum("usage_quantity").alias("total_units"))
    names = latest(jobs.select("workspace_id", "job_id", "name", "change_time", "version_id"),
                   ["workspace_id", "job_id"], ["change_time", "version_id"]).select(
        "workspace_id", "job_id", F.col("name").alias("job_name"))
    report = units.join(names, ["workspace_id", "job_id"], "left").select("job_id", "job_name", "total_units")
    return first_rows(report, [F.desc("total_units"), F.col("job_id")], n)


def _since_day(usage: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return usage.filter(F.col("usage_date") >= F.lit(ago(as_of, days, "days").date()))
