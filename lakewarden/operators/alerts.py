"""Alerts: one value, a comparison and a threshold."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from lakewarden.functions import ago, at, since
from lakewarden.operators.aggregates import count_where

OPERATORS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
             "==": operator.eq, "!=": operator.ne}


@dataclass(frozen=True)
class Alert:
    """``query`` gives one row with one value. ``empty`` is the status of a NULL value."""

    name: str
    query: Callable[[], DataFrame]
    op: str
    threshold: float
    empty: str = "OK"


def evaluate(alerts: Sequence[Alert], as_of: datetime, like: DataFrame) -> DataFrame:
    """Status of every alert: TRIGGERED, OK, or ERROR when its query cannot be planned."""
    return reduce(DataFrame.unionByName, [_status(a, as_of, like) for a in alerts])


def _status(alert: Alert, as_of: datetime, like: DataFrame) -> DataFrame:
    try:
        source = alert.query()
        value = F.col(source.columns[0]).cast("double")
        row = source.select(value.alias("value"))
    except AnalysisException:
        row = like.sparkSession.range(1).select(F.lit(None).cast("double").alias("value"))
        status = F.lit("ERROR")
    else:
        hit = OPERATORS[alert.op](F.col("value"), F.lit(float(alert.threshold)))
        status = F.when(F.col("value").isNull(), alert.empty).when(hit, "TRIGGERED").otherwise("OK")
    return row.select(
        F.lit(alert.name).alias("alert"), "value", F.lit(alert.op).alias("op"),
        F.lit(float(alert.threshold)).alias("threshold"), status.alias("status"),
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("evaluated_at"))


def failed_jobs(runs: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    return since(runs, "period_start_time", as_of, hours, "hours").agg(
        count_where(F.col("result_state") == "FAILED").alias("failed_jobs"))


def null_rate(profiles: DataFrame, column: str, as_of: datetime, days: int = 3) -> DataFrame:
    """Highest null percentage (0 to 100) of a column in recent windows."""
    recent = F.col("window_end") >= at(profiles, "window_end", ago(as_of, days, "days"))
    return profiles.filter((F.col("column_name") == column) & recent).agg(
        F.max("null_percentage").alias("max_null_pct"))


def queue_wait(history: DataFrame, as_of: datetime, minutes: int = 30) -> DataFrame:
    wait = F.col("waiting_at_capacity_duration_ms")
    return since(history, "start_time", as_of, minutes, "minutes").filter(wait > 0).agg(
        F.avg(wait).alias("avg_queue_wait_ms"))


def units_today(usage: DataFrame, as_of: datetime) -> DataFrame:
    return usage.filter(F.col("usage_date") == F.lit(as_of.date())).agg(
        F.sum("usage_quantity").alias("units"))


def denied_today(audit: DataFrame, as_of: datetime) -> DataFrame:
    status = F.expr("try_cast(response['status_code'] AS INT)")
    return audit.filter(F.col("event_date") == F.lit(as_of.date())).agg(
        count_where(status != 200).alias("denied"))


def null_keys(orders: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    return since(orders, "order_timestamp", as_of, days).agg(
        count_where(F.col("customer_id").isNull()).alias("null_keys"))


def hours_stale(df: DataFrame, ts: str, as_of: datetime) -> DataFrame:
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.agg(F.max(ts).alias("newest")).select(
        F.timestamp_diff("HOUR", F.col("newest"), now).alias("hours_stale"))


def row_count_ratio(df: DataFrame, ts: str, as_of: datetime, days: int = 7) -> DataFrame:
    """Rows of the last day divided by the daily mean of the ``days`` before it."""
    day = at(df, ts, ago(as_of, 1, "days"))
    recent = since(df, ts, as_of, days + 1).filter(F.col(ts) < at(df, ts, as_of))
    today, before = F.count_if(F.col(ts) >= day), F.count_if(F.col(ts) < day)
    return recent.agg(F.try_divide(today, before / days).alias("ratio"))
