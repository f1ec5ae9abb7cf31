"""Registered queries with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from checks.views_sql import with_views
from lakewarden.plans.views import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
PLAIN: dict[str, Callable[[Lake], DataFrame]] = {}  # the same without rounding, for timing
ORACLES: dict[str, str] = {}

# Doubles are compared at four digits, or two from a million on. The small offset keeps values that
# lie exactly between two roundings from falling to different sides in two engines that add in a
# different order.
LARGE = 1e6


def settled(df: DataFrame) -> DataFrame:
    def rounded(c: Column) -> Column:
        return F.when(F.abs(c) >= LARGE, F.round(c + 1e-4, 2)).otherwise(F.round(c + 1e-7, 4))

    return df.select(*[
        rounded(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema])


def settled_sql(sql: str, doubles: str) -> str:
    if not doubles:
        return sql
    replaced = ", ".join(
        f"CASE WHEN abs({c}) >= {LARGE} THEN round({c} + 1e-4, 2) ELSE round({c} + 1e-7, 4) END"
        f" AS {c}" for c in doubles.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({sql}) AS result"


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a Spark query and, if it can be written in SQL, its oracle."""
    def register(fn: Callable[[Lake], DataFrame]):
        PLAIN[name] = fn
        QUERIES[name] = lambda spark, folder: settled(fn(Lake(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_views(settled_sql(sql, doubles))
        return fn
    return register
