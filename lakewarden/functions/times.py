"""Time filters against an explicit ``as_of`` instead of the wall clock."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def at(df: DataFrame, column: str, moment: datetime) -> Column:
    """``moment`` as a literal of the column's own type, so the comparison reaches the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast(df.schema[column].dataType)


def ago(as_of: datetime, n: int, unit: str) -> datetime:
    """``as_of`` minus ``n`` minutes, hours, days or weeks."""
    return as_of - timedelta(**{unit: n})


def since(df: DataFrame, column: str, as_of: datetime, n: int, unit: str = "days",
          strict: bool = False) -> DataFrame:
    """Rows whose ``column`` lies in the last ``n`` units before ``as_of``."""
    edge = at(df, column, ago(as_of, n, unit))
    return df.filter(F.col(column) > edge if strict else F.col(column) >= edge)


def trunc(df: DataFrame, unit: str, column: str) -> Column:
    """Start of the calendar unit, in the column's own type (``date_trunc`` adds a time zone)."""
    return F.date_trunc(unit, column).cast(df.schema[column].dataType)


def seconds_between(start: str, end: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, {start}, {end})")
