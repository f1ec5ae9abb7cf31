"""Aggregates that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def pctl(column: str, share: float, accuracy: int = 100_000) -> Column:
    """Percentile as one of the values; a mergeable sketch, so hot groups combine early."""
    return F.percentile_approx(column, share, accuracy)


def count_where(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def share(df: DataFrame, key: Sequence[str], digits: int = 2, count: str = "row_count",
          name: str = "pct") -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total is a scalar subquery over the counts. A window without keys would move every group
    into one task.
    """
    counts = df.groupBy(*key).agg(F.count("*").alias(count))
    total = counts.agg(F.sum(count).alias("t")).scalar()
    return counts.withColumn(name, F.round(F.col(count) * 100.0 / total, digits))


def consecutive(df: DataFrame, keys: Sequence[str], window: str,
                values: Sequence[str]) -> DataFrame:
    """Each aggregated window beside the one before it, per key.

    ``df`` holds one row per key and window, so a key has as many rows as there are windows.
    """
    w = Window.partitionBy(*keys).orderBy(window)
    return df.select(
        *df.columns, F.lag(window).over(w).alias(f"previous_{window}"),
        *[F.lag(v).over(w).alias(f"previous_{v}") for v in values],
        *[(F.col(v) - F.lag(v).over(w)).alias(f"{v}_change") for v in values])


def windowed_metrics(df: DataFrame, ts: str, metrics: dict[str, str],
                     width: str = "1 day") -> DataFrame:
    """Custom metrics: named aggregate expressions per tumbling window."""
    return df.groupBy(F.window(ts, width)).agg(
        *[F.expr(text).alias(name) for name, text in metrics.items()]
    ).select(F.col("window.start").alias("window_start"), *metrics)


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: dict[str, str],
                    aggregates: Sequence[Column] = (), rows: str | None = None) -> DataFrame:
    """Exact distinct counts of several columns per key, next to other aggregates.

    ``counted`` names the result of each column; ``rows`` names the number of rows, if it is wanted.
    Several distinct counts in one aggregate repeat every row, with all its columns, once for each of
    them. Here each column is made distinct on its own, from the keys and that column alone, by key
    and value, so a hot key is divided by its values. One reduction per key follows, which combines
    before its shuffle. NULL is not counted but is a key like any other. ``df`` is read once per column,
    each time without the other columns: give a stored table, not a join that would run again.

    ``aggregates`` must skip NULL, as all aggregates of columns do: give no ``count(*)``.
    """
    parts = [df.withColumn("_row", F.lit(1))]
    for name, column in counted.items():
        parts.append(
            df.select(*keys, F.col(column).alias(f"_value_{name}"))
            .filter(F.col(f"_value_{name}").isNotNull()).distinct()
            .select(*keys, F.lit(1).alias(f"_one_{name}")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    ones = [F.count(f"_one_{name}").alias(name) for name in counted]
    total = [F.count("_row").alias(rows)] if rows else []
    return both.groupBy(*keys).agg(*total, *ones, *aggregates)
