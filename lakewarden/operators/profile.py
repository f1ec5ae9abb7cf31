"""Column profiles, per time window or for the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

MEASURES = ["num_rows", "num_nulls", "null_percentage", "num_zeros", "distinct_count", "min",
            "max", "mean", "stddev", "percentile_25", "percentile_75"]


def _measures(df: DataFrame, name: str) -> Column:
    """Mergeable measures of one column; numeric ones are NULL for other types."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    numeric = isinstance(kind, T.NumericType)
    none = F.lit(None).cast("double")
    value = c.cast("double")
    rows, nulls = F.count(F.lit(1)), F.count_if(c.isNull())
    return F.struct(
        F.lit(name).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"),
        rows.alias("num_rows"), nulls.alias("num_nulls"),
        (nulls * 100.0 / rows).alias("null_percentage"),
        (F.count_if(value == 0) if numeric else F.lit(None).cast("long")).alias("num_zeros"),
        (F.min(value) if numeric else none).alias("min"),
        (F.max(value) if numeric else none).alias("max"),
        (F.avg(value) if numeric else none).alias("mean"),
        (F.stddev(value) if numeric else none).alias("stddev"),
        (F.percentile_approx(value, 0.25, 100_000) if numeric else none).alias("percentile_25"),
        (F.percentile_approx(value, 0.75, 100_000) if numeric else none).alias("percentile_75"),
    )


def _stacked(df: DataFrame, window: Column, items: Sequence[Column]) -> DataFrame:
    """Struct aggregates per window as one row per window and column."""
    names = [f"m{i}" for i in range(len(items))]
    wide = df.groupBy(window.alias("window")).agg(*[c.alias(n) for c, n in zip(items, names)])
    return wide.select("window", F.explode(F.array(*names)).alias("m")).select("window", "m.*")


def profile(df: DataFrame, columns: Sequence[str], ts: str | None = None, width: str = "1 day",
            approx: bool = False) -> DataFrame:
    """One row per column (and window): nulls, zeros, distinct values, range and spread.

    Sketches and sums come from one grouped aggregate that combines on the map side. Exact
    distinct counts repeat each row once per column, so they run in an aggregate of their own that
    carries nothing else; ``approx`` counts with sketches in a single pass instead.
    """
    window = F.lit("all") if ts is None else F.window(ts, width)

    def counted(name: str) -> Column:
        c = F.col(f"`{name}`")
        return F.approx_count_distinct(c) if approx else F.countDistinct(c)

    measured = _stacked(df, window, [_measures(df, c) for c in columns])
    distinct = _stacked(df, window, [
        F.struct(F.lit(c).alias("column_name"), counted(c).alias("distinct_count"))
        for c in columns])
    rows = measured.join(distinct, ["window", "column_name"])
    if ts is None:
        return rows.select("column_name", "data_type", *MEASURES)
    return rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "column_name", "data_type", *MEASURES)


def worst_window(profiles: DataFrame, column: str, n: int = 1) -> DataFrame:
    """Windows with the highest null share of a column, with the affected rows."""
    return profiles.filter(F.col("column_name") == column).select(
        "window_start", "column_name", "null_percentage", "num_nulls",
    ).orderBy(F.desc_nulls_last("null_percentage"), "window_start").limit(n)
