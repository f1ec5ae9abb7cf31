"""Stored state of columns per day, merged into profiles, drift and alerts of any span of days.

One pass over the rows gives one small row per day and column: counts, range, mean and squared
deviation, a KLL sketch of the values and a HyperLogLog sketch of the distinct ones. Everything else
reads these rows only; the profile of a month reads 30 rows per column.

Counts, range, mean and spread are exact after a merge. A quantile is a value whose rank is off by at
most ``rank_error()`` of the rows (with 99 % confidence, merged or not), a distinct count by about
``DISTINCT_ERROR`` (one standard deviation).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from lakewarden.operators.profile import MEASURES

KLL_K, HLL_BITS = 800, 14
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
GRID = 128  # quantiles by which two sketches are compared


def rank_error(k: int = KLL_K) -> float:
    """Error of a rank from a KLL sketch of size ``k``: the published fit, at 99 % confidence."""
    return 2.296 / k ** 0.9723


def _state(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    numeric = isinstance(kind, T.NumericType)
    value = c.cast("double") if numeric else F.lit(None).cast("double")
    known = F.when(c.isNotNull(), F.xxhash64(c))
    return F.struct(
        F.lit(name).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"),
        F.count(F.lit(1)).alias("num_rows"), F.count_if(c.isNull()).alias("num_nulls"),
        (F.count_if(value == 0) if numeric else F.lit(None).cast("long")).alias("num_zeros"),
        F.count(value).alias("num_values"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("deviation"),
        F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias("quantiles"),
        F.hll_sketch_agg(known, HLL_BITS).alias("distinct"))


def daily_state(df: DataFrame, columns: Sequence[str], ts: str) -> DataFrame:
    """One row per day and column; sketches are combined before the shuffle."""
    names = [f"m{i}" for i in range(len(columns))]
    wide = df.groupBy(F.to_date(ts).alias("day")).agg(*[_state(df, c).alias(n) for c, n in zip(columns, names)])
    return wide.select("day", F.explode(F.array(*names)).alias("m")).select("day", "m.*")


def store_days(state: DataFrame, path: str, now: datetime) -> None:
    """Add the days of ``state`` to the stored ones. Of a day stored before, readers take the newer row,
    so a refresh replaces days without touching a file that is in use."""
    stamp = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    state.withColumn("stored_at", stamp).repartitionByRange("day").sortWithinPartitions("day") \
        .write.mode("append").parquet(path)


def read_days(spark: SparkSession, path: str, first: datetime | None = None,
              last: datetime | None = None) -> DataFrame:
    """Newest state of the stored days from ``first`` to before ``last``; files are sorted by day, so
    others are hardly read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("day") >= F.lit(first.date()))
    if last is not None:
        rows = rows.filter(F.col("day") < F.lit(last.date()))
    rest = [c for c in rows.columns if c not in ("day", "column_name", "stored_at")]
    newest = F.max_by(F.struct(*rest), "stored_at").alias("s")
    return rows.groupBy("day", "column_name").agg(newest).select("day", "column_name", "s.*")


def _merged_spread(parts: Column) -> Column:
    """Count, mean and squared deviation of all parts, two at a time (no large squares are subtracted)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("deviation"))

    def both(a: Column, b: Column) -> Column:
        n, step = a["n"] + b["n"], b["mean"] - a["mean"]
        grown = F.struct(
            n.alias("n"), (a["mean"] + step * b["n"] / n).alias("mean"),
            (a["deviation"] + b["deviation"] + step * step * a["n"] * b["n"] / n).alias("deviation"))
        return F.when(b["n"] > 0, grown).otherwise(a)

    return F.aggregate(parts, start, both)


def merged(state: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``state`` merged per column (and ``keys``), still as state. A group has one row per day,
    so the lists within it are as long as the span of days."""
    parts = F.collect_list(F.struct("num_values", "mean", "deviation"))
    renamed = F.transform(F.array_sort(parts), lambda p: F.struct(
        p["num_values"].alias("n"), F.coalesce(p["mean"], F.lit(0.0)).alias("mean"),
        F.coalesce(p["deviation"], F.lit(0.0)).alias("deviation")))
    found = state.groupBy(*keys, "column_name", "data_type").agg(
        *[F.sum(c).alias(c) for c in ("num_rows", "num_nulls", "num_zeros", "num_values")],
        F.min("min").alias("min"), F.max("max").alias("max"), _merged_spread(renamed).alias("_spread"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))
    some = F.col("num_values") > 0
    return found.withColumns({"mean": F.when(some, F.col("_spread.mean")),
                              "deviation": F.when(some, F.col("_spread.deviation"))}).drop("_spread")


def quantile(share: float) -> Column:
    return F.when(F.col("num_values") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(share)))


def measured(state: DataFrame) -> DataFrame:
    """State as the columns of a profile; whatever stands beside it stays."""
    spread = F.when(F.col("num_values") > 1, F.sqrt(F.col("deviation") / (F.col("num_values") - 1)))
    out = state.withColumns({
        "null_percentage": F.col("num_nulls") * 100.0 / F.col("num_rows"),
        "distinct_count": F.hll_sketch_estimate("distinct"), "stddev": spread,
        "percentile_25": quantile(0.25), "percentile_75": quantile(0.75)})
    keys = [c for c in state.columns if c not in (*MEASURES, "num_values", "deviation", "quantiles", "distinct",
                                                  "column_name", "data_type")]
    return out.select(*keys, "column_name", "data_type", *MEASURES)


def daily_profile(state: DataFrame) -> DataFrame:
    """One row per day and column, with the window that reports and alerts on profiles read."""
    start = F.col("day").cast("timestamp_ntz")
    return measured(state).select(start.alias("window_start"),
                                  (start + F.expr("INTERVAL 1 DAY")).alias("window_end"),
                                  "column_name", "data_type", *MEASURES)


def daily_drift(state: DataFrame) -> DataFrame:
    """Each day beside the day before it, per numeric column: distance of the two distributions.

    ``ks_stat`` is the largest gap between the shares of values up to a value, ``wasserstein_distance``
    the mean gap between equal quantiles, both on GRID quantiles; the first is off by at most
    ``2 * rank_error() + 1 / GRID``.
    """
    shares = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    numeric = state.filter("num_values > 0").select(
        "day", "column_name", F.kll_sketch_get_quantile_double("quantiles", shares).alias("q"))
    before = Window.partitionBy("column_name").orderBy("day")  # one row per day
    pairs = numeric.select("day", "column_name", "q", F.lag("q").over(before).alias("p")).filter("p is not null")

    def gap(one: Column, other: Column) -> Column:
        """Largest difference of shares, seen from the values of ``one``."""
        return F.array_max(F.transform(one, lambda v: F.abs(
            F.size(F.filter(one, lambda x: x <= v)) - F.size(F.filter(other, lambda x: x <= v))) / GRID))

    moved = F.aggregate(F.zip_with("p", "q", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda t, v: t + v) / GRID
    return pairs.select("day", "column_name", F.greatest(gap(F.col("p"), F.col("q")), gap(F.col("q"), F.col("p")))
                        .alias("ks_stat"), moved.alias("wasserstein_distance"))


def recent_null_rate(state: DataFrame, column: str, as_of: datetime, span: int = 1) -> DataFrame:
    """Highest null percentage of a column in the last ``span`` days: reads that many rows."""
    edge = F.date_sub(F.lit(as_of.date()), span)
    return state.filter((F.col("column_name") == column) & (F.col("day") >= edge)).agg(
        F.max(F.col("num_nulls") * 100.0 / F.col("num_rows")).alias("max_null_pct"))
