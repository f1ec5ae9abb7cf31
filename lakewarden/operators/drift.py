"""Distribution change between windows, or against a baseline table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lakewarden.operators.ranking import ordered_by_key

CONSECUTIVE, BASELINE = "CONSECUTIVE", "BASELINE"
PAIR = ["column_name", "window_start"]


def _counts(df: DataFrame, columns: Sequence[str], kind: str, window) -> DataFrame:
    """Rows per window, column and value: all later steps work on this reduced table."""
    items = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value"))
        for c in columns]))
    long = df.select(window.alias("window_start"), items.alias("i")).select("window_start", "i.*")
    return long.filter("value IS NOT NULL").groupBy("window_start", "column_name", "value").agg(
        F.count("*").alias("n"))


def _pairs(counts: DataFrame) -> DataFrame:
    """Value counts of each window (``cur``) beside those of the window before (``prev``).

    Every count is used twice, once for its own window and once for the next one; windows are
    never multiplied with each other.
    """
    order = Window.partitionBy("column_name").orderBy("window_start")
    totals = counts.groupBy(*PAIR).agg(F.sum("n").alias("total")).select(
        *PAIR, "total", F.lag("total").over(order).alias("previous_total"),
        F.lead("window_start").over(order).alias("next_start"),
        F.lead("total").over(order).alias("next_total"))
    placed = counts.join(totals, PAIR)
    zero = F.lit(0).cast("long")

    def role(start, cur, prev, cur_total, prev_total):
        return F.struct(start.alias("window_start"), cur.alias("cur"), prev.alias("prev"),
                        cur_total.alias("cur_total"), prev_total.alias("prev_total"))

    own = role(F.col("window_start"), F.col("n"), zero, F.col("total"), F.col("previous_total"))
    after = role(F.col("next_start"), zero, F.col("n"), F.col("next_total"), F.col("total"))
    rows = placed.select("column_name", "value", F.explode(F.array(own, after)).alias("r")).select(
        "column_name", "value", "r.*").filter("window_start IS NOT NULL AND prev_total IS NOT NULL")
    return _merge(rows)


def _against(counts: DataFrame, base: DataFrame) -> DataFrame:
    """Value counts of the whole table beside those of the baseline, per column."""
    both = counts.select("*", F.lit(True).alias("own")).unionByName(
        base.select("*", F.lit(False).alias("own")))
    totals = both.groupBy(*PAIR).agg(
        F.sum(F.when(F.col("own"), F.col("n"))).alias("cur_total"),
        F.sum(F.when(~F.col("own"), F.col("n"))).alias("prev_total"))
    rows = both.select(*PAIR, "value", F.when(F.col("own"), F.col("n")).otherwise(0).alias("cur"),
                       F.when(~F.col("own"), F.col("n")).otherwise(0).alias("prev"))
    # One row per column on the right: null-safe because the window of a whole table is NULL.
    right = totals.withColumnsRenamed({c: f"_{c}" for c in PAIR})
    joined = rows.join(right, F.col("column_name") == F.col("_column_name"))
    return _merge(joined.drop("_column_name", "_window_start"))


def _merge(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PAIR, "value").agg(
        F.sum("cur").alias("cur"), F.sum("prev").alias("prev"),
        F.max("cur_total").alias("cur_total"), F.max("prev_total").alias("prev_total"))


def _numeric(pairs: DataFrame) -> DataFrame:
    """Wasserstein distance and Kolmogorov-Smirnov statistic from cumulative shares.

    Counts are cumulated as integers, so the result does not depend on how the value range was
    split over tasks.
    """
    running = ordered_by_key(pairs, PAIR, ["value"], sums=["cur", "prev"], ahead="value")
    gap = F.abs(F.col("cur_running") / F.col("cur_total")
                - F.col("prev_running") / F.col("prev_total"))
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    return running.groupBy(*PAIR).agg(
        F.sum(gap * step).alias("wasserstein_distance"), F.max(gap).alias("ks_stat"))


def _categorical(pairs: DataFrame) -> DataFrame:
    """Chi-squared statistic of the table category x window against equal shares."""
    all_rows = F.col("cur_total") + F.col("prev_total")
    seen = F.col("cur") + F.col("prev")

    def part(count: str, total: str):
        expected = seen * F.col(total) / all_rows
        return F.pow(F.col(count) - expected, 2) / expected

    return pairs.groupBy(*PAIR).agg(
        F.sum(part("cur", "cur_total") + part("prev", "prev_total")).alias("chi_squared_stat"))


def drift(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
          ts: str | None = None, width: str = "1 day",
          baseline: DataFrame | None = None) -> DataFrame:
    """Drift per column: each window against the one before it, or all rows against a baseline."""
    if (ts is None) == (baseline is None):
        raise ValueError("give either a time column or a baseline table")
    whole = F.lit(None).cast("timestamp_ntz")
    window = whole if ts is None else F.window(ts, width)["start"]

    def pairs(columns: Sequence[str], kind: str) -> DataFrame:
        counts = _counts(df, columns, kind, window)
        if baseline is None:
            return _pairs(counts)
        return _against(counts, _counts(baseline, columns, kind, whole))

    none = F.lit(None).cast("double")
    parts = []
    if numeric:
        parts.append(_numeric(pairs(numeric, "double")).withColumn("chi_squared_stat", none))
    if categorical:
        parts.append(_categorical(pairs(categorical, "string")).select(
            *PAIR, none.alias("wasserstein_distance"), none.alias("ks_stat"), "chi_squared_stat"))
    result = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    kind = CONSECUTIVE if baseline is None else BASELINE
    return result.withColumn("drift_type", F.lit(kind)).select(
        "window_start", "column_name", "drift_type", "wasserstein_distance", "ks_stat",
        "chi_squared_stat")
