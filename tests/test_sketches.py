"""Stored daily state against plain calculations over the rows."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from lakewarden.operators import sketches
from lakewarden.operators.profile import profile, worst_window
from lakewarden.session import fresh_dir
from tests.conftest import plan_of, rows

T0 = datetime(2024, 1, 1)
DAYS, EACH = 30, 2000


def events(spark):
    """Values around 1e9 (a plain sum of squares would lose them), nulls and zeros."""
    x = F.when(F.col("id") % 11 != 0, 1e9 + F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100)
    return spark.range(DAYS * EACH).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % DAYS).cast("int"))).alias("ts"),
        F.when(F.col("id") % 7 == 0, 0.0).otherwise(x).alias("x"), (F.col("id") % 500).cast("string").alias("name"))


def test_a_month_is_merged_from_thirty_rows(spark):
    df = events(spark)
    path = fresh_dir(spark, "test-sketches")
    sketches.store_days(sketches.daily_state(df, ["x", "name"], "ts"), path, T0)
    stored = sketches.read_days(spark, path)
    assert stored.filter("column_name = 'x'").count() == DAYS
    got = {r["column_name"]: r for r in sketches.measured(sketches.merged(stored)).collect()}
    want = {r["column_name"]: r for r in profile(df, ["x", "name"]).collect()}
    for c in ("x", "name"):
        for m in ("num_rows", "num_nulls", "num_zeros", "min", "max", "data_type"):
            assert got[c][m] == want[c][m], (c, m)
        assert abs(got[c]["distinct_count"] / want[c]["distinct_count"] - 1) < 5 * sketches.DISTINCT_ERROR
    assert abs(got["x"]["mean"] / want["x"]["mean"] - 1) < 1e-12
    assert abs(got["x"]["stddev"] / want["x"]["stddev"] - 1) < 1e-9
    values = np.sort([r[0] for r in df.filter("x is not null").select("x").collect()])
    for name, share in (("percentile_25", 0.25), ("percentile_75", 0.75)):
        low, high = np.searchsorted(values, got["x"][name], "left"), np.searchsorted(values, got["x"][name], "right")
        off = max(low / len(values) - share, share - high / len(values), 0)
        assert off <= 2 * sketches.rank_error()
    assert got["name"]["mean"] is None and got["name"]["percentile_25"] is None


def test_only_changed_days_are_replaced_and_read(spark):
    df = events(spark)
    path = fresh_dir(spark, "test-sketches")
    sketches.store_days(sketches.daily_state(df, ["x"], "ts"), path, T0)
    one = df.filter("ts = timestamp_ntz '2024-01-05'").unionByName(
        spark.createDataFrame([(datetime(2024, 1, 5), 5.0, "n")], df.schema))
    sketches.store_days(sketches.daily_state(one, ["x"], "ts"), path, T0 + timedelta(hours=1))
    stored = sketches.read_days(spark, path)
    assert stored.count() == DAYS
    assert stored.agg(F.sum("num_rows")).first()[0] == DAYS * EACH + 1
    week = sketches.read_days(spark, path, T0, T0 + timedelta(days=7))
    assert "GreaterThanOrEqual(day,2024-01-01), LessThan(day,2024-01-08)" in plan_of(week)
    assert sketches.merged(week).first()["num_rows"] == 7 * EACH + 1
    assert "Expand" not in plan_of(sketches.daily_state(df, ["x", "name"], "ts"))


def test_reports_and_alerts_read_the_state(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(days=d), None if i < 10 * d else float(i + 1000 * (d == 2))) for d in range(3) for i in range(100)],
        "ts timestamp_ntz, x double")
    state = sketches.daily_state(df, ["x"], "ts")
    worst = worst_window(sketches.daily_profile(state), "x").first()
    assert worst["window_start"] == T0 + timedelta(days=2) and worst["null_percentage"] == 20
    assert sketches.recent_null_rate(state, "x", T0 + timedelta(days=2), 1).first()[0] == 20
    drift = {r["day"].day: r for r in sketches.daily_drift(state).collect()}
    assert sorted(drift) == [2, 3]
    assert drift[3]["ks_stat"] > 0.99 and 900 < drift[3]["wasserstein_distance"] < 1100
    # Values 0 to 99 against 10 to 99: a tenth of the first lies below all of the second.
    assert abs(drift[2]["ks_stat"] - 0.1) <= 2 * sketches.rank_error() + 1 / sketches.GRID


def test_days_without_values(spark):
    df = spark.createDataFrame([(T0, None, None), (T0 + timedelta(days=1), 3.0, "a")], "ts timestamp_ntz, x double, s string")
    state = sketches.daily_state(df, ["x", "s"], "ts")
    got = {r["column_name"]: r for r in sketches.measured(sketches.merged(state)).collect()}
    assert (got["x"]["num_rows"], got["x"]["num_nulls"], got["x"]["mean"], got["x"]["percentile_25"]) == (2, 1, 3.0, 3.0)
    assert got["x"]["stddev"] is None and got["s"]["distinct_count"] == 1
    assert rows(sketches.measured(state).filter("column_name = 'x'").select("day", "distinct_count"))[0][1] == 0
    assert sketches.daily_drift(state).count() == 0
    assert sketches.merged(sketches.daily_state(df.limit(0), ["x"], "ts")).count() == 0
