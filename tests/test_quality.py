"""Expectations, profiles, drift, alerts and contracts."""

from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from lakewarden.operators import alerts, quality
from lakewarden.operators.aggregates import windowed_metrics
from lakewarden.operators.contract import rename_candidates, schema_diff
from lakewarden.operators.drift import drift
from lakewarden.operators.profile import profile, worst_window
from tests.conftest import plan_of, rows

SAMPLE = [
    ("ORD-001", "CUST-001", "PROD-001", 2, 79.99, "Web", "2024-06-15"),
    ("ORD-002", None, "PROD-002", 1, 49.99, "Mobile App", "2024-06-15"),
    ("ORD-003", "CUST-003", "PROD-003", -5, 99.99, "Retail Store", "2024-06-15"),
    ("ORD-004", "CUST-004", "PROD-004", 1, 0.0, "Web", "2024-06-15"),
    ("ORD-005", "CUST-005", "PROD-005", 3, 59.99, "Marketplace", "2024-06-15"),
    ("ORD-006", "CUST-006", None, 2, 89.99, "Web", "2024-06-15"),
    ("ORD-007", "CUST-007", "PROD-007", 1, 129.99, "Mobile App", "2099-12-31"),
    ("ORD-008", "CUST-008", "PROD-008", 4, 39.99, "Web", "2024-06-16"),
    ("ORD-009", "CUST-009", "PROD-009", 2, 149.99, "Retail Store", "2024-06-16"),
    ("ORD-010", "CUST-010", "PROD-010", 1, -25.0, "Web", "2024-06-16"),
]
SCHEMA = ("order_id string, customer_id string, product_id string, quantity int,"
          " unit_price double, channel string, order_date string")


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, SCHEMA).withColumn(
        "order_date", F.col("order_date").cast("date"))


def test_layers_keep_ten_five_and_count_the_dropped(sample):
    layers = quality.dq_layers(sample, "2025-01-01")
    assert dict(rows(layers.counts())) == {"bronze": 10, "silver": 5, "gold": 5, "dropped": 5}
    assert "ORD-007" in {r["order_id"] for r in layers.silver.collect()}  # warned, kept


def test_report_counts_null_results_as_failed(sample):
    report = quality.expectation_report(
        sample, quality.rules({"known": "customer_id <> 'CUST-001'"}), "orders")
    assert rows(report) == [("known", "orders", "warn", 8, 2)]


def test_counters_are_filled_while_rows_are_processed(sample):
    kept, seen = quality.expect(sample, [*quality.SILVER_RULES,
                                         quality.reasonable_date("2025-01-01")])
    assert kept.count() == 5
    assert seen.get["rows"] == 10
    assert seen.get["failed_valid_customer"] == 1
    assert seen.get["failed_positive_price"] == 2
    assert seen.get["failed_reasonable_date"] == 1


def test_fail_rule_stops_before_the_write(sample):
    strict = quality.rules({"positive_quantity": "quantity > 0"}, quality.FAIL)
    with pytest.raises(quality.ExpectationError, match="positive_quantity"):
        quality.require(sample, strict)
    assert quality.require(sample.filter("quantity > 0"), strict).count() == 9


def test_fail_rule_ends_the_write(spark, sample, tmp_path):
    checks = [*quality.rules({"has_customer": "customer_id IS NOT NULL"}, quality.DROP),
              *quality.rules({"positive_quantity": "quantity > 0"}, quality.FAIL)]
    kept, _ = quality.expect(sample, checks)
    with pytest.raises(Exception, match="violated expectation: positive_quantity"):
        kept.write.parquet(str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").glob("part-*"))
    good = sample.filter("quantity > 0")
    kept, seen = quality.expect(good, checks)
    assert kept.count() == good.filter("customer_id IS NOT NULL").count()
    assert seen.get["failed_positive_quantity"] == 0


def test_fail_rule_stops_the_stream_batch(spark, sample, tmp_path):
    checks = quality.rules({"positive_quantity": "quantity > 0"}, quality.FAIL)

    def run(rows, name):
        rows.write.parquet(str(tmp_path / f"{name}-in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / f"{name}-in"))
        quality.expect_stream(stream, checks, "seen").writeStream.trigger(availableNow=True).option(
            "checkpointLocation", str(tmp_path / f"{name}-cp")).start(
            str(tmp_path / f"{name}-out"), format="parquet").awaitTermination()

    run(sample.filter("quantity > 0"), "good")
    assert spark.read.parquet(str(tmp_path / "good-out")).count() == 9
    with pytest.raises(Exception, match="violated expectation: positive_quantity"):
        run(sample, "bad")
    assert not list((tmp_path / "bad-out").glob("_spark_metadata/0"))


def timed(spark, values):
    """(day of month, value) pairs as a table with a time column."""
    data = [(datetime(2024, 1, d, 12), v) for d, v in values]
    return spark.createDataFrame(data, "ts timestamp_ntz, x double")


def test_profile_by_day(spark):
    df = timed(spark, [(1, 0.0), (1, 4.0), (1, None), (2, 5.0)]).withColumn("s", F.lit("a"))
    got = {(r["window_start"].day, r["column_name"]): r for r in
           profile(df, ["x", "s"], "ts").collect()}
    first = got[1, "x"]
    assert (first["num_rows"], first["num_nulls"], first["num_zeros"], first["distinct_count"]
            ) == (3, 1, 1, 2)
    assert first["null_percentage"] == pytest.approx(100 / 3)
    assert (first["min"], first["max"], first["mean"]) == (0.0, 4.0, 2.0)
    assert first["stddev"] == pytest.approx(np.std([0, 4], ddof=1))
    assert got[2, "s"]["mean"] is None and got[2, "s"]["distinct_count"] == 1


def test_profile_whole_table_exact_and_approximate(spark):
    df = timed(spark, [(d, float(d % 3)) for d in range(1, 20)])
    exact, approx = profile(df, ["x"]).first(), profile(df, ["x"], approx=True).first()
    assert exact["distinct_count"] == approx["distinct_count"] == 3
    assert exact["percentile_25"] == 0.0 and exact["percentile_75"] == 2.0


def test_profile_sketches_do_not_pass_through_the_distinct_expansion(spark):
    plan = plan_of(profile(timed(spark, [(1, 1.0)]), ["x", "ts"], "ts"))
    # The aggregate with percentiles reads rows directly, not the expanded ones.
    sketch = plan.index("partial_percentile_approx")
    assert "Expand" not in plan[sketch:plan.index("Scan ExistingRDD", sketch)]


def test_worst_window(spark):
    df = timed(spark, [(1, None), (1, 1.0), (2, None), (3, 1.0)])
    worst = worst_window(profile(df, ["x"], "ts"), "x").first()
    assert worst["window_start"].day == 2 and worst["null_percentage"] == 100.0


def test_custom_metric(spark):
    df = timed(spark, [(1, -1.0), (1, 1.0), (2, 1.0)])
    got = rows(windowed_metrics(df, "ts", {"neg": "avg(CASE WHEN x < 0 THEN 1.0 ELSE 0.0 END)"}))
    assert [float(r[1]) for r in got] == [0.5, 0.0]


def distances(a, b):
    """Both statistics from the empirical distribution functions, computed directly."""
    grid = np.unique(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    g = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return float(np.sum(np.abs(f - g)[:-1] * np.diff(grid))), float(np.max(np.abs(f - g)))


def test_identical_windows_do_not_drift(spark):
    got = drift(timed(spark, [(d, v) for d in (1, 2) for v in (1.0, 2.0, 2.0)]), ["x"], ts="ts")
    assert [tuple(r)[3:5] for r in got.collect()] == [(0.0, 0.0)]


def test_shift_moves_wasserstein_by_the_shift(spark):
    values = [1.0, 2.0, 5.0, 9.0]
    got = drift(timed(spark, [(1, v) for v in values] + [(2, v + 3) for v in values]), ["x"],
                ts="ts").first()
    assert got["wasserstein_distance"] == pytest.approx(3.0)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=30),
       st.lists(st.integers(-20, 20), min_size=1, max_size=30))
def test_drift_equals_direct_computation(spark, a, b):
    df = timed(spark, [(1, float(v)) for v in a] + [(4, float(v)) for v in b])
    got = drift(df, ["x"], ts="ts").first()
    w, ks = distances(np.array(a, float), np.array(b, float))
    assert got["wasserstein_distance"] == pytest.approx(w, abs=1e-9)
    assert got["ks_stat"] == pytest.approx(ks, abs=1e-9)


def test_drift_against_a_baseline(spark):
    now, base = timed(spark, [(1, 1.0), (2, 3.0)]), timed(spark, [(1, 1.0), (2, 2.0)])
    got = drift(now, ["x"], baseline=base).first()
    assert (got["drift_type"], got["wasserstein_distance"], got["ks_stat"]) == ("BASELINE", 0.5, 0.5)
    with pytest.raises(ValueError):
        drift(now, ["x"])


def test_chi_squared(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), c) for c in "aab"] + [(datetime(2024, 1, 2), c) for c in "abbc"],
        "ts timestamp_ntz, c string")
    table = np.array([[2, 1, 0], [1, 2, 1]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    got = drift(df, categorical=["c"], ts="ts").first()
    assert got["chi_squared_stat"] == pytest.approx(((table - expected) ** 2 / expected).sum())


def test_alert_states(spark):
    one = spark.range(1)
    now = datetime(2024, 1, 1)
    checks = [
        alerts.Alert("hit", lambda: one.select(F.lit(5).alias("v")), ">", 3),
        alerts.Alert("calm", lambda: one.select(F.lit(2).alias("v")), ">", 3),
        alerts.Alert("empty", lambda: one.select(F.lit(None).cast("int").alias("v")), ">", 3),
        alerts.Alert("strict", lambda: one.select(F.lit(None).cast("int").alias("v")), ">", 3,
                     "ERROR"),
        alerts.Alert("broken", lambda: one.select("missing"), ">", 3),
    ]
    got = {r["alert"]: r["status"] for r in alerts.evaluate(checks, now, one).collect()}
    assert got == {"hit": "TRIGGERED", "calm": "OK", "empty": "OK", "strict": "ERROR",
                   "broken": "ERROR"}


def test_schema_diff_and_rename_candidates(spark):
    old = spark.createDataFrame([(1, 10.0, "x"), (2, 20.0, "y"), (3, None, "z")],
                                "id int, total_amount double, region string")
    new = spark.createDataFrame([(1, 10.0, "EUR", 7.0), (2, 21.0, "EUR", 8.0)],
                                "id long, order_total double, currency string, other double")
    expected = T.StructType(old.schema.fields)
    assert dict((r[0], r[3]) for r in rows(schema_diff(expected, new))) == {
        "id": "type_changed", "total_amount": "missing", "region": "missing",
        "order_total": "added", "currency": "added", "other": "added"}
    assert rows(rename_candidates(old, new)) == [("total_amount", "order_total", 0.5)]
    assert rows(rename_candidates(old, old)) == []
