"""Data quality, drift, alerts, contracts, row changes and snapshots."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F, types as T

from checks.basics import OLD_SQL, until_2000
from checks.registry import query
from lakewarden.operators import alerts, quality, sketches
from lakewarden.operators.aggregates import windowed_metrics
from lakewarden.operators.contract import rename_candidates, schema_diff
from lakewarden.operators.drift import drift
from lakewarden.operators.profile import profile, worst_window
from lakewarden.operators.sets import delete, insert, update, upsert
from lakewarden.plans import flow_events, retail
from lakewarden.plans.views import ORDERS_AS_OF
from lakewarden.session import fresh_dir
from lakewarden.sources import tables
from lakewarden.sources.versions import Versioned

DAY = "2001-08-02"


# -- expectations -------------------------------------------------------------------------------

def report_sql(checks, view: str, dataset: str) -> str:
    condition = {r.name: r.condition.replace("_rescued_data", "rescued") for r in checks}
    parts = [
        f"SELECT '{r.name}' AS name, '{dataset}' AS dataset, '{r.action}' AS action, count(*)"
        f" FILTER (coalesce({condition[r.name]}, false)) AS passed_records, count(*) FILTER (NOT"
        f" coalesce({condition[r.name]}, false)) AS failed_records FROM {view}" for r in checks]
    return " UNION ALL ".join(parts)


WARN_RULES = [*quality.BRONZE_RULES, quality.reasonable_date(DAY)]


@query("k01_expect_warn", report_sql(WARN_RULES, "v_dirty", "bronze"))
def k01(lake):
    return quality.expectation_report(lake.dirty_orders(), WARN_RULES, "bronze")


@query("k02_expect_drop", "SELECT * EXCLUDE (rescued), rescued AS _rescued_data FROM"
       " v_dirty_silver", "unit_price")
def k02(lake):
    kept, _ = quality.expect(lake.dirty_orders(), quality.SILVER_RULES)
    return kept


@query("k03_expect_fail",
       "SELECT 'strict' AS call, false AS written, count(*) AS row_count FROM v_dirty UNION ALL"
       " SELECT 'clean', true, count(*) FROM v_dirty_silver")
def k03(lake):
    dirty = lake.dirty_orders()
    strict = quality.rules({"positive_quantity": "quantity > 0"}, quality.FAIL)
    out = None
    for name, rows in (("strict", dirty), ("clean", quality.apply_drops(
            dirty, quality.SILVER_RULES))):
        try:
            quality.require(rows, strict)
            written = True
        except quality.ExpectationError:
            written = False
        row = rows.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("call"), F.lit(written).alias("written"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("k04_bulk_rules", report_sql([*quality.SILVER_RULES, *WARN_RULES], "v_dirty", "orders"))
def k04(lake):
    return quality.expectation_report(lake.dirty_orders(), [*quality.SILVER_RULES, *WARN_RULES],
                                      "orders")


@query("k05_expectation_results", "SELECT * FROM v_expectations")
def k05(lake):
    return flow_events.expectation_results(lake.event_log())


@query("k05_expectation_totals",
       "SELECT expectation_name, dataset, CAST(sum(passed_records) AS BIGINT) AS passed_records,"
       " CAST(sum(failed_records) AS BIGINT) AS failed_records FROM v_expectations GROUP BY ALL")
def k05_totals(lake):
    return flow_events.expectation_totals(lake.event_log())


@query("k06_quality_layers",
       "SELECT 'bronze' AS layer, count(*) AS row_count FROM v_dirty UNION ALL SELECT 'silver',"
       " count(*) FROM v_dirty_silver UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT"
       " order_date, channel FROM v_dirty_silver) UNION ALL SELECT 'dropped', (SELECT count(*)"
       " FROM v_dirty) - (SELECT count(*) FROM v_dirty_silver)")
def k06(lake):
    return quality.dq_layers(lake.dirty_orders(), DAY).counts()


# -- profiles -----------------------------------------------------------------------------------

PROFILED = {"product_id": "bigint", "warehouse": "string", "quantity_change": "int"}


def profile_sql(column: str, kind: str, windowed: bool) -> str:
    value = f"CAST({column} AS DOUBLE)"
    numeric = kind != "string"

    def only(sql: str, cast: str = "DOUBLE") -> str:
        return sql if numeric else f"CAST(NULL AS {cast})"

    window = ("date_trunc('day', event_timestamp)::TIMESTAMP AS window_start,"
              " (date_trunc('day', event_timestamp) + INTERVAL 1 DAY)::TIMESTAMP AS window_end,")
    return (
        f"SELECT {window if windowed else ''} '{column}' AS column_name, '{kind}' AS data_type,"
        f" count(*) AS num_rows, count(*) FILTER ({column} IS NULL) AS num_nulls,"
        f" count(*) FILTER ({column} IS NULL) * 100.0::DOUBLE / count(*) AS null_percentage,"
        f" {only(f'count(*) FILTER ({column} = 0)' if numeric else '', 'BIGINT')} AS num_zeros,"
        f" count(DISTINCT {column}) AS distinct_count, {only(f'min({value})' if numeric else '')} AS min,"
        f" {only(f'max({value})' if numeric else '')} AS max,"
        f" {only(f'avg({value})' if numeric else '')} AS mean,"
        f" {only(f'stddev({value})' if numeric else '')} AS stddev,"
        f" {only(f'quantile_disc({value}, 0.25)' if numeric else '')} AS percentile_25,"
        f" {only(f'quantile_disc({value}, 0.75)' if numeric else '')} AS percentile_75"
        " FROM v_inventory" + (" GROUP BY ALL" if windowed else ""))


def profiles_sql(windowed: bool) -> str:
    # Grouping by the constant labels as well is harmless.
    return " UNION ALL ".join(profile_sql(c, k, windowed) for c, k in PROFILED.items())


PROFILE_DOUBLES = "null_percentage min max mean stddev percentile_25 percentile_75"


@query("k07_profile_by_day", profiles_sql(True), PROFILE_DOUBLES)
def k07(lake):
    return profile(lake.inventory_events(), list(PROFILED), "event_timestamp")


@query("k08_profile_snapshot", profiles_sql(False), PROFILE_DOUBLES)
def k08(lake):
    return profile(lake.inventory_events(), list(PROFILED))


MERGED_SQL = " UNION ALL ".join(
    "SELECT column_name, data_type, num_rows, num_nulls, null_percentage, num_zeros, min, max, mean, stddev,"
    f" true AS distinct_close, true AS quartiles_close FROM ({profile_sql(c, k, False)})"
    for c, k in PROFILED.items())


@query("k07_merged_profile", MERGED_SQL, "null_percentage min max mean stddev")
def k07_merged(lake):
    # The state of every day is stored; the profile is merged from it and held against the rows.
    events, path = lake.inventory_events(), fresh_dir(lake.spark, "state")
    sketches.store_days(sketches.daily_state(events, list(PROFILED), "event_timestamp"), path, NOON)
    found = sketches.measured(sketches.merged(sketches.read_days(lake.spark, path)))
    exact = events.agg(*[F.countDistinct(c).alias(c) for c in PROFILED]) \
        .unpivot([], list(PROFILED), "column_name", "exact")
    ranks = None
    for c, kind in PROFILED.items():
        off = F.lit(0.0)
        if kind != "string":
            for share, name in ((0.25, "percentile_25"), (0.75, "percentile_75")):
                q = found.filter(F.col("column_name") == c).select(name).scalar()
                below, upto = F.count_if(F.col(c) < q) / F.count(c), F.count_if(F.col(c) <= q) / F.count(c)
                off = F.greatest(off, below - share, share - upto)
        row = events.agg(off.alias("off")).select(F.lit(c).alias("column_name"), "off")
        ranks = row if ranks is None else ranks.unionByName(row)
    near = F.abs(F.col("distinct_count") / F.col("exact") - 1) < 5 * sketches.DISTINCT_ERROR
    return found.join(exact, "column_name").join(ranks, "column_name").select(
        "column_name", "data_type", "num_rows", "num_nulls", "null_percentage", "num_zeros", "min", "max", "mean",
        "stddev", near.alias("distinct_close"), (F.col("off") <= 2 * sketches.rank_error()).alias("quartiles_close"))


@query("k14_stored_worst_window",
       "SELECT date_trunc('day', order_timestamp)::TIMESTAMP AS window_start, 'customer_id' AS"
       " column_name, count(*) FILTER (customer_id IS NULL) * 100.0::DOUBLE / count(*) AS"
       " null_percentage, count(*) FILTER (customer_id IS NULL) AS num_nulls FROM v_orders GROUP"
       " BY 1 ORDER BY null_percentage DESC, window_start LIMIT 1", "null_percentage")
def k14_stored(lake):
    path = fresh_dir(lake.spark, "state")
    state = sketches.daily_state(lake.orders(), ["customer_id"], "order_timestamp")
    sketches.store_days(state, path, NOON)
    return worst_window(sketches.daily_profile(sketches.read_days(lake.spark, path)), "customer_id")


@query("d06_custom_metric",
       "SELECT date_trunc('day', order_timestamp)::TIMESTAMP AS window_start, avg(CASE WHEN"
       " quantity < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_negative_quantity FROM v_orders"
       " GROUP BY 1", "pct_negative_quantity")
def d06(lake):
    return windowed_metrics(lake.orders(), "order_timestamp", {
        "pct_negative_quantity": "avg(CASE WHEN quantity < 0 THEN 1.0D ELSE 0.0D END)"})


METRICS = {
    "pct_negative_quantity": "avg(CASE WHEN quantity < 0 THEN 1.0D ELSE 0.0D END)",
    "pct_future_orders": "avg(CASE WHEN order_timestamp > TIMESTAMP_NTZ '2001-08-02 00:00:00'"
                         " THEN 1.0D ELSE 0.0D END)",
}


@query("k13_custom_metrics",
       "SELECT date_trunc('day', order_timestamp)::TIMESTAMP AS window_start, avg(CASE WHEN"
       " quantity < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_negative_quantity,"
       " avg(CASE WHEN order_timestamp > TIMESTAMP '2001-08-02' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE"
       " END) AS pct_future_orders FROM v_orders GROUP BY 1",
       "pct_negative_quantity pct_future_orders")
def k13(lake):
    return windowed_metrics(lake.orders(), "order_timestamp", METRICS)


@query("k14_worst_window",
       "SELECT date_trunc('day', order_timestamp)::TIMESTAMP AS window_start, 'customer_id' AS"
       " column_name, count(*) FILTER (customer_id IS NULL) * 100.0::DOUBLE / count(*) AS"
       " null_percentage, count(*) FILTER (customer_id IS NULL) AS num_nulls FROM v_orders GROUP"
       " BY 1 ORDER BY null_percentage DESC, window_start LIMIT 1", "null_percentage")
def k14(lake):
    return worst_window(profile(lake.orders(), ["customer_id"], "order_timestamp"), "customer_id")


@query("k09_freshness",
       "SELECT 'daily_sales' AS name, TIMESTAMP '2001-08-01 22:30:00' AS last_refresh, 90::BIGINT"
       " AS minutes_since_refresh, 'FRESH' AS status UNION ALL SELECT 'product_performance',"
       " TIMESTAMP '2001-08-01 12:00:00', 720::BIGINT, 'AGING' UNION ALL SELECT 'channel_status',"
       " TIMESTAMP '2001-07-30 00:00:00', 4320::BIGINT, 'STALE'")
def k09(lake):
    root = fresh_dir(lake.spark, "stored")
    reports = {
        "daily_sales": (retail.daily_sales(lake.orders()), 1.5),
        "product_performance": (
            retail.product_performance(lake.products(), lake.order_lines()), 12),
        "channel_status": (retail.channel_status(lake.orders()), 72)}
    stored = {name: tables.refresh(df, f"{root}/{name}", ORDERS_AS_OF - timedelta(hours=age))
              for name, (df, age) in reports.items()}
    return tables.freshness(stored, ORDERS_AS_OF)


@query("k09_refresh_parts",
       "SELECT date_trunc('month', order_timestamp)::DATE AS month, region, count(*) AS"
       " order_count, sum(total_amount) AS total_revenue, TIMESTAMP '2001-08-02' - CASE WHEN"
       " order_timestamp < TIMESTAMP '2001-07-01' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY"
       " END AS _last_refreshed FROM v_orders GROUP BY ALL", "total_revenue")
def k09_parts(lake):
    path = fresh_dir(lake.spark, "by-month")
    orders = lake.orders()

    def monthly(rows):
        month = F.trunc(F.to_date("order_timestamp"), "month").alias("month")
        return rows.groupBy(month, "region").agg(
            F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"))

    # First all months, with wrong recent ones; then the recent months again.
    recent = F.col("order_timestamp") >= F.lit("2001-07-01").cast("timestamp_ntz")
    wrong = orders.withColumn("total_amount", F.when(recent, 0.0).otherwise(F.col("total_amount")))
    tables.refresh_parts(monthly(wrong), path, "month", ORDERS_AS_OF - timedelta(days=1))
    return tables.refresh_parts(monthly(orders.filter(recent)), path, "month", ORDERS_AS_OF)


# -- drift --------------------------------------------------------------------------------------

def numeric_drift_sql(column: str) -> str:
    return f"""
    SELECT day AS window_start, '{column}' AS column_name, 'CONSECUTIVE' AS drift_type,
           sum(abs(d) * coalesce(next_v - v, 0)) AS wasserstein_distance, max(abs(d)) AS ks_stat,
           CAST(NULL AS DOUBLE) AS chi_squared_stat
    FROM (SELECT *, sum(cur) OVER w / ct::DOUBLE - sum(prev) OVER w / pt::DOUBLE AS d,
                 lead(v) OVER (PARTITION BY day ORDER BY v) AS next_v
          FROM (SELECT t.day, t.ct, t.pt, h.v, sum(CASE WHEN h.day = t.day THEN n ELSE 0 END) AS cur,
                       sum(CASE WHEN h.day = t.before THEN n ELSE 0 END) AS prev
                FROM (SELECT day, sum(n) AS ct, lag(day) OVER (ORDER BY day) AS before,
                             lag(sum(n)) OVER (ORDER BY day) AS pt
                      FROM h_{column} GROUP BY day) AS t
                JOIN h_{column} AS h ON h.day IN (t.day, t.before)
                WHERE t.before IS NOT NULL GROUP BY ALL)
          WINDOW w AS (PARTITION BY day ORDER BY v ROWS UNBOUNDED PRECEDING))
    GROUP BY day"""


def hist_sql(column: str, kind: str) -> str:
    return (f"h_{column} AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, CAST({column} AS"
            f" {kind}) AS v, count(*) AS n FROM events GROUP BY ALL)")


DRIFT_SQL = f"""
    SELECT * FROM (WITH {hist_sql('value', 'DOUBLE')}, {hist_sql('user_id', 'DOUBLE')},
         {hist_sql('event_type', 'VARCHAR')}
    {numeric_drift_sql('value')} UNION ALL {numeric_drift_sql('user_id')} UNION ALL
    SELECT day, 'event_type', 'CONSECUTIVE', NULL, NULL,
           sum(power(cur - e1, 2) / e1 + power(prev - e2, 2) / e2)
    FROM (SELECT *, (cur + prev) * ct::DOUBLE / (ct + pt) AS e1,
                 (cur + prev) * pt::DOUBLE / (ct + pt) AS e2
          FROM (SELECT t.day, t.ct, t.pt, h.v, sum(CASE WHEN h.day = t.day THEN n ELSE 0 END) AS cur,
                       sum(CASE WHEN h.day = t.before THEN n ELSE 0 END) AS prev
                FROM (SELECT day, sum(n) AS ct, lag(day) OVER (ORDER BY day) AS before,
                             lag(sum(n)) OVER (ORDER BY day) AS pt
                      FROM h_event_type GROUP BY day) AS t
                JOIN h_event_type AS h ON h.day IN (t.day, t.before)
                WHERE t.before IS NOT NULL GROUP BY ALL))
    GROUP BY day)"""
DRIFT_DOUBLES = "wasserstein_distance ks_stat chi_squared_stat"


@query("k10_drift", DRIFT_SQL, DRIFT_DOUBLES)
def k10(lake):
    return drift(lake.table("events"), ["value", "user_id"], ["event_type"], "ts")


@query("k11_drift_ranking",
       f"SELECT window_start, column_name, ks_stat FROM ({DRIFT_SQL}) WHERE ks_stat IS NOT NULL"
       " ORDER BY ks_stat DESC, window_start, column_name LIMIT 20", "ks_stat")
def k11(lake):
    report = drift(lake.table("events"), ["value", "user_id"], ts="ts")
    return report.select("window_start", "column_name", "ks_stat").orderBy(
        F.desc_nulls_last("ks_stat"), "window_start", "column_name").limit(20)


@query("k12_chi_squared",
       f"SELECT window_start, chi_squared_stat FROM ({DRIFT_SQL}) WHERE column_name ="
       " 'event_type'", "chi_squared_stat")
def k12(lake):
    return drift(lake.table("events"), categorical=["event_type"], ts="ts").select(
        "window_start", "chi_squared_stat")


@query("k10_drift_baseline",
       "SELECT CAST(NULL AS TIMESTAMP) AS window_start, 'value' AS column_name, 'BASELINE' AS"
       " drift_type, sum(abs(d) * coalesce(next_v - v, 0)) AS wasserstein_distance, max(abs(d)) AS"
       " ks_stat, CAST(NULL AS DOUBLE) AS chi_squared_stat FROM (SELECT v, sum(cur) OVER w / (SELECT"
       " count(*) FROM events)::DOUBLE - sum(prev) OVER w / (SELECT count(*) FROM events WHERE ts <"
       " TIMESTAMP '2024-01-10')::DOUBLE AS d, lead(v) OVER (ORDER BY v) AS next_v FROM (SELECT"
       " value AS v, count(*) AS cur, count(*) FILTER (ts < TIMESTAMP '2024-01-10') AS prev FROM"
       " events GROUP BY value) WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING))",
       "wasserstein_distance ks_stat")
def k10_baseline(lake):
    events = lake.table("events")
    early = events.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    return drift(events, ["value"], baseline=early)


# -- alerts -------------------------------------------------------------------------------------

NOON = datetime(2024, 1, 29, 12)
USAGE_DAY = datetime(2001, 7, 1)


def alert_sql(name: str, value: str, op: str, threshold: float, at: datetime) -> str:
    return (f"SELECT '{name}' AS alert, CAST(v AS DOUBLE) AS value, '{op}' AS op,"
            f" {threshold}::DOUBLE AS threshold, CASE WHEN v {op} {threshold} THEN 'TRIGGERED'"
            f" ELSE 'OK' END AS status, TIMESTAMP '{at}' AS evaluated_at FROM ({value}) AS t(v)")


ALERT_SQL = " UNION ALL ".join([
    alert_sql("failed_jobs", "SELECT count(*) FROM v_runs WHERE result_state = 'FAILED' AND"
              " period_start_time >= TIMESTAMP '2024-01-29 11:00:00'", ">", 0, NOON),
    alert_sql("null_customer", "SELECT max(p) FROM (SELECT count(*) FILTER (customer_id IS NULL) *"
              " 100.0::DOUBLE / count(*) AS p, date_trunc('day', order_timestamp) + INTERVAL 1 DAY"
              " AS e FROM v_orders GROUP BY date_trunc('day', order_timestamp)) WHERE e >="
              " TIMESTAMP '2024-01-26 12:00:00'", ">", 5, NOON),
    alert_sql("queue_wait", "SELECT avg(waiting_at_capacity_duration_ms) FROM v_history WHERE"
              " start_time >= TIMESTAMP '2024-01-29 11:30:00' AND"
              " waiting_at_capacity_duration_ms > 0", ">", 30000, NOON),
    alert_sql("units_today", "SELECT sum(usage_quantity) FROM v_usage WHERE usage_date ="
              " DATE '2024-01-29'", ">", 100, NOON),
    alert_sql("denied_today", "SELECT count(*) FROM v_audit WHERE status_code <> 200 AND"
              " event_date = DATE '2024-01-29'", ">", 0, NOON),
    alert_sql("null_keys", "SELECT count(*) FROM v_orders WHERE customer_id IS NULL AND"
              " order_timestamp >= TIMESTAMP '2024-01-28 12:00:00'", ">", 0, NOON),
    alert_sql("hours_stale", "SELECT trunc(epoch(TIMESTAMP '2024-01-29 12:00:00' - max(ts)) / 3600)"
              " FROM events", ">=", 1, NOON),
    alert_sql("row_count_anomaly", "SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-28 12:00:00')"
              " / (count(*) FILTER (ts < TIMESTAMP '2024-01-28 12:00:00') / 7::DOUBLE) FROM events"
              " WHERE ts >= TIMESTAMP '2024-01-21 12:00:00' AND ts < TIMESTAMP"
              " '2024-01-29 12:00:00'", "<", 0.5, NOON),
])


def alert_set(lake):
    events = lake.table("events")
    profiles = profile(lake.orders(), ["customer_id"], "order_timestamp")
    return [
        alerts.Alert("failed_jobs", lambda: alerts.failed_jobs(lake.job_runs(), NOON), ">", 0),
        alerts.Alert("null_customer", lambda: alerts.null_rate(profiles, "customer_id", NOON),
                     ">", 5),
        alerts.Alert("queue_wait", lambda: alerts.queue_wait(lake.query_history(), NOON), ">",
                     30_000),
        alerts.Alert("units_today", lambda: alerts.units_today(lake.usage(), NOON), ">", 100),
        alerts.Alert("denied_today", lambda: alerts.denied_today(lake.audit(), NOON), ">", 0),
        alerts.Alert("null_keys", lambda: alerts.null_keys(lake.orders(), NOON), ">", 0),
        alerts.Alert("hours_stale", lambda: alerts.hours_stale(events, "ts", NOON), ">=", 1),
        alerts.Alert("row_count_anomaly", lambda: alerts.row_count_ratio(events, "ts", NOON), "<",
                     0.5),
    ]


@query("k16_alert_set", ALERT_SQL, "value threshold")
def k16(lake):
    return alerts.evaluate(alert_set(lake), NOON, lake.table("region"))


@query("k15_alert_history",
       f"SELECT alert, status, evaluated_at FROM ({ALERT_SQL}) UNION ALL SELECT 'broken', 'ERROR',"
       f" TIMESTAMP '{NOON}'")
def k15(lake):
    path = fresh_dir(lake.spark, "alerts")
    broken = alerts.Alert("broken", lambda: lake.orders().select("no_such_column"), ">", 0)
    for group in (alert_set(lake), [broken]):
        status = alerts.evaluate(group, NOON, lake.table("region"))
        tables.write_table(status.coalesce(1), path, "append")
    return lake.spark.read.parquet(path).select("alert", "status", "evaluated_at")


# -- contract -----------------------------------------------------------------------------------

EXPECTED = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("quantity", T.LongType()), T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()), T.StructField("channel", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("order_timestamp", T.TimestampNTZType()),
    T.StructField("region", T.StringType())])


@query("k17_contract",
       "SELECT t.*, CASE WHEN column_name = 'total_amount' THEN 'order_total' END AS candidate,"
       " CASE WHEN column_name = 'total_amount' THEN (SELECT count(DISTINCT total_amount)::DOUBLE /"
       " count(DISTINCT total_amount) FROM v_orders) END AS overlap FROM (VALUES"
       " ('order_id', 'bigint', 'bigint', 'ok'), ('customer_id', 'bigint', 'bigint', 'ok'),"
       " ('quantity', 'bigint', 'int', 'type_changed'), ('unit_price', 'double', 'double', 'ok'),"
       " ('total_amount', 'double', NULL, 'missing'), ('channel', 'string', 'string', 'ok'),"
       " ('status', 'string', 'string', 'ok'),"
       " ('order_timestamp', 'timestamp_ntz', 'timestamp_ntz', 'ok'),"
       " ('region', 'string', NULL, 'missing'), ('order_total', NULL, 'double', 'added'),"
       " ('currency', NULL, 'string', 'added'))"
       " AS t(column_name, expected_type, actual_type, status)", "overlap")
def k17(lake):
    new = lake.orders_v2()
    found = rename_candidates(lake.orders(), new).select(
        F.col("missing_column").alias("column_name"), F.col("added_column").alias("candidate"),
        "overlap")
    return schema_diff(EXPECTED, new).join(found, "column_name", "left")


# -- row changes --------------------------------------------------------------------------------

SOURCE_SQL = ("SELECT * REPLACE ('Returned' AS status, total_amount * 2 AS total_amount) FROM"
              " v_orders WHERE status = 'P'")


@query("k18_upsert",
       f"SELECT * FROM ({SOURCE_SQL}) UNION ALL SELECT * FROM ({OLD_SQL}) AS t WHERE order_id NOT"
       f" IN (SELECT order_id FROM ({SOURCE_SQL}))", "unit_price total_amount")
def k18(lake):
    orders = lake.orders()
    source = orders.filter("status = 'P'").withColumns(
        {"status": F.lit("Returned"), "total_amount": F.col("total_amount") * 2})
    return upsert(until_2000(orders), source, ["order_id"])


def from_2001(orders):
    return orders.filter(F.col("order_timestamp") >= F.lit("2001-01-01").cast("timestamp_ntz"))


@query("k19_insert_update_delete",
       "SELECT * REPLACE (CASE WHEN status = 'F' THEN 'Cancelled' ELSE status END AS status, CASE"
       " WHEN status = 'F' THEN 0 ELSE total_amount END AS total_amount) FROM v_orders WHERE NOT"
       " coalesce(customer_id < 100 AND region = 'APAC', false)", "unit_price total_amount")
def k19(lake):
    orders = lake.orders()
    rows = insert(until_2000(orders), from_2001(orders))
    rows = update(rows, F.col("status") == "F",
                  {"status": F.lit("Cancelled"), "total_amount": F.lit(0.0)})
    return delete(rows, (F.col("customer_id") < 100) & (F.col("region") == "APAC"))


T0 = datetime(2024, 1, 1)


def hour(n):
    return T0 + timedelta(hours=n)


def versions(lake):
    """Four versions: the orders up to 2000, an insert of the rest, an update and a delete."""
    spark = lake.spark
    orders = lake.orders().select("order_id", "status", "total_amount", "order_timestamp")
    data = Versioned(fresh_dir(spark, "versions"), ("order_id",))
    data.create(until_2000(orders), hour(0))
    data.append(from_2001(orders), hour(1))
    data.update(spark, F.col("status") == "P", {"status": F.lit("Cancelled")}, hour(2))
    data.delete(spark, F.col("status") == "Cancelled", hour(3))
    return data


@query("k18_merge_files",
       f"SELECT * FROM ({SOURCE_SQL}) UNION ALL SELECT * FROM ({OLD_SQL}) AS t WHERE order_id NOT"
       f" IN (SELECT order_id FROM ({SOURCE_SQL}))", "unit_price total_amount")
def k18_files(lake):
    orders = lake.orders()
    source = orders.filter("status = 'P'").withColumns(
        {"status": F.lit("Returned"), "total_amount": F.col("total_amount") * 2})
    data = Versioned(fresh_dir(lake.spark, "merge"), ("order_id",))
    data.create(until_2000(orders), hour(0))
    data.upsert(source, hour(1))
    return data.as_of(lake.spark)


@query("k18_one_row_merge",
       "SELECT count(*) AS row_count, count(*) FILTER (order_id = (SELECT max(order_id) FROM v_orders))"
       " AS merged, 7 AS files_kept, 1 AS files_replaced FROM v_orders")
def k18_one(lake):
    spark, orders = lake.spark, lake.orders()
    data = Versioned(fresh_dir(spark, "merge"), ("order_id",))
    data.create(orders.repartitionByRange(8, "order_id"), hour(0))
    before = data.files(spark).select("file")
    top = orders.agg(F.max("order_id").alias("order_id"))
    data.upsert(orders.join(top, "order_id", "left_semi").withColumn("status", F.lit("Merged")), hour(1))
    after = data.files(spark).select("file")
    kept = before.join(after, "file", "left_semi").agg(F.count("*").cast("int").alias("v")).select("v").scalar()
    gone = before.join(after, "file", "left_anti").agg(F.count("*").cast("int").alias("v")).select("v").scalar()
    return data.as_of(spark).agg(F.count("*").alias("row_count"),
                                 F.count_if(F.col("status") == "Merged").alias("merged")) \
        .select("row_count", "merged", kept.alias("files_kept"), gone.alias("files_replaced"))


@query("k19_change_files",
       "SELECT * REPLACE (CASE WHEN status = 'F' THEN 'Cancelled' ELSE status END AS status, CASE"
       " WHEN status = 'F' THEN 0 ELSE total_amount END AS total_amount) FROM v_orders WHERE NOT"
       " coalesce(customer_id < 100 AND region = 'APAC', false)", "unit_price total_amount")
def k19_files(lake):
    spark, orders = lake.spark, lake.orders()
    data = Versioned(fresh_dir(spark, "changes"), ("order_id",))
    data.create(until_2000(orders), hour(0))
    data.append(from_2001(orders), hour(1))
    data.update(spark, F.col("status") == "F",
                {"status": F.lit("Cancelled"), "total_amount": F.lit(0.0)}, hour(2))
    data.delete(spark, (F.col("customer_id") < 100) & (F.col("region") == "APAC"), hour(3))
    return data.as_of(spark)


@query("k24_incremental_cluster",
       "SELECT event_type, count(*) AS row_count, min(ts) AS first_ts, false AS rewritten_again"
       " FROM events GROUP BY event_type")
def k24_incremental(lake):
    spark, events = lake.spark, lake.table("events")
    data = Versioned(fresh_dir(spark, "clustered"), ("event_id",), ("event_type", "ts"))
    data.create(events.filter("event_id % 2 = 0"), hour(0))
    data.cluster(spark, hour(1), 1000)
    data.append(events.filter("event_id % 2 = 1"), hour(2))
    data.cluster(spark, hour(3), 1000)
    again = data.cluster(spark, hour(4), 1000) is not None
    return data.as_of(spark).groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.min("ts").alias("first_ts")) \
        .withColumn("rewritten_again", F.lit(again))


COUNT = "SELECT count(*) FROM v_orders WHERE "
EARLY = "order_timestamp < TIMESTAMP '2001-01-01'"


@query("k20_read_past_version",
       f"SELECT 'v1' AS read, ({COUNT} true) AS row_count UNION ALL SELECT 'half past two',"
       f" ({COUNT} true) UNION ALL SELECT 'now', ({COUNT} status <> 'P') UNION ALL SELECT"
       f" 'deleted', ({COUNT} status = 'P')")
def k20(lake):
    data = versions(lake)
    v1 = data.as_of(lake.spark, version=1)
    then = data.as_of(lake.spark, ts=T0 + timedelta(hours=2, minutes=30))
    now = data.as_of(lake.spark)
    lost = v1.join(now, "order_id", "left_anti")
    out = None
    for name, df in (("v1", v1), ("half past two", then), ("now", now), ("deleted", lost)):
        row = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("read"),
                                                             "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("k21_restore", "SELECT order_id, status, total_amount, order_timestamp FROM v_orders",
       "total_amount")
def k21(lake):
    data = versions(lake)
    data.restore(lake.spark, 1, hour(9))
    return data.as_of(lake.spark)


@query("k22_history",
       "SELECT * FROM (VALUES (0::BIGINT, TIMESTAMP '2024-01-01 00:00:00', 'CREATE'),"
       " (1::BIGINT, TIMESTAMP '2024-01-01 01:00:00', 'INSERT'),"
       " (2::BIGINT, TIMESTAMP '2024-01-01 02:00:00', 'UPDATE'),"
       " (3::BIGINT, TIMESTAMP '2024-01-01 03:00:00', 'DELETE'))"
       " AS t(version, committed_at, operation) JOIN (SELECT 0::BIGINT AS version,"
       f" ({COUNT} {EARLY}) AS row_count, NULL::BIGINT AS rows_added, NULL::BIGINT AS"
       f" rows_removed, NULL::BIGINT AS rows_changed UNION ALL SELECT 1, ({COUNT} true), ({COUNT}"
       f" NOT ({EARLY})), 0, 0 UNION ALL SELECT 2, ({COUNT} true), 0, 0, ({COUNT} status = 'P')"
       f" UNION ALL SELECT 3, ({COUNT} status <> 'P'), 0, ({COUNT} status = 'P'), 0)"
       " USING (version)")
def k22(lake):
    return versions(lake).history(lake.spark)


@query("k26_expired", "SELECT * FROM (VALUES (0::BIGINT), (1::BIGINT)) AS t(version)"
       " WHERE EXISTS (SELECT 1 FROM orders)")
def k26(lake):
    # Seven days and two and a half hours after the first version: two versions are too old.
    now = T0 + timedelta(days=7, hours=1, minutes=30)
    return versions(lake).expired(lake.spark, now).select("version").distinct()


@query("k29_completion_log",
       "SELECT 'user' || user_id AS username, event_type AS notebook_name, max(ts) AS completed_at"
       " FROM events GROUP BY ALL")
def k29(lake):
    done = lake.table("events").groupBy(
        F.concat(F.lit("user"), "user_id").alias("username"),
        F.col("event_type").alias("notebook_name"))
    first = done.agg(F.min("ts").alias("completed_at"))
    last = done.agg(F.max("ts").alias("completed_at"))
    return upsert(first.filter("notebook_name <> 'click'"), last, ["username", "notebook_name"])


