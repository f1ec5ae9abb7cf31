"""Report rules on small hand-made tables."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakewarden.plans import access, capacity, cost, flow_events, jobs, queries, retail, triage
from tests.conftest import plan_of, rows

NOW = datetime(2024, 3, 31, 15)
JOBS = ("workspace_id int, job_id int, name string, creator_id int, create_time timestamp_ntz,"
        " change_time timestamp_ntz, version_id int, delete_time timestamp_ntz,"
        " tags map<string,string>")
RUNS = ("workspace_id int, job_id int, run_id int, run_type string, result_state string,"
        " termination_code string, compute_type string, period_start_time timestamp_ntz,"
        " period_end_time timestamp_ntz")


def days(n):
    return NOW - timedelta(days=n)


@pytest.fixture(scope="module")
def job_rows(spark):
    data = [
        (1, 1, "old name", 9, days(200), days(200), 1, None, {}),
        (1, 1, "busy", 9, days(200), days(100), 2, None, {"team": "a"}),
        (1, 2, "silent", 9, days(200), days(90), 1, None, {}),
        (1, 3, "never ran", 9, days(200), days(80), 1, None, {}),
        (1, 4, "deleted", 9, days(200), days(70), 1, days(60), {}),
    ]
    return spark.createDataFrame(data, JOBS)


@pytest.fixture(scope="module")
def run_rows(spark):
    def run(job, run_id, start, state, kind="JOB_RUN", seconds=60):
        return (1, job, run_id, kind, state, "SUCCESS", "SERVERLESS", start,
                start + timedelta(seconds=seconds))

    return spark.createDataFrame([
        run(1, 10, days(1), "SUCCEEDED"), run(1, 10, days(1) + timedelta(minutes=5), "FAILED"),
        run(1, 11, days(2), None), run(1, 12, days(3), "FAILED", seconds=30),
        run(2, 20, days(40), "SUCCEEDED"), run(2, 21, days(5), "SUCCEEDED", "SUBMIT_RUN"),
        run(4, 40, days(45), "SUCCEEDED"),
    ], RUNS)


def test_stale_and_idle_jobs(job_rows, run_rows):
    # Job 2 ran five days ago, but not as a job run: stale ignores it, idle reports it.
    assert {r["job_id"] for r in jobs.stale_jobs(job_rows, run_rows, NOW).collect()} == {4}
    assert [r["name"] for r in jobs.idle_jobs(job_rows, run_rows, NOW).collect()] == [
        "never ran", "silent"]


def test_retried_and_failed_runs(run_rows):
    got = {r["run_id"]: (r["retries_count"], r["reason"])
           for r in jobs.retried_runs(run_rows, NOW).collect()}
    assert got == {10: (1, "failed and retried"), 12: (0, "failed")}


def test_run_reports_use_the_current_name(job_rows, run_rows):
    assert rows(jobs.run_counts(run_rows, job_rows, "bu", NOW)) == [("busy", 4)]
    history = jobs.run_history(run_rows, job_rows, "busy", NOW).collect()
    assert sum((r["run_time"] for r in history), timedelta()) == timedelta(seconds=210)
    recent = jobs.recent_runs(run_rows, job_rows, NOW).collect()
    assert [r["duration_sec"] for r in recent if r["run_id"] == 12] == [30]
    outcome = rows(jobs.runs_by_outcome(run_rows, NOW))
    assert sum(r[3] for r in outcome) == 4


def test_failures_in_the_last_hours(job_rows, run_rows):
    got = triage.recent_failures(run_rows, job_rows, NOW, 80).collect()
    assert {(r["run_id"], r["job_name"]) for r in got} == {(10, "busy"), (12, "busy")}


USAGE = ("workspace_id int, sku_name string, usage_date date, usage_start_time timestamp_ntz,"
         " usage_quantity double, billing_origin_product string,"
         " usage_metadata struct<job_id:int,job_run_id:int,warehouse_id:string>,"
         " identity_metadata struct<run_as:string>")
PRICES = ("sku_name string, currency_code string, price_start_time timestamp_ntz,"
          " price_end_time timestamp_ntz, pricing struct<default:double>")


@pytest.fixture(scope="module")
def usage_rows(spark):
    def use(job, run, at, units, product="JOBS", who="ann"):
        return (1, "S", at.date(), at, units, product, (job, run, None), (who,))

    return spark.createDataFrame([
        use(1, 10, days(1), 2.0, who=None), use(1, 10, days(1), 3.0), use(1, 10, days(10), 1.0),
        use(2, 20, days(40), 7.0), use(1, 12, days(3), 5.0, "SQL", "bob"),
    ], USAGE)


@pytest.fixture(scope="module")
def price_rows(spark):
    return spark.createDataFrame([
        ("S", "USD", days(300), days(10), (1.0,)), ("S", "USD", days(10), None, (2.0,)),
        ("S", "EUR", days(300), None, (9.0,))], PRICES)


def test_cost_per_run(usage_rows, price_rows, run_rows):
    got = {r["run_id"]: r for r in cost.cost_per_run(usage_rows, price_rows, run_rows).collect()}
    assert (got[10]["usage_cost"], got[10]["usage_quantity"], got[10]["run_as"]) == (12.0, 6.0, "ann")
    assert got[10]["result_state"] == "FAILED"  # the state of the last period
    assert got[10]["run_end_time"] == days(1) + timedelta(minutes=6)
    assert got[20]["usage_cost"] == 7.0 and 12 not in got
    both = {r["run_id"]: r["usage_cost"] for r in
            cost.cost_per_run(usage_rows, price_rows, run_rows, closed="both").collect()}
    assert both[10] == 13.0  # the usage at the price border counts at both prices


def test_usage_reports(usage_rows, job_rows):
    mix = cost.usage_mix(usage_rows, NOW).first()
    assert (mix["days_used"], mix["total_units"], mix["avg_units_per_day"]) == (3, 11.0, 3.7)
    assert rows(cost.top_jobs(usage_rows, job_rows, NOW)) == [(1, "busy", 11.0)]
    week = triage.week_over_week(usage_rows, NOW).first()
    assert tuple(week) == (10.0, 1.0, 9.0)
    assert triage.top_user_units(usage_rows, NOW, 30).count() == 1


HISTORY = ("event_id int, account_id string, workspace_id int, statement_id string, executed_by"
           " string, statement_text string, statement_type string, execution_status string,"
           " client_application string, compute struct<warehouse_id:string>, start_time"
           " timestamp_ntz, end_time timestamp_ntz, update_time timestamp_ntz, total_duration_ms"
           " bigint, execution_duration_ms bigint, compilation_duration_ms bigint,"
           " waiting_for_compute_duration_ms bigint, waiting_at_capacity_duration_ms bigint,"
           " result_fetch_duration_ms bigint, total_task_duration_ms bigint, read_bytes bigint,"
           " written_bytes bigint, spilled_local_bytes bigint, read_rows bigint, produced_rows"
           " bigint, read_files bigint, pruned_files bigint, read_io_cache_percent bigint,"
           " from_result_cache boolean, error_message string, query_source"
           " struct<job_info:struct<job_id:string>,legacy_dashboard_id:string,dashboard_id:string,"
           "alert_id:string,notebook_id:string,sql_query_id:string,genie_space_id:string>")


@pytest.fixture(scope="module")
def statements(spark):
    def statement(i, text, minute=0, error=None, client=None, source=(None,) * 7, total=1000,
                  task=2000, warehouse="w"):
        t = NOW - timedelta(hours=1) + timedelta(minutes=minute)
        nested = ((source[0],), *source[1:])
        return (i, "a", 1, f"s{i}", "ann", text, "SELECT", "FAILED" if error else "FINISHED",
                client, (warehouse,), t, t, t, total, 600, 100, 50, 200, 50, task, 1 << 30,
                1 << 20, 1 << 21, 10, 5, 3, 1, 0, False, error, nested)

    return spark.createDataFrame([
        statement(1, '/* {"app":"dbt","node_id":"n1"} */ select 1',
                  source=("j1", "l1", None, None, None, None, None)),
        statement(2, "/* QUERY_TAG:team_a */ select 1", 1, "[BAD_THING] no", client="dbt cloud"),
        statement(3, "select */ 1 /*", 1, "no class", total=0, task=None),
        statement(4, "select 1", 30, client="Editor", source=(None,) * 6 + ("g1",)),
        statement(5, "select 1", 31, warehouse=None),
    ], HISTORY)


def test_query_model(statements):
    got = {r["statement_id"]: r for r in queries.refine_query_history(statements).collect()}
    assert set(got) == {"s1", "s2", "s3", "s4"}
    one = got["s1"]
    assert one["ReadDataAmountInGB"] == 1.0
    assert one["WrittenDataAmountInGB"] == 2**-10 and one["SpilledDataAmountInGB"] == 2**-9
    assert one["ProportionQueueTime"] == 0.25 and one["FilesPrunedProportion"] == 0.25
    assert one["TotalCPUTime_To_Execution_Time_Ratio"] == 2.0
    assert one["QueryWork"] == pytest.approx(2.15)
    assert (one["dbt_app"], one["dbt_node_id"], one["dbt_version"]) == ("dbt", "n1", "None")
    assert one["IsDBTQuery"] == "DBT Query" and one["query_source_type"] == "JOB"
    assert one["parsed_dbt_comment"] == {"app": "dbt", "node_id": "n1"}
    assert got["s2"]["raw_tagged"] == "team_a " and got["s2"]["error_type"] == "BAD_THING"
    assert got["s2"]["IsDBTQuery"] == "DBT Query"
    assert got["s3"]["dbt_metadata_json"] is None and got["s3"]["error_type"] == "NO ERROR"
    assert got["s3"]["TotalCPUTime_To_Execution_Time_Ratio"] is None
    assert got["s3"]["TotalResourceTimeUsedForAllocation"] == 0.0
    assert got["s3"]["query_source_type"] == "UNKNOWN"
    assert (got["s4"]["query_source_type"], got["s4"]["query_source_id"]) == ("GENIE SPACE", "g1")


def test_query_model_is_one_pass(statements):
    assert "Exchange" not in plan_of(queries.refine_query_history(statements))


def test_phases_add_up_and_longest_is_named(statements):
    got = queries.duration_breakdown(statements, NOW, 90).first()
    parts = [got[f"{p}_duration_ms"] for p in queries.PHASES]
    assert sum(parts) == got["total_duration_ms"] == 1000 and got["dominant_phase"] == "execution"


def test_capacity(statements):
    stats = capacity.qpm_stats(statements, NOW)
    assert tuple(stats.first()) == (1, 2, 1.25, 4)
    need = capacity.cluster_need(stats).first()
    assert need["max_scaling"] == 2 / 250 and need["total_minutes_analyzed"] == 4
    sizes = {r["warehouse_size"]: r for r in capacity.need_by_size(stats).collect()}
    assert len(sizes) == 9 and sizes["Small"]["queries_per_min_capacity"] == 147
    assert sizes["2X-Small"]["max_clusters"] == 0.04


def test_over_scan_and_compare(statements):
    assert queries.over_scan(statements).count() == 5
    got = queries.compare_runs(statements, ["select"], ["QUERY_TAG"], NOW, 45)
    assert [r["statement_id"] for r in got.collect()] == ["s4", "s5"]
    assert queries.top_users(statements, NOW).first()["total_execution_ms"] == 3000


ORDERS = ("order_id int, customer_id int, quantity int, unit_price double, total_amount double,"
          " channel string, status string, order_timestamp timestamp_ntz, region string")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([
        (1, 1, 1, 10.0, 10.0, "Web", "Completed", days(1), "EMEA"),
        (2, 1, 1, 30.0, 30.0, "Web", "Completed", days(40), "EMEA"),
        (3, None, 1, 5.0, 5.0, "Mobile App", "Shipped", days(2), "APAC"),
        (4, 2, 1, 60.0, 60.0, "Web", "Completed", days(2), "APAC"),
    ], ORDERS)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, "a@x", "LATAM", "Peru", "Gold", date(2020, 1, 1)),
         (2, "b@x", "EMEA", "Spain", "Silver", date(2020, 1, 1)),
         (3, "c@x", "EMEA", "Spain", "Bronze", date(2020, 1, 1))],
        "customer_id int, email string, region string, country string, loyalty_tier string,"
        " signup_date date")


def test_enrich_keeps_the_region_of_the_order(orders, customers):
    got = {r["order_id"]: (r["segment"], r["region"]) for r in
           retail.enrich(orders, retail.segments(customers)).collect()}
    assert got == {1: ("High Value", "EMEA"), 2: ("High Value", "EMEA"), 3: (None, "APAC"),
                   4: ("Medium Value", "APAC")}


def test_revenue_by_tier_leaves_out_orders_without_customer(orders, customers):
    assert rows(retail.region_tier_revenue(orders, customers)) == [
        ("APAC", "Silver", 1, 60.0), ("EMEA", "Gold", 2, 40.0)]


def test_unknown_region_names_close_ones(orders):
    with pytest.raises(ValueError, match="'APEC'; closest values: APAC"):
        retail.channel_report(orders, "APEC", days(100))
    assert rows(retail.channel_report(orders, "APAC", days(100))) == [
        ("Mobile App", 1, 5.0), ("Web", 1, 60.0)]


def test_products_without_orders_are_kept(spark):
    products = spark.createDataFrame([(1, "a", "c", "x"), (2, "b", "c", "y")],
                                     "product_id int, product_name string, category string,"
                                     " color string")
    lines = spark.createDataFrame([(1, 7, 1, days(1)), (1, 7, 2, days(2))],
                                  "product_id int, order_id int, customer_id int,"
                                  " order_timestamp timestamp_ntz")
    got = {r["product_id"]: tuple(r)[4:6] for r in
           retail.product_performance(products, lines).collect()}
    assert got == {1: (1, 2), 2: (0, 0)}
    assert rows(retail.category_rollup(retail.product_performance(products, lines))) == [
        ("c", 2, 1)]


def test_distinct_lines_of_products_are_dealt_in_parts_of_their_own(spark):
    products = spark.createDataFrame([(1, "a", "c", "x"), (2, "b", "c", "y")],
                                     "product_id int, product_name string, category string,"
                                     " color string")
    lines = spark.createDataFrame(
        [(1, 7, 1, days(1)), (1, 7, 1, days(3)), (1, 8, None, days(2)), (1, 9, 1, None), (None, 1, 1, days(9))],
        "product_id int, order_id int, customer_id int, order_timestamp timestamp_ntz")
    found = retail.product_performance(products, lines)
    assert rows(found.select("product_id", "order_count", "unique_buyers", "first_sale", "last_sale")) == rows(
        spark.createDataFrame([(1, 3, 1, days(3), days(1)), (2, 0, 0, None, None)],
                              "a int, b long, c long, d timestamp_ntz, e timestamp_ntz"))
    plan = plan_of(retail.category_rollup(found))
    assert "Expand" not in plan and "REPARTITION_BY_NUM" in plan


def test_daily_wide_counts_without_repeating_rows(spark):
    kinds = ("order_id int, customer_id int, product_category string, product_color string,"
             " customer_region string, customer_country string, loyalty_tier string, channel string,"
             " order_timestamp timestamp_ntz, total_amount double, profit double, unit_price double")
    some = [(o, c, cat, "x", "r", "n", None, "Web", t, float(a), 1.0, None if a % 3 else 2.0)
            for a, (o, c, cat, t) in enumerate([
                (1, 1, "k", days(1)), (1, 1, "k", days(1)), (1, 2, "k", days(1)), (2, 2, "k", days(1)),
                (3, None, "k", days(1)), (None, None, "k", days(1)), (4, 1, None, days(2)),
                (1, 1, "k", days(2)), (5, 1, "m", None), (5, 1, "m", None)])]
    gold = spark.createDataFrame(some, kinds)
    found = retail.daily_wide(gold)
    plain = gold.groupBy("product_category", "product_color", "customer_region", "customer_country",
                         "loyalty_tier", "channel",
                         F.date_trunc("day", "order_timestamp").cast("timestamp_ntz").alias("day")).agg(
        F.count("*"), F.countDistinct("customer_id"), F.countDistinct("order_id"), F.sum("total_amount"),
        F.sum("profit"), F.avg("unit_price"), F.min("unit_price"), F.max("unit_price"), F.stddev("total_amount"))
    assert rows(found) == rows(plain) and found.count() == 4
    assert "Expand" not in plan_of(found)


def test_daily_wide_moves_rows_once(spark):
    kinds = ("order_id int, customer_id int, product_category string, product_color string,"
             " customer_region string, customer_country string, loyalty_tier string, channel string,"
             " order_timestamp timestamp_ntz, total_amount double, profit double, unit_price double")
    odd = [None, "", "a", "\x01", "\x02", "\x01n", "a\x02", "\x01g"]
    some = [(n % 5, n % 3 or None, a, b, "r", None, b, "Web", days(n % 2), float(n), 1.0, 2.0)
            for n, (a, b) in enumerate([(a, b) for a in odd for b in odd] * 3)]
    gold = spark.createDataFrame(some, kinds)
    keys = ["product_category", "product_color", "customer_region", "customer_country", "loyalty_tier", "channel"]
    found = retail.daily_wide(gold)
    plain = gold.groupBy(*keys, F.date_trunc("day", "order_timestamp").cast("timestamp_ntz").alias("day")).agg(
        F.count("*"), F.countDistinct("customer_id"), F.countDistinct("order_id"), F.sum("total_amount"),
        F.sum("profit"), F.avg("unit_price"), F.min("unit_price"), F.max("unit_price"), F.stddev("total_amount"))
    assert rows(found) == rows(plain)
    assert found.columns == [*keys, "day", "order_count", "unique_customers", "unique_orders", "total_revenue",
                             "total_profit", "avg_price", "min_price", "max_price", "stddev_amount"]
    plan = plan_of(found)
    assert plan[plan.rindex("HashAggregate"):].count("Exchange") == 1


def test_gold_of_bare_lines_is_the_same(spark):
    lines = spark.createDataFrame(
        [(1, 10, 2, 5.0, 10.0), (1, 10, 2, 5.0, 10.0), (1, 11, 1, 3.0, 3.0), (2, None, 1, 1.0, 1.0),
         (3, 12, 4, 1.0, 4.0), (4, 10, 1, 9.0, 9.0), (None, 10, 1, 9.0, 9.0)],
        "order_id int, product_id int, quantity int, unit_price double, total_amount double")
    orders = spark.createDataFrame(
        [(1, 7, "Web", "O", days(1), "EMEA"), (2, None, "Web", "F", days(2), "APAC"),
         (3, 8, "App", "O", days(1), "EMEA"), (3, 9, "App", "O", days(3), None), (None, 7, "App", "O", days(1), "EMEA")],
        "order_id int, customer_id int, channel string, status string, order_timestamp timestamp_ntz, region string")
    customers = spark.createDataFrame(
        [(7, "a@x", "ASIA", "CHINA", "Gold"), (9, "b@x", "ASIA", "JAPAN", "Gold"), (9, "c@x", "ASIA", "INDIA", None)],
        "customer_id int, email string, region string, country string, loyalty_tier string")
    products = spark.createDataFrame(
        [(10, "p", "k", "red", 2.0), (11, "q", "k", None, None), (11, "q", "m", "blue", 1.0)],
        "product_id int, product_name string, category string, color string, cost_price double")
    found = retail.gold_orders(lines, customers, products, orders)
    plain = retail.gold_orders(lines.join(orders, "order_id"), customers, products)
    assert found.columns == plain.columns
    assert rows(found) == rows(plain) and found.count() == 8


def test_daily_sales_rounds(orders):
    got = {(r["order_date"], r["channel"]): r for r in retail.daily_sales(orders).collect()}
    assert got[days(2).date(), "Web"]["avg_order_value"] == 60.0


def test_stock_lookup(spark):
    stock = spark.createDataFrame([("A", "pump 1"), ("B", "pump 2"), ("B", "valve")],
                                  "city string, part string")
    assert retail.stock_lookup(stock).count() == 3
    assert retail.stock_lookup(stock, "B").count() == 2
    assert retail.stock_lookup(stock, "B", "pump").count() == 1
    assert retail.stock_lookup(stock, term="pump").count() == 2


def test_cost_risk_and_tags(spark):
    clusters = spark.createDataFrame(
        [("c1", "ann", "n", 61, {"team": "x"}, days(1), None),
         ("c2", "ann", "n", 31, {}, days(1), None), ("c3", "ann", "n", 30, {}, days(1), None),
         ("gone", "ann", "n", 99, {}, days(1), days(0)), ("old", "ann", "n", 99, {}, days(9), None)],
        "cluster_name string, owned_by string, driver_node_type string,"
        " auto_termination_minutes int, tags map<string,string>, change_time timestamp_ntz,"
        " delete_time timestamp_ntz")
    houses = spark.createDataFrame([("w1", "Small", 11, None)],
                                   "warehouse_name string, warehouse_size string,"
                                   " auto_stop_minutes int, delete_time timestamp_ntz")
    got = {r["name"]: r["cost_risk"] for r in access.cost_risk(clusters, houses, NOW).collect()}
    assert got == {"c1": "HIGH", "c2": "MEDIUM", "c3": "OK", "w1": "MEDIUM"}
    tags = {r["cluster_name"]: r["has_tag"] for r in
            access.tag_check(clusters, "C", "team").collect()}
    assert tags == {"c1": True, "c2": False, "c3": False}


def test_update_durations(spark):
    def event(minute, update, state):
        return (NOW + timedelta(minutes=minute), "update_progress", (None, update, None),
                '{"update_progress":{"state":"%s"}}' % state)

    log = spark.createDataFrame([
        event(0, 1, "QUEUED"), event(1, 1, "RUNNING"), event(4, 1, "COMPLETED"),
        event(5, 2, "RUNNING"), event(6, 2, "FAILED")],
        "timestamp timestamp_ntz, event_type string,"
        " origin struct<pipeline_name:string,update_id:int,flow_name:string>, details string")
    assert [(r["update_id"], r["duration_sec"]) for r in
            flow_events.update_durations(log).collect()] == [(1, 180)]


def test_promo_totals_meet_the_discount_after_summing(spark):
    orders = spark.createDataFrame([("A", 10.0), ("A", 30.0), ("B", 5.0)],
                                   "promo_code string, order_total double")
    promos = spark.createDataFrame([("A", 50.0), ("B", 0.0)], "promo_code string, discount_pct double")
    assert rows(retail.promo_totals(orders, promos)) == [("A", 2, 40.0, 20.0), ("B", 1, 5.0, 5.0)]


def test_job_reports_tell_workspaces_apart(spark, job_rows, run_rows):
    """The same job id in another workspace has its own runs and its own name."""
    other = job_rows.filter("job_id = 1").withColumn("workspace_id", F.col("workspace_id") + 100) \
        .withColumn("name", F.lit("busy elsewhere"))
    both = job_rows.unionByName(other)
    assert rows(jobs.run_counts(run_rows, both, "bu", NOW)) == [("busy", 4)]
    assert jobs.run_history(run_rows, both, "busy elsewhere", NOW).count() == 0
