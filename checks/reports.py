"""Operational and retail reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.basics import SOURCE_SQL
from checks.joins import SCD_SQL, SEGMENT_SQL
from checks.registry import query
from lakewarden.plans import (
    access, capacity, cost, flow_events, jobs, queries, retail, triage,
)
from lakewarden.plans.views import EVENTS_AS_OF, ORDERS_AS_OF
from lakewarden.session import fresh_dir
from lakewarden.sources import tables

JAN30 = datetime(2024, 1, 30)
FEB15 = datetime(2024, 2, 15)
MAR10 = datetime(2024, 3, 10)
SHIP_END = datetime(2001, 11, 4)


# -- query history ------------------------------------------------------------------------------

COMMENT_SQL = ("CASE WHEN instr(statement_text, '/*') > 0 THEN regexp_extract(statement_text,"
               " '/\\*(.*?)\\*/', 1) END")


def comment_field(name: str) -> str:
    return (f"coalesce(CASE WHEN json_valid({COMMENT_SQL}) THEN json_extract_string({COMMENT_SQL},"
            f" '$.{name}') END, 'None')")


MEASURES = sorted({f"{p}_duration_ms" for parts in queries.DURATIONS.values() for p in parts}
                  | {*queries.AMOUNTS.values(), "read_io_cache_percent"})
J1_DOUBLES = {
    **{name: "(" + " + ".join(f"{p}_duration_ms" for p in parts) + ") / 1000::DOUBLE"
       for name, parts in queries.DURATIONS.items()},
    **{name: f"{c} / {2**30}::DOUBLE" for name, c in queries.AMOUNTS.items()},
    **{f"Calc_{name}": f"CASE WHEN {queries.FLAGS[name][0]} > 0 THEN {w} ELSE 0 END::DOUBLE"
       for name, w in queries.WEIGHTS.items()},
    "TotalResourceTimeUsedForAllocation": "CASE WHEN total_task_duration_ms > 0 THEN"
    " compilation_duration_ms + total_task_duration_ms + result_fetch_duration_ms ELSE 0 END"
    " / 1000::DOUBLE",
    "TotalCPUTime_To_Execution_Time_Ratio": "CASE WHEN timed THEN total_task_duration_ms END"
    " / nullif(total_duration_ms, 0)::DOUBLE",
    "ProportionQueueTime": "(waiting_for_compute_duration_ms + waiting_at_capacity_duration_ms)"
    " / nullif(total_duration_ms, 0)::DOUBLE",
    "ProportionResultFetchTime": "result_fetch_duration_ms / nullif(total_duration_ms, 0)::DOUBLE",
    "FilesPrunedProportion": "pruned_files / nullif(read_files + pruned_files, 0)::DOUBLE",
}
J1_TEXTS = {
    **{name: f"CASE WHEN {c} > 0 THEN '{yes}' ELSE '{no}' END"
       for name, (c, yes, no) in queries.FLAGS.items()},
    "client_application": "coalesce(client_application, 'Unknown')",
    "error_type": "coalesce(nullif(regexp_extract(error_message, '\\[(.*?)\\]', 1), ''), 'NO ERROR')",
}
J1_PLAIN = (
    "account_id workspace_id event_id statement_id executed_by statement_text statement_type"
    " execution_status warehouse_id start_time end_time read_bytes written_bytes spilled_local_bytes"
    " read_io_cache_percent read_rows produced_rows from_result_cache error_message"
    " query_source_type query_source_id").split()
J2_TEXTS = {
    "raw_tagged": "regexp_extract(statement_text, '/\\*.*?QUERY_TAG:(.*?)\\*/', 1)",
    "dbt_metadata_json": COMMENT_SQL,
    **{queries.comment_column("dbt", f): comment_field(f) for f in queries.COMMENT_FIELDS},
    "IsDBTQuery": f"CASE WHEN lower({comment_field('app')}) = 'dbt' OR"
    " contains(coalesce(client_application, ''), 'dbt') THEN 'DBT Query' ELSE 'Other Query Type' END",
}


def named(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


J1_SQL = (
    f"SELECT {', '.join(J1_PLAIN)}, end_time AS update_time, CAST(start_time AS DATE) AS start_date,"
    " CAST(end_time AS DATE) AS end_date, read_files AS FilesRead, pruned_files AS FilesPruned,"
    f" {named(J1_DOUBLES)}, {named(J1_TEXTS)}, {named(J2_TEXTS)} FROM (SELECT * REPLACE ("
    + named({c: f"coalesce({c}, 0)" for c in MEASURES})
    + f"), total_task_duration_ms IS NOT NULL AS timed, {SOURCE_SQL} FROM v_history"
    " WHERE warehouse_id IS NOT NULL AND statement_type IS NOT NULL) AS h")


def query_model(history):
    """Every column of the model but the map, whose entries are columns too."""
    return queries.refine_query_history(history).drop("parsed_dbt_comment")


@query("j01_query_model", J1_SQL, " ".join(J1_DOUBLES))
def j01(lake):
    return query_model(lake.query_history())


@query("j02_query_tags", f"SELECT statement_id, {named(J2_TEXTS)} FROM v_history")
def j02(lake):
    return queries.query_tags(lake.query_history()).select("statement_id", *J2_TEXTS)


@query("j03_warehouse_changes", SCD_SQL)
def j03(lake):
    return access.warehouse_scd(access.refine_warehouse_events(lake.audit(), "warehouse"))


@query("j04_workspaces",
       "SELECT 'acc-1' AS account_id, n_nationkey AS workspace_id, CASE WHEN n_nationkey % 5 <> 0"
       " THEN n_name END AS workspace_name, 'https://' || lower(n_name) || '.example.com' AS"
       " workspace_url, CASE WHEN n_nationkey % 6 = 0 THEN 'CANCELLED' ELSE 'RUNNING' END AS"
       " status, coalesce(CASE WHEN n_nationkey % 5 <> 0 THEN n_name END, '') || ' (id: ' ||"
       " n_nationkey || ')' AS workspace_full_name FROM nation")
def j04(lake):
    return access.workspaces_dim(lake.workspaces())


@query("j04_warehouses",
       "SELECT *, warehouse_name || ' (id:' || warehouse_id || ')' AS warehouse_full_name,"
       " CASE WHEN delete_time IS NOT NULL THEN 'Deleted' ELSE 'Active' END AS is_deleted"
       " FROM v_warehouses")
def j04_warehouses(lake):
    return access.warehouses_dim(lake.warehouses())


# -- jobs ---------------------------------------------------------------------------------------

@query("j05_stale_jobs",
       "SELECT j.job_id, j.name, j.creator_id, j.create_time, l.last_run FROM v_latest_jobs AS j"
       " JOIN (SELECT job_id, max(period_start_time) AS last_run FROM v_runs GROUP BY job_id) AS l"
       " ON j.job_id = l.job_id LEFT JOIN (SELECT DISTINCT job_id FROM v_runs WHERE"
       " period_start_time >= TIMESTAMP '2024-02-28 18:00:00' - INTERVAL 30 DAY) AS r"
       " ON j.job_id = r.job_id WHERE r.job_id IS NULL")
def j05(lake):
    return jobs.stale_jobs(lake.jobs(), lake.job_runs(), datetime(2024, 2, 28, 18))


@query("j06_idle_jobs",
       "SELECT j.workspace_id, j.job_id, j.name, j.change_time AS last_modified_at,"
       " l.last_executed_at, j.priority FROM v_latest_jobs AS j LEFT JOIN (SELECT workspace_id,"
       " job_id, max(period_start_time) AS last_executed_at FROM v_runs WHERE run_type = 'JOB_RUN'"
       " GROUP BY ALL) AS l USING (workspace_id, job_id) WHERE j.delete_time IS NULL AND"
       " (l.last_executed_at <= TIMESTAMP '2024-03-10' - INTERVAL 40 DAY"
       " OR l.last_executed_at IS NULL)")
def j06(lake):
    report = jobs.idle_jobs(lake.jobs(), lake.job_runs(), MAR10.replace(hour=9), 40)
    return report.withColumn("priority", F.col("tags")["priority"]).drop("tags")


@query("j07_runs_by_outcome",
       "SELECT workspace_id, count(DISTINCT run_id) AS job_count, result_state,"
       " CAST(period_start_time AS DATE) AS date FROM v_runs WHERE period_start_time >"
       " TIMESTAMP '2024-01-24' AND result_state IS NOT NULL GROUP BY ALL")
def j07(lake):
    return jobs.runs_by_outcome(lake.job_runs(), EVENTS_AS_OF)


@query("j08_run_counts",
       "SELECT j.name AS job_name, count(*) AS run_count FROM v_runs AS r JOIN v_latest_jobs AS j"
       " ON r.job_id = j.job_id WHERE r.period_start_time > TIMESTAMP '2024-01-31' - INTERVAL 60"
       " DAY AND j.name LIKE 'nightly%' GROUP BY j.name ORDER BY run_count DESC, job_name LIMIT 20")
def j08(lake):
    return jobs.run_counts(lake.job_runs(), lake.jobs(), "nightly", EVENTS_AS_OF)


@query("j09_run_history",
       "SELECT r.workspace_id, j.name AS job_name, r.run_id, r.result_state,"
       " r.period_start_time AS started_at, CAST(sum(epoch(period_end_time) -"
       " epoch(period_start_time)) AS DOUBLE) AS run_seconds FROM v_runs AS r JOIN v_latest_jobs"
       " AS j ON r.job_id = j.job_id WHERE r.period_start_time > TIMESTAMP '2024-01-31' - INTERVAL"
       " 60 DAY AND j.name = 'flow-7' GROUP BY ALL", "run_seconds")
def j09(lake):
    report = jobs.run_history(lake.job_runs(), lake.jobs(), "flow-7", EVENTS_AS_OF)
    seconds = F.expr("CAST(extract(SECOND FROM run_time) + 60 * extract(MINUTE FROM run_time)"
                     " + 3600 * extract(HOUR FROM run_time) AS DOUBLE)")
    return report.withColumn("run_seconds", seconds).drop("run_time")


J10_SQL = """
    SELECT t.*, r.run_start_time, r.run_end_time, r.result_state
    FROM (SELECT workspace_id, job_id, run_id, sku_name, max(run_as) AS run_as,
                 sum(usage_quantity * price) AS usage_cost, sum(usage_quantity) AS usage_quantity
          FROM v_priced WHERE billing_origin_product = 'JOBS'
          GROUP BY workspace_id, job_id, run_id, sku_name) AS t
    LEFT JOIN (SELECT workspace_id, job_id, run_id, min(period_start_time) AS run_start_time,
                      max(period_end_time) AS run_end_time, (
                      list(result_state ORDER BY period_end_time DESC, result_state DESC)
                      FILTER (result_state IS NOT NULL))[1] AS result_state
               FROM v_runs GROUP BY workspace_id, job_id, run_id) AS r
    USING (workspace_id, job_id, run_id)"""


@query("j10_cost_per_run", J10_SQL, "usage_cost usage_quantity")
def j10(lake):
    return cost.cost_per_run(lake.usage(), lake.list_prices(), lake.job_runs(), n=None)


@query("j11_retried_runs",
       "SELECT *, CASE WHEN retries_count > 0 AND failed THEN 'failed and retried' WHEN"
       " retries_count > 0 THEN 'retried' ELSE 'failed' END AS reason FROM (SELECT workspace_id,"
       " job_id, run_id, count(*) - 1 AS retries_count, bool_or(result_state = 'FAILED') AS failed"
       " FROM v_runs WHERE result_state IS NOT NULL AND period_start_time >= TIMESTAMP"
       " '2024-01-01' GROUP BY workspace_id, job_id, run_id) WHERE retries_count > 0 OR failed")
def j11(lake):
    report = jobs.retried_runs(lake.job_runs(), EVENTS_AS_OF)
    return report.withColumn("failed", F.col("reason").startswith("failed"))


@query("j12_recent_runs",
       "SELECT job_id, name AS job_name, run_id, result_state, termination_code, compute_type,"
       " period_start_time AS started_at, period_end_time AS ended_at,"
       " CAST(epoch(period_end_time - period_start_time) AS BIGINT) AS duration_sec FROM v_runs"
       " LEFT JOIN v_latest_jobs USING (workspace_id, job_id) WHERE period_start_time >="
       " TIMESTAMP '2024-01-24' AND result_state IS NOT NULL AND name LIKE 'flow%'")
def j12(lake):
    return jobs.recent_runs(lake.job_runs(), lake.jobs(), EVENTS_AS_OF, pattern="flow%")


# -- latency ------------------------------------------------------------------------------------

@query("j13_slowest",
       "SELECT statement_id, executed_by, warehouse_id, total_duration_ms, execution_duration_ms,"
       " compilation_duration_ms, waiting_at_capacity_duration_ms, produced_rows,"
       " substring(statement_text, 1, 120) AS query_preview FROM v_history WHERE start_time >="
       " TIMESTAMP '2024-01-24' AND execution_status = 'FINISHED' ORDER BY total_duration_ms DESC,"
       " statement_id LIMIT 10")
def j13(lake):
    return queries.slowest(lake.query_history(), EVENTS_AS_OF)


@query("j14_latency_trend",
       "SELECT CAST(start_time AS DATE) AS query_date, count(*) AS total_queries,"
       " quantile_disc(total_duration_ms, 0.5) AS p50_ms, quantile_disc(total_duration_ms, 0.95)"
       " AS p95_ms, avg(waiting_at_capacity_duration_ms) AS avg_queue_ms, count(*) FILTER"
       " (execution_status = 'FAILED') AS failed_queries FROM v_history WHERE start_time >="
       " TIMESTAMP '2024-01-17' GROUP BY 1", "avg_queue_ms")
def j14(lake):
    return queries.latency_trend(lake.query_history(), EVENTS_AS_OF)


PHASES_SQL = ["compilation", "waiting_for_compute", "waiting_at_capacity", "execution",
              "result_fetch"]
GREATEST_SQL = f"greatest({', '.join(f'{p}_duration_ms' for p in PHASES_SQL)})"


@query("j15_duration_breakdown",
       "SELECT statement_id, total_duration_ms, "
       + ", ".join(f"{p}_duration_ms" for p in PHASES_SQL)
       + ", produced_rows, read_bytes, substring(statement_text, 1, 80) AS query_preview, CASE "
       + " ".join(f"WHEN {p}_duration_ms = {GREATEST_SQL} THEN '{p}'" for p in PHASES_SQL)
       + " END AS dominant_phase FROM v_history WHERE start_time >= TIMESTAMP '2024-01-30'")
def j15(lake):
    return queries.duration_breakdown(lake.query_history(), EVENTS_AS_OF, 24 * 60)


@query("j16_queue_by_hour",
       "SELECT date_trunc('hour', start_time)::TIMESTAMP AS hour, warehouse_id, count(*) AS"
       " query_count, avg(waiting_at_capacity_duration_ms) AS avg_queue_wait_ms,"
       " max(waiting_at_capacity_duration_ms) AS max_queue_wait_ms, count(*) FILTER"
       " (waiting_at_capacity_duration_ms > 5000) AS long_waits FROM v_history WHERE start_time >="
       " TIMESTAMP '2024-01-29' GROUP BY ALL", "avg_queue_wait_ms")
def j16(lake):
    return queries.queue_by_hour(lake.query_history(), EVENTS_AS_OF, 48)


@query("j17_status_by_warehouse",
       "SELECT warehouse_id, execution_status, count(*) AS query_count, avg(total_duration_ms) AS"
       " avg_duration_ms, quantile_disc(total_duration_ms, 0.95) AS p95_duration_ms FROM v_history"
       " WHERE start_time >= TIMESTAMP '2024-01-24' GROUP BY ALL", "avg_duration_ms")
def j17(lake):
    return queries.status_by_warehouse(lake.query_history(), EVENTS_AS_OF)


@query("j18_busiest",
       "SELECT warehouse_id, count(*) AS query_count, quantile_disc(total_duration_ms, 0.5) AS"
       " p50_ms, quantile_disc(total_duration_ms, 0.95) AS p95_ms FROM v_history WHERE start_time"
       " >= TIMESTAMP '2024-01-24' AND warehouse_id IS NOT NULL GROUP BY warehouse_id ORDER BY"
       " query_count DESC, warehouse_id LIMIT 1")
def j18(lake):
    return queries.busiest(lake.query_history(), EVENTS_AS_OF)


@query("j18_over_scan",
       "SELECT statement_id, executed_by, read_bytes, produced_rows, substring(statement_text, 1,"
       " 80) AS query_preview FROM v_history WHERE read_bytes > 100 * 1024 * 1024 AND"
       " produced_rows < 100")
def j18_over_scan(lake):
    return queries.over_scan(lake.query_history())


@query("j18_top_users",
       "SELECT executed_by, CAST(sum(execution_duration_ms) AS BIGINT) AS total_execution_ms,"
       " count(*) AS query_count FROM v_history WHERE start_time >= TIMESTAMP '2024-01-24'"
       " GROUP BY executed_by ORDER BY total_execution_ms DESC, executed_by LIMIT 5")
def j18_top_users(lake):
    return queries.top_users(lake.query_history(), EVENTS_AS_OF)


@query("j19_compare_runs",
       "SELECT statement_id, start_time, total_duration_ms, execution_duration_ms, read_bytes,"
       " read_rows, produced_rows, substring(statement_text, 1, 80) AS query_preview FROM"
       " v_history WHERE contains(statement_text, 'gold_order_summary') AND"
       " contains(statement_text, 'EMEA') AND NOT contains(statement_text, 'OPTIMIZE')"
       " AND NOT contains(statement_text, 'DESCRIBE')")
def j19(lake):
    return queries.compare_runs(lake.query_history(), ["gold_order_summary", "EMEA"],
                                ["OPTIMIZE", "DESCRIBE"])


# -- access and compute -------------------------------------------------------------------------

@query("j20_denied_access",
       "SELECT event_time, email AS user_email, source_ip_address, action_name, resource,"
       " error_message FROM v_audit WHERE event_date >= DATE '2024-01-24' AND status_code <> 200"
       " ORDER BY event_time DESC, email LIMIT 25")
def j20(lake):
    return access.denied_access(lake.audit(), EVENTS_AS_OF, n=25)


@query("j20_denied_by_catalog",
       "SELECT 'main' AS catalog_name, count(*) AS denied FROM v_audit WHERE event_date >="
       " DATE '2024-01-28' AND status_code <> 200")
def j20_catalog(lake):
    return access.denied_by_catalog(lake.audit(), EVENTS_AS_OF)


@query("j23_cluster_inventory",
       "SELECT cluster_id, cluster_name, owned_by, cluster_source, runtime_version,"
       " worker_node_type, driver_node_type, change_time FROM v_clusters WHERE change_time >="
       " TIMESTAMP '2024-01-01' AND delete_time IS NULL ORDER BY change_time DESC, cluster_id"
       " LIMIT 20")
def j23(lake):
    return access.cluster_inventory(lake.clusters(), EVENTS_AS_OF, n=20)


@query("j23_tag_check",
       "SELECT cluster_name, team AS tag_value, team IS NOT NULL AS has_tag, change_time FROM"
       " v_clusters WHERE contains(lower(cluster_name), 'ops') AND delete_time IS NULL")
def j23_tags(lake):
    return access.tag_check(lake.clusters(), "ops", "team")


def risk(column: str, high: int, medium: int) -> str:
    return (f"CASE WHEN {column} > {high} THEN 'HIGH' WHEN {column} > {medium} THEN 'MEDIUM'"
            " ELSE 'OK' END AS cost_risk")


@query("j24_cost_risk",
       "SELECT 'Cluster' AS type, cluster_name AS name, owned_by AS owner, driver_node_type AS"
       f" size, auto_termination_minutes AS auto_stop_mins, {risk('auto_termination_minutes', 60, 30)}"
       " FROM v_clusters WHERE delete_time IS NULL AND change_time >= TIMESTAMP '2024-01-24'"
       " UNION ALL SELECT 'Warehouse', warehouse_name, '', warehouse_size, auto_stop_minutes,"
       f" {risk('auto_stop_minutes', 30, 10)} FROM v_warehouses WHERE delete_time IS NULL")
def j24(lake):
    return access.cost_risk(lake.clusters(), lake.warehouses(), EVENTS_AS_OF)


@query("j25_usage_mix",
       "SELECT sku_name, count(DISTINCT usage_date) AS days_used, round(sum(usage_quantity), 1) AS"
       " total_units, round(sum(usage_quantity) / count(DISTINCT usage_date), 1) AS"
       " avg_units_per_day FROM v_usage WHERE usage_date >= DATE '2001-10-05' GROUP BY sku_name"
       " ORDER BY total_units DESC, sku_name LIMIT 10", "total_units avg_units_per_day")
def j25(lake):
    return cost.usage_mix(lake.usage(), SHIP_END, n=10)


@query("j26_top_jobs",
       "SELECT u.job_id, j.name AS job_name, sum(usage_quantity) AS total_units FROM v_usage AS u"
       " LEFT JOIN (SELECT job_id, name FROM v_jobs QUALIFY row_number() OVER (PARTITION BY job_id"
       " ORDER BY change_time DESC, version_id DESC) = 1) AS j ON u.job_id = j.job_id WHERE"
       " usage_date >= DATE '2001-10-05' AND u.job_id IS NOT NULL GROUP BY u.job_id, j.name"
       " ORDER BY total_units DESC, u.job_id LIMIT 10", "total_units")
def j26(lake):
    return cost.top_jobs(lake.usage(), lake.jobs(), SHIP_END)


# -- capacity -----------------------------------------------------------------------------------

MINUTES_SQL = ("SELECT date_trunc('minute', start_time)::TIMESTAMP AS start_time_minute, count(*)"
               " AS query_count FROM v_history WHERE start_time >= TIMESTAMP '2024-01-01'"
               " GROUP BY 1")


@query("j27_queries_per_minute",
       f"{MINUTES_SQL} ORDER BY start_time_minute DESC LIMIT 100")
def j27(lake):
    return capacity.qpm(lake.query_history(), EVENTS_AS_OF, n=100)


@query("j28_cluster_need",
       "SELECT min(query_count) / 250 AS min_scaling, max(query_count) / 250 AS max_scaling,"
       " avg(query_count) / 250 AS avg_clusters, min(query_count) AS min_queries_per_min,"
       " max(query_count) AS max_queries_per_min, round(avg(query_count), 1) AS"
       f" avg_queries_per_min, count(*) AS total_minutes_analyzed FROM ({MINUTES_SQL})",
       "min_scaling max_scaling avg_clusters avg_queries_per_min")
def j28(lake):
    return capacity.cluster_need(capacity.qpm_stats(lake.query_history(), EVENTS_AS_OF))


LADDER_SQL = ", ".join(f"('{s}', {q})" for s, q in capacity.CAPACITY.items())


def of_minutes(aggregate: str) -> str:
    return f"(SELECT {aggregate}(query_count) FROM ({MINUTES_SQL}))"


@query("j28_need_by_size",
       "SELECT size AS warehouse_size, qpm AS queries_per_min_capacity,"
       f" round({of_minutes('min')} / qpm, 2) AS min_clusters,"
       f" round({of_minutes('max')} / qpm, 2) AS max_clusters,"
       f" round({of_minutes('avg')} / qpm, 2) AS avg_clusters"
       f" FROM (VALUES {LADDER_SQL}) AS t(size, qpm)",
       "min_clusters max_clusters avg_clusters")
def j28_sizes(lake):
    return capacity.need_by_size(capacity.qpm_stats(lake.query_history(), EVENTS_AS_OF))


FIVE_SIZES = ["Small", "Medium", "Large", "X-Large", "2X-Large"]


@query("g02_union_per_size",
       " UNION ALL ".join(
           f"SELECT '{size}' AS warehouse_size, {capacity.CAPACITY[size]} AS"
           f" queries_per_min_capacity, round(min(query_count) / {capacity.CAPACITY[size]}, 2) AS"
           f" min_clusters, round(max(query_count) / {capacity.CAPACITY[size]}, 2) AS max_clusters,"
           f" round(avg(query_count) / {capacity.CAPACITY[size]}, 2) AS avg_clusters"
           f" FROM ({MINUTES_SQL})" for size in FIVE_SIZES),
       "min_clusters max_clusters avg_clusters")
def g02(lake):
    ladder = {size: capacity.CAPACITY[size] for size in FIVE_SIZES}
    return capacity.need_by_size(capacity.qpm_stats(lake.query_history(), EVENTS_AS_OF), ladder)


@query("j29_load_by_hour",
       "SELECT CAST(hour(start_time_minute) AS INTEGER) AS hour_of_day, round(avg(query_count), 1)"
       " AS avg_queries_per_min, max(query_count) AS peak_queries_per_min, count(*) AS"
       " sample_count, round(max(query_count) / 250, 2) AS peak_clusters_needed FROM"
       f" ({MINUTES_SQL}) GROUP BY 1", "avg_queries_per_min peak_clusters_needed")
def j29(lake):
    return capacity.load_by_hour(lake.query_history(), EVENTS_AS_OF)


@query("d12_aggregate_of_aggregate",
       "SELECT min(query_count) AS min_qpm, max(query_count) AS max_qpm, avg(query_count) AS"
       f" avg_qpm, count(*) AS minutes FROM ({MINUTES_SQL})", "avg_qpm")
def d12(lake):
    return capacity.qpm_stats(lake.query_history(), EVENTS_AS_OF)


@query("d14_mean_per_active_day",
       "SELECT sku_name, sum(usage_quantity) / count(DISTINCT usage_date) AS per_day FROM v_usage"
       " GROUP BY sku_name", "per_day")
def d14(lake):
    return lake.usage().groupBy("sku_name").agg(
        (F.sum("usage_quantity") / F.countDistinct("usage_date")).alias("per_day"))


@query("j30_maintenance_log",
       "SELECT 't' || user_id AS table_name, CASE WHEN event_id % 2 = 0 THEN 'COMPACTION' ELSE"
       " 'CLEANUP' END AS operation_type, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE"
       " 'SUCCESSFUL' END AS operation_status, k AS files_rewritten, ts AS start_time,"
       " ts + to_seconds(CAST(round(value) AS INTEGER)) AS end_time FROM v_timed WHERE user_id % 2"
       " = 1 ORDER BY start_time DESC, table_name LIMIT 20")
def j30(lake):
    return access.maintenance_log(lake.maintenance_ops(), "c1", n=20)


# -- triage -------------------------------------------------------------------------------------

@query("j31_recent_failures",
       "SELECT job_id, name AS job_name, run_id, termination_code, period_start_time FROM v_runs"
       " LEFT JOIN v_latest_jobs USING (workspace_id, job_id) WHERE period_start_time >="
       " TIMESTAMP '2024-01-30' - INTERVAL 48 HOUR AND result_state = 'FAILED'")
def j31(lake):
    return triage.recent_failures(lake.job_runs(), lake.jobs(), JAN30, 48)


@query("j31_units_per_day",
       "SELECT usage_date, sum(usage_quantity) AS units FROM v_usage WHERE usage_date >="
       " DATE '2001-07-26' GROUP BY usage_date", "units")
def j31_units(lake):
    return triage.units_per_day(lake.usage(), ORDERS_AS_OF)


@query("j31_costliest_job_user",
       "SELECT job_id, run_as, sum(usage_quantity * price) AS cost FROM v_priced WHERE usage_date"
       " >= DATE '2001-07-03' AND job_id IS NOT NULL GROUP BY job_id, run_as ORDER BY cost DESC"
       " NULLS LAST, job_id, run_as NULLS FIRST LIMIT 1", "cost")
def j31_costliest(lake):
    return triage.costliest_job_user(lake.usage(), lake.list_prices(), ORDERS_AS_OF)


@query("j31_slowest_warehouse",
       "SELECT warehouse_id, avg(total_duration_ms) AS avg_duration_ms FROM v_history WHERE"
       " warehouse_id IS NOT NULL GROUP BY warehouse_id ORDER BY avg_duration_ms DESC,"
       " warehouse_id LIMIT 1", "avg_duration_ms")
def j31_slowest(lake):
    return triage.slowest_warehouse(lake.query_history())


@query("j31_queued_now",
       "SELECT statement_id, executed_by, start_time FROM v_history WHERE execution_status ="
       " 'QUEUED' AND start_time >= TIMESTAMP '2024-01-30' - INTERVAL 600 MINUTE")
def j31_queued(lake):
    return queries.queued_now(lake.query_history(), JAN30, 600)


@query("j31_slowest_yesterday",
       "SELECT statement_id, executed_by, total_duration_ms FROM v_history WHERE start_time >="
       " TIMESTAMP '2024-01-29' AND start_time < TIMESTAMP '2024-01-30' ORDER BY"
       " total_duration_ms DESC, statement_id LIMIT 10")
def j31_yesterday(lake):
    return queries.slowest_on(lake.query_history(), datetime(2024, 1, 29), JAN30)


@query("j31_top_user_units",
       "SELECT run_as, billing_origin_product, sum(usage_quantity) AS units FROM v_usage WHERE"
       " usage_date >= DATE '2001-07-26' AND run_as = (SELECT run_as FROM v_usage WHERE usage_date"
       " >= DATE '2001-07-26' AND run_as IS NOT NULL GROUP BY run_as ORDER BY sum(usage_quantity)"
       " DESC, run_as LIMIT 1) GROUP BY ALL", "units")
def j31_top_user(lake):
    return triage.top_user_units(lake.usage(), ORDERS_AS_OF)


@query("j31_week_over_week",
       "SELECT sum(usage_quantity) FILTER (usage_date >= DATE '2001-07-26') AS this_week,"
       " sum(usage_quantity) FILTER (usage_date < DATE '2001-07-26') AS last_week,"
       " this_week - last_week AS change FROM v_usage WHERE usage_date >= DATE '2001-07-19' AND"
       " usage_date < DATE '2001-08-02'", "this_week last_week change")
def j31_wow(lake):
    return triage.week_over_week(lake.usage(), ORDERS_AS_OF)


# -- flow event log -----------------------------------------------------------------------------

@query("j32_event_overview",
       "SELECT \"timestamp\", event_type, level, message, pipeline_name, flow_name FROM v_log"
       " ORDER BY \"timestamp\" DESC, message LIMIT 50")
def j32(lake):
    return flow_events.event_overview(lake.event_log(), n=50)


@query("j32_event_counts",
       "SELECT event_type, level, count(*) AS event_count, min(\"timestamp\") AS first_event,"
       " max(\"timestamp\") AS last_event FROM v_log GROUP BY ALL")
def j32_counts(lake):
    return flow_events.event_counts(lake.event_log())


WRITTEN = ("CASE raw_type WHEN 'purchase' THEN event_id % 1000 WHEN 'click' THEN event_id % 100"
           " END")


@query("j33_flow_rows",
       "SELECT \"timestamp\", flow_name AS table_name, CASE raw_type WHEN 'purchase' THEN"
       f" 'COMPLETED' WHEN 'click' THEN 'RUNNING' END AS flow_status, {WRITTEN} AS rows_written,"
       " CASE WHEN raw_type = 'purchase' THEN event_id % 10 END AS rows_upserted, CASE WHEN"
       " raw_type = 'purchase' THEN event_id % 3 END AS rows_deleted FROM v_log WHERE event_type ="
       " 'flow_progress'")
def j33(lake):
    return flow_events.flow_rows(lake.event_log(), n=None)


@query("j33_flow_backlog",
       "SELECT flow_name AS table_name, count(*) AS reports, max(\"timestamp\") AS reported_at,"
       " arg_max(event_id % 20, (\"timestamp\", event_id)) AS files_outstanding,"
       " arg_max(event_id % 20 * 1000, (\"timestamp\", event_id)) AS bytes_outstanding,"
       " max(event_id % 20) AS most_files, max(event_id % 20 * 1000) AS most_bytes,"
       " arg_max(event_id % 20, (\"timestamp\", event_id)) > arg_min(event_id % 20, (\"timestamp\", event_id))"
       " AS growing FROM v_log WHERE raw_type = 'click' GROUP BY flow_name")
def j33_backlog(lake):
    return flow_events.flow_backlog(lake.event_log())


@query("j33_rows_per_run",
       f"SELECT update_id, flow_name AS table_name, CAST(coalesce(sum({WRITTEN}), 0) AS BIGINT) AS"
       " rows_written FROM v_log WHERE event_type = 'flow_progress' GROUP BY update_id, flow_name")
def j33_runs(lake):
    return flow_events.rows_per_run(lake.event_log())


ERRORS_SQL = ("SELECT \"timestamp\", level, flow_name AS table_name, message, CASE WHEN raw_type ="
              " 'error' THEN 'bad row ' || event_id END AS error_detail, CASE WHEN raw_type ="
              " 'error' THEN '[\"E' || (event_id % 5) || '\"]' END AS exceptions FROM v_log")


@query("j34_flow_errors",
       f"{ERRORS_SQL} WHERE level IN ('ERROR', 'WARN') ORDER BY \"timestamp\" DESC, message"
       " LIMIT 20")
def j34(lake):
    return flow_events.flow_errors(lake.event_log(), n=20)


@query("j34_errors_of_latest_run",
       f"{ERRORS_SQL} WHERE level = 'ERROR' AND update_id = (SELECT update_id FROM v_log ORDER BY"
       " \"timestamp\" DESC, event_id DESC LIMIT 1)")
def j34_latest(lake):
    return flow_events.errors_of_latest_run(lake.event_log())


@query("j35_update_lifecycle",
       "SELECT \"timestamp\", event_type, message, CASE WHEN raw_type = 'view' THEN"
       " (['RUNNING', 'COMPLETED', 'FAILED'])[event_id % 3 + 1] END AS update_state, CASE WHEN"
       " raw_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'USER' ELSE 'JOB' END END AS"
       " trigger_cause FROM v_log WHERE event_type IN ('update_progress', 'create_update')")
def j35_lifecycle(lake):
    return flow_events.update_lifecycle(lake.event_log(), n=None)


@query("j35_update_durations",
       "SELECT update_id, min(\"timestamp\") FILTER (event_id % 3 = 0) AS started_at,"
       " max(\"timestamp\") FILTER (event_id % 3 = 1) AS completed_at, CAST(floor(epoch("
       "completed_at - started_at)) AS BIGINT) AS duration_sec FROM v_log WHERE event_type ="
       " 'update_progress' GROUP BY update_id HAVING completed_at >= started_at")
def j35(lake):
    return flow_events.update_durations(lake.event_log())


# -- retail -------------------------------------------------------------------------------------

@query("j36_monthly_sales",
       "SELECT region, channel, date_trunc('month', order_timestamp)::TIMESTAMP AS month,"
       " count(order_id) AS order_count, sum(total_amount) AS total_revenue, count(DISTINCT"
       " customer_id) AS unique_customers FROM v_orders WHERE order_timestamp >= TIMESTAMP"
       " '1998-01-01' GROUP BY ALL", "total_revenue")
def j36(lake):
    return retail.monthly_sales(lake.orders(), datetime(1998, 1, 1))


@query("j37_segment_report",
       "SELECT CASE WHEN c.customer_id IS NOT NULL THEN"
       f" {SEGMENT_SQL} END AS segment, o.region, o.channel, count(o.order_id) AS order_count,"
       " sum(o.total_amount) AS total_revenue FROM v_orders AS o LEFT JOIN v_customers AS c ON"
       " o.customer_id = c.customer_id WHERE o.order_timestamp >= TIMESTAMP '1998-06-01' AND"
       " o.total_amount > 50 GROUP BY ALL", "total_revenue")
def j37(lake):
    out = fresh_dir(lake.spark, "chain")
    staging = tables.materialise(
        retail.extract_orders(lake.orders(), datetime(1998, 6, 1), 50), f"{out}/staging")
    enriched = tables.materialise(
        retail.enrich(staging, retail.segments(lake.customers())), f"{out}/enriched")
    return retail.segment_report(enriched)


@query("j38_region_tier_revenue",
       "SELECT o.region, c.loyalty_tier, count(o.order_id) AS order_count, sum(o.total_amount) AS"
       " total_revenue FROM v_orders AS o JOIN v_customers AS c ON o.customer_id = c.customer_id"
       " GROUP BY ALL", "total_revenue")
def j38(lake):
    return retail.region_tier_revenue(lake.orders(), lake.customers())


@query("j39_channel_report",
       "SELECT channel, count(order_id) AS order_count, sum(total_amount) AS total_revenue FROM"
       " v_orders WHERE region = 'EMEA' AND order_timestamp >= TIMESTAMP '1995-01-01' GROUP BY"
       " channel", "total_revenue")
def j39(lake):
    return retail.channel_report(lake.orders(), "EMEA", datetime(1995, 1, 1))


@query("j40_daily_wide",
       "SELECT product_category, product_color, customer_region, customer_country, loyalty_tier,"
       " channel, date_trunc('day', order_timestamp)::TIMESTAMP AS day, count(*) AS order_count,"
       " count(DISTINCT customer_id) AS unique_customers, count(DISTINCT order_id) AS"
       " unique_orders, sum(total_amount) AS total_revenue, sum(profit) AS total_profit,"
       " avg(unit_price) AS avg_price, min(unit_price) AS min_price, max(unit_price) AS max_price,"
       " stddev(total_amount) AS stddev_amount FROM v_gold GROUP BY ALL",
       "total_revenue total_profit avg_price min_price max_price stddev_amount")
def j40(lake):
    return retail.daily_wide(gold(lake))


def gold(lake):
    return retail.gold_orders(lake.line_items(), lake.customers(), lake.products(), lake.order_heads())


@query("j41_weekly_region",
       "SELECT product_category, customer_region, loyalty_tier, date_trunc('week',"
       " order_timestamp)::TIMESTAMP AS week, count(*) AS order_count, count(DISTINCT customer_id)"
       " AS unique_customers, sum(total_amount) AS total_revenue, sum(profit) AS total_profit,"
       " avg(unit_price) AS avg_unit_price FROM v_gold WHERE order_timestamp >= TIMESTAMP"
       " '1998-06-01' AND customer_region = 'ASIA' GROUP BY ALL",
       "total_revenue total_profit avg_unit_price")
def j41(lake):
    return retail.weekly_region(gold(lake), "ASIA", datetime(1998, 6, 1))


DAILY_SQL = ("SELECT CAST(order_timestamp AS DATE) AS order_date, region, channel, count(*) AS"
             " order_count, count(DISTINCT customer_id) AS unique_customers, sum(total_amount) AS"
             " total_revenue, avg(total_amount) AS avg_order_value"
             " FROM v_orders GROUP BY ALL")


@query("j42_daily_sales", DAILY_SQL, "total_revenue avg_order_value")
def j42(lake):
    return retail.daily_sales(lake.orders(), digits=None)


@query("j42_recent_sales", f"SELECT * FROM ({DAILY_SQL}) WHERE order_date >= DATE '2001-07-26'",
       "total_revenue avg_order_value")
def j42_recent(lake):
    stored = tables.refresh(retail.daily_sales(lake.orders(), digits=None), fresh_dir(lake.spark, "daily"),
                            ORDERS_AS_OF)
    return retail.recent_sales(stored, ORDERS_AS_OF).drop("_last_refreshed")


@query("j42_region_rollup",
       f"SELECT region, CAST(sum(order_count) AS BIGINT) AS order_count FROM ({DAILY_SQL})"
       " GROUP BY region")
def j42_region(lake):
    return retail.region_rollup(retail.daily_sales(lake.orders(), digits=None))


PERFORMANCE_SQL = (
    "SELECT p.product_id, p.product_name, p.category, p.color, count(DISTINCT l.order_id) AS"
    " order_count, count(DISTINCT l.customer_id) AS unique_buyers, min(l.order_timestamp) AS"
    " first_sale, max(l.order_timestamp) AS last_sale FROM v_products AS p LEFT JOIN v_lines AS l"
    " ON p.product_id = l.product_id GROUP BY ALL")


@query("j43_product_performance", PERFORMANCE_SQL)
def j43(lake):
    return retail.product_performance(lake.products(), lake.order_lines())


@query("j43_category_rollup",
       "SELECT category, count(*) AS product_count, CAST(sum(order_count) AS BIGINT) AS"
       f" total_orders FROM ({PERFORMANCE_SQL}) GROUP BY category")
def j43_category(lake):
    return retail.category_rollup(retail.product_performance(lake.products(), lake.order_lines()))


@query("j44_tier_region",
       "SELECT c.loyalty_tier, c.region, count(DISTINCT o.order_id) AS orders, sum(o.total_amount)"
       " AS total_revenue, avg(o.total_amount) AS avg_order_value FROM v_orders AS o JOIN"
       " v_customers AS c ON o.customer_id = c.customer_id WHERE o.order_timestamp >= TIMESTAMP"
       " '1998-06-01' GROUP BY ALL", "total_revenue avg_order_value")
def j44(lake):
    return retail.tier_region(lake.orders(), lake.customers(), datetime(1998, 6, 1))


@query("j44_category_month",
       "SELECT product_category, customer_region, date_trunc('month', order_timestamp)::TIMESTAMP"
       " AS month, count(*) AS orders, sum(total_amount) AS revenue, sum(profit) AS profit,"
       " avg(unit_price) AS avg_price, count(DISTINCT customer_id) AS unique_customers FROM v_gold"
       " GROUP BY ALL", "revenue profit avg_price")
def j44_month(lake):
    return retail.category_month(gold(lake))


@query("j45_channel_status",
       "SELECT channel, status, count(*) AS order_count, round(sum(total_amount), 2) AS"
       " total_revenue FROM v_orders GROUP BY ALL", "total_revenue")
def j45(lake):
    return retail.channel_status(lake.orders())


@query("j46_gold_orders", "SELECT * FROM v_gold",
       "unit_price total_amount cost_price profit")
def j46(lake):
    return gold(lake)


@query("j47_segments",
       f"SELECT customer_id, region, country, loyalty_tier, {SEGMENT_SQL} AS segment, signup_date"
       " FROM v_customers")
def j47(lake):
    return retail.segments(lake.customers())


@query("j49_channel_month",
       "SELECT channel, date_trunc('month', order_timestamp)::TIMESTAMP AS month, count(order_id)"
       " AS order_count, sum(total_amount) AS total_revenue FROM v_orders GROUP BY ALL",
       "total_revenue")
def j49(lake):
    return retail.channel_month(lake.orders_v2(), "order_total")
