"""The canonical views once more, as SQL over the driver tables for the oracle."""

from __future__ import annotations

import re

VIEWS = {
    "v_orders": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer_id,
               CAST(CASE WHEN o_orderkey % 100 = 7 THEN -1 ELSE 1 END * (o_orderkey % 5 + 1)
                    AS INTEGER) AS quantity,
               o_totalprice / (o_orderkey % 5 + 1) AS unit_price,
               o_totalprice AS total_amount, o_orderpriority AS channel, o_orderstatus AS status,
               CASE WHEN o_orderkey % 200 = 11 THEN o_orderdate + INTERVAL 3650 DAY
                    ELSE o_orderdate END AS order_timestamp,
               (['EMEA', 'North America', 'APAC', 'LATAM'])[o_custkey % 4 + 1] AS region
        FROM orders""",
    "v_customers": """
        SELECT c_custkey AS customer_id, lower(c_name) || '@example.com' AS email,
               r_name AS region, n_name AS country,
               CASE WHEN c_acctbal > 7500 THEN 'Platinum' WHEN c_acctbal > 5000 THEN 'Gold'
                    WHEN c_acctbal > 2500 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
               DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "v_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               split_part(p_name, ' ', 1) AS color, p_retailprice AS retail_price,
               CAST(floor(p_retailprice / 2) AS DOUBLE) AS cost_price,
               CASE WHEN p_partkey % 4 = 0 THEN 'Discontinued' ELSE 'Active' END AS status
        FROM part""",
    "v_lines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
               CAST(l_quantity AS INTEGER) AS quantity,
               l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_amount,
               o.customer_id, o.channel, o.status, o.order_timestamp, o.region
        FROM lineitem JOIN v_orders AS o ON l_orderkey = o.order_id""",
    "v_gold": """
        SELECT l.order_id, l.order_timestamp, l.customer_id, c.email AS customer_email,
               c.region AS customer_region, c.country AS customer_country, c.loyalty_tier,
               l.product_id, p.product_name, p.category AS product_category,
               p.color AS product_color, l.quantity, l.unit_price, l.total_amount, p.cost_price,
               l.total_amount - l.quantity * p.cost_price AS profit, l.channel,
               l.status AS order_status, l.region AS order_region
        FROM v_lines AS l LEFT JOIN v_customers AS c ON l.customer_id = c.customer_id
                          LEFT JOIN v_products AS p ON l.product_id = p.product_id""",
    "v_dirty": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id,
               CASE WHEN l_orderkey % 50 <> 0 THEN l_suppkey END AS customer_id,
               CASE WHEN l_partkey % 40 <> 0 THEN l_partkey END AS product_id,
               CAST(CASE WHEN l_orderkey % 100 = 7 THEN -l_quantity ELSE l_quantity END
                    AS INTEGER) AS quantity,
               CASE WHEN l_orderkey % 90 = 4 THEN 0::DOUBLE ELSE l_extendedprice END
               AS unit_price, l_returnflag AS channel,
               CAST(l_shipdate AS DATE)
               + CASE WHEN l_orderkey % 200 = 11 THEN 36500 ELSE 0 END AS order_date,
               CASE WHEN l_orderkey % 500 = 1 THEN '{"x":1}' END AS rescued
        FROM lineitem""",
    "v_dirty_silver": """
        SELECT * FROM v_dirty WHERE customer_id IS NOT NULL AND product_id IS NOT NULL
                                AND quantity > 0 AND unit_price > 0""",
    "v_inventory": """
        SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS event_id,
               CASE WHEN event_id % 89 <> 0 THEN user_id END AS product_id,
               CASE WHEN event_id % 83 <> 0 THEN 'W' || (event_id % 5) END AS warehouse,
               event_type, CAST(floor(value) AS INTEGER) AS quantity_change,
               CASE WHEN event_id % 101 = 0 THEN ts + INTERVAL 3650 DAY ELSE ts END
               AS event_timestamp
        FROM events""",
    "v_silver": """
        SELECT * FROM v_inventory
        WHERE event_id IS NOT NULL AND product_id IS NOT NULL AND warehouse IS NOT NULL
          AND event_timestamp <= TIMESTAMP '2024-01-31'""",
    "v_runs": """
        SELECT user_id % 3 AS workspace_id, user_id AS job_id, user_id * 100 + day(ts) AS run_id,
               CASE WHEN event_id % 10 = 0 THEN 'SUBMIT_RUN' ELSE 'JOB_RUN' END AS run_type,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'TIMED_OUT'
                    WHEN 'signup' THEN NULL ELSE 'SUCCEEDED' END AS result_state,
               CASE event_type WHEN 'error' THEN 'RUN_EXECUTION_ERROR' WHEN 'signup' THEN NULL
                    ELSE 'SUCCESS' END AS termination_code,
               CASE WHEN event_id % 2 = 0 THEN 'SERVERLESS' ELSE 'CLASSIC' END AS compute_type,
               ts AS period_start_time,
               ts + to_seconds(CAST(round(value) AS INTEGER)) AS period_end_time
        FROM events""",
    "v_jobs": """
        SELECT (o_custkey % 150) % 3 AS workspace_id, o_custkey % 150 AS job_id,
               CASE WHEN o_custkey % 2 = 0 THEN 'nightly-' ELSE 'flow-' END || (o_custkey % 150)
               AS name, o_custkey AS creator_id, o_orderdate AS create_time,
               o_orderdate AS change_time, o_orderkey AS version_id,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS delete_time,
               o_orderpriority AS priority
        FROM orders""",
    "v_latest_jobs": """
        SELECT * FROM v_jobs QUALIFY row_number() OVER (
            PARTITION BY workspace_id, job_id ORDER BY change_time DESC, version_id DESC) = 1""",
    "v_usage": """
        SELECT (l_suppkey % 150) % 3 AS workspace_id, l_returnflag AS sku_name,
               CAST(l_shipdate AS DATE) AS usage_date, l_shipdate AS usage_start_time,
               l_quantity AS usage_quantity,
               CASE WHEN l_linestatus = 'F' THEN 'JOBS' ELSE 'SQL' END AS billing_origin_product,
               CASE WHEN l_linestatus = 'F' THEN l_suppkey % 150 END AS job_id,
               CASE WHEN l_linestatus = 'F'
                    THEN (l_suppkey % 150) * 100 + l_orderkey % 30 + 1 END AS run_id,
               CASE WHEN l_linestatus = 'O' THEN 'wh-' || (l_suppkey % 7) END AS warehouse_id,
               CASE WHEN l_partkey % 9 <> 0 THEN 'user' || (l_partkey % 20) END AS run_as
        FROM lineitem""",
    "v_prices": """
        SELECT sku_name, currency_code, CAST(s AS TIMESTAMP) AS price_start_time,
               CAST(e AS TIMESTAMP) AS price_end_time, CAST(p AS DOUBLE) AS price
        FROM (VALUES ('A', 'USD', '1994-01-01', '1997-01-01', 0.25),
                     ('A', 'USD', '1997-01-01', '2000-06-01', 0.5),
                     ('A', 'USD', '2000-06-01', NULL, 0.75),
                     ('A', 'EUR', '1994-01-01', NULL, 0.2),
                     ('N', 'USD', '1996-03-15', '1999-01-01', 1.0),
                     ('N', 'USD', '1999-01-01', NULL, 1.25),
                     ('R', 'USD', '1995-01-01', '2001-01-01', 2.0))
             AS t(sku_name, currency_code, s, e, p)""",
    "v_priced": """
        SELECT u.*, p.price FROM v_usage AS u LEFT JOIN v_prices AS p
          ON u.sku_name = p.sku_name AND p.currency_code = 'USD'
         AND p.price_start_time <= u.usage_start_time
         AND (u.usage_start_time < p.price_end_time OR p.price_end_time IS NULL)""",
    "v_timed": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(round(value * 1000) AS BIGINT) AS total_duration_ms
        FROM events""",
    "v_history": """
        SELECT 'acc-1' AS account_id, user_id % 3 AS workspace_id, event_id,
               's-' || event_id AS statement_id, 'user' || (user_id % 50) AS executed_by,
               CASE event_type
               WHEN 'purchase' THEN '/* {"app": "dbt", "node_id": "model.' || user_id ||
                 '", "profile_name": "ops", "target_name": "prod", "dbt_version": "1.8"} */' ||
                 ' select * from gold_order_summary'
               WHEN 'click' THEN '/* QUERY_TAG:team_' || (user_id % 4) || ' */ select 1'
               WHEN 'view' THEN
                 'SELECT * FROM gold_order_summary WHERE customer_region = ''EMEA'''
               WHEN 'error' THEN 'OPTIMIZE gold_order_summary'
               ELSE 'DESCRIBE gold_order_summary' END AS statement_text,
               CASE WHEN event_id % 41 <> 0 THEN 'SELECT' END AS statement_type,
               CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 13 = 0 THEN 'QUEUED'
                    ELSE 'FINISHED' END AS execution_status,
               CASE WHEN event_id % 3 <> 0 THEN 'SQL Editor' END AS client_application,
               CASE WHEN event_id % 37 <> 0 THEN 'wh-' || (user_id % 7) END AS warehouse_id,
               ts AS start_time, ts + to_seconds(CAST(round(value) AS INTEGER)) AS end_time,
               total_duration_ms, total_duration_ms * 6 // 10 AS execution_duration_ms,
               total_duration_ms // 10 AS compilation_duration_ms,
               total_duration_ms // 20 AS waiting_for_compute_duration_ms,
               CASE WHEN event_id % 4 = 0 THEN total_duration_ms // 5 ELSE 0 END
               AS waiting_at_capacity_duration_ms,
               total_duration_ms // 40 AS result_fetch_duration_ms,
               CASE WHEN event_id % 17 <> 0 THEN total_duration_ms * 3 END
               AS total_task_duration_ms,
               k * 4000000 AS read_bytes,
               CASE WHEN event_type = 'purchase' THEN k * 1000 ELSE 0 END AS written_bytes,
               CASE WHEN k > 90 THEN k * 1000000 ELSE 0 END AS spilled_local_bytes,
               k * 1000 AS read_rows, k * 3 AS produced_rows, k % 10 AS read_files,
               k % 7 AS pruned_files, k % 3 * 10 AS read_io_cache_percent,
               event_id % 11 = 0 AS from_result_cache,
               CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0
                    THEN '[DIVIDE_BY_ZERO] bad value' ELSE 'plain failure' END END
               AS error_message,
               CASE WHEN event_id % 7 = 0 THEN 'j' || user_id END AS src_job,
               CASE WHEN event_id % 7 = 1 THEN 'ld' || user_id END AS src_legacy,
               CASE WHEN event_id % 5 = 2 THEN 'd' || user_id END AS src_dashboard,
               CASE WHEN event_id % 7 = 3 THEN 'a' || user_id END AS src_alert,
               CASE WHEN event_id % 7 = 4 THEN 'n' || user_id END AS src_notebook,
               CASE WHEN event_id % 7 = 5 THEN 'q' || user_id END AS src_query,
               CASE WHEN event_id % 14 = 6 THEN 'g' || user_id END AS src_space
        FROM v_timed""",
    "v_audit": """
        SELECT event_id, ts AS event_time, CAST(ts AS DATE) AS event_date,
               user_id % 3 AS workspace_id, 'acc-1' AS account_id,
               CASE WHEN event_id % 20 < 9 THEN 'warehouse' ELSE 'catalog' END AS service_name,
               CASE event_id % 20 WHEN 0 THEN 'createWarehouse' WHEN 7 THEN 'createEndpoint'
                    WHEN 6 THEN 'deleteWarehouse' WHEN 8 THEN 'editEndpoint' ELSE
                    CASE WHEN event_id % 20 < 6 THEN 'editWarehouse' ELSE 'getTable' END
                    END AS action_name,
               '10.0.0.' || (user_id % 250) AS source_ip_address,
               'user' || user_id || '@example.com' AS email, user_id,
               'wh-' || (user_id % 40) AS warehouse_id,
               CASE WHEN event_type = 'error' THEN 403 ELSE 200 END AS status_code,
               CASE WHEN event_type = 'error' THEN 'permission denied' END AS error_message,
               'main.sales.t' || (user_id % 11) AS resource
        FROM events""",
    "v_changes": """
        SELECT event_id, event_time, event_date, workspace_id, account_id, action_name,
               email AS warehouse_editor_user, warehouse_id,
               'warehouse ' || (user_id % 40) AS warehouse_name,
               CASE WHEN user_id % 2 = 0 THEN 'PRO' ELSE 'CLASSIC' END AS warehouse_type,
               CAST(user_id % 60 AS VARCHAR) AS auto_stop_mins, 'Small' AS warehouse_size,
               1 AS min_cluster_scaling, CAST(user_id % 5 + 1 AS INTEGER) AS max_cluster_scaling,
               'CURRENT' AS warehouse_channel
        FROM v_audit WHERE service_name = 'warehouse' AND status_code = 200
                       AND action_name <> 'getTable'""",
    "v_log": """
        SELECT event_id, ts AS "timestamp",
               CASE event_type WHEN 'view' THEN 'update_progress' WHEN 'signup' THEN
                    'create_update' ELSE 'flow_progress' END AS event_type,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END
               AS level, event_type || ' of user ' || user_id AS message,
               'p' || (user_id % 3) AS pipeline_name, user_id AS update_id,
               'flow_' || (event_id % 4) AS flow_name, event_type AS raw_type
        FROM events""",
    "v_expectations": """
        SELECT "timestamp", flow_name AS table_name, 'valid_id' AS expectation_name,
               flow_name AS dataset, event_id % 100 AS passed_records,
               event_id % 7 AS failed_records FROM v_log WHERE raw_type = 'purchase'
        UNION ALL
        SELECT "timestamp", flow_name, 'valid_time', flow_name, event_id % 50, event_id % 5
        FROM v_log WHERE raw_type = 'purchase'""",
    "v_lineage": """
        SELECT 'geo.region_' || n_regionkey AS source_table_full_name,
               'geo.nation_' || n_nationkey AS target_table_full_name,
               TIMESTAMP '2024-01-01' AS event_time FROM nation
        UNION ALL SELECT 'geo.nation_' || n_nationkey, 'geo.region_0', TIMESTAMP '2024-01-01'
                  FROM nation WHERE n_nationkey = 24
        UNION ALL SELECT 'geo.nation_' || s_nationkey, 'buy.supplier_' || s_suppkey,
                         TIMESTAMP '2024-01-02' FROM supplier
        UNION ALL SELECT 'buy.supplier_' || l_suppkey, 'sell.part_' || l_partkey, l_shipdate
                  FROM lineitem
        UNION ALL SELECT 'sell.part_' || p_partkey, 'report.' || p_brand,
                         TIMESTAMP '2024-01-03' FROM part""",
    "v_clusters": """
        SELECT s_suppkey AS cluster_id,
               CASE WHEN s_suppkey % 3 = 0 THEN 'Ops-' ELSE 'dev-' END || s_suppkey
               AS cluster_name, 'user' || s_nationkey AS owned_by,
               CASE WHEN s_suppkey % 2 = 0 THEN 'UI' ELSE 'JOB' END AS cluster_source,
               '15.4' AS runtime_version, 'node-' || (s_nationkey % 5) AS worker_node_type,
               'node-' || (s_nationkey % 4) AS driver_node_type,
               CAST(floor(abs(s_acctbal) / 100) AS INTEGER) AS auto_termination_minutes,
               CASE WHEN s_suppkey % 4 <> 0 THEN 't' || s_nationkey END AS team,
               TIMESTAMP '2024-01-31' - to_days(CAST(s_suppkey % 60 AS INTEGER)) AS change_time,
               CASE WHEN s_suppkey % 10 = 3 THEN TIMESTAMP '2024-01-30' END AS delete_time
        FROM supplier""",
    "v_warehouses": """
        SELECT c_custkey AS warehouse_id, 'wh ' || c_name AS warehouse_name,
               (['Small', 'Medium', 'Large'])[c_custkey % 3 + 1] AS warehouse_size,
               CAST(floor(abs(c_acctbal) / 200) AS INTEGER) AS auto_stop_minutes,
               CASE WHEN c_custkey % 9 = 2 THEN TIMESTAMP '2024-01-15' END AS delete_time
        FROM customer""",
    "v_logs": """
        SELECT '/logs/' || source || '/driver/' || CASE doc_id % 3 WHEN 0 THEN 'stdout'
                 WHEN 1 THEN 'stderr' ELSE 'log4j-active.log' END AS log_file,
               doc_id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no,
               unnest(lines) AS log_line
        FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents) AS d""",
}


def with_views(sql: str) -> str:
    """Put the views that ``sql`` uses, and the ones those use, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {ctes}\n{sql}"
