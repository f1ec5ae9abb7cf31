"""Canonical retail, telemetry and log views derived from the driver tables.

The driver tables carry no defects, so NULL keys, negative quantities, future dates and the like
are planted here as pure functions of the row's own id.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

# Evaluation times of the views built on `events` and on `orders`.
EVENTS_AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = datetime(2001, 8, 2)


class Lake:
    """Driver tables of one folder and the canonical views on top of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- retail ---------------------------------------------------------------------------------

    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer_id",
            "CAST(CASE WHEN o_orderkey % 100 = 7 THEN -1 ELSE 1 END * (o_orderkey % 5 + 1) AS INT)"
            " AS quantity",
            "o_totalprice / (o_orderkey % 5 + 1) AS unit_price",
            "o_totalprice AS total_amount",
            "o_orderpriority AS channel",
            "o_orderstatus AS status",
            "CASE WHEN o_orderkey % 200 = 11 THEN o_orderdate + INTERVAL '3650' DAY"
            " ELSE o_orderdate END AS order_timestamp",
            "element_at(array('EMEA', 'North America', 'APAC', 'LATAM'),"
            " CAST(o_custkey % 4 AS INT) + 1) AS region",
        )

    def orders_v2(self) -> DataFrame:
        from lakewarden.operators.shape import evolve

        return evolve(self.orders(), rename={"total_amount": "order_total"},
                      add={"currency": F.lit("EUR")}, drop=["region"])

    def customers(self) -> DataFrame:
        nation = self.table("nation")
        region = self.table("region")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "c_custkey AS customer_id",
                "concat(lower(c_name), '@example.com') AS email",
                "r_name AS region",
                "n_name AS country",
                "CASE WHEN c_acctbal > 7500 THEN 'Platinum' WHEN c_acctbal > 5000 THEN 'Gold'"
                " WHEN c_acctbal > 2500 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier",
                "date_add(DATE '1995-01-01', CAST(c_custkey % 2000 AS INT)) AS signup_date",
            )
        )

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "split_part(p_name, ' ', 1) AS color",
            "p_retailprice AS retail_price",
            "CAST(floor(p_retailprice / 2) AS DOUBLE) AS cost_price",
            "CASE WHEN p_partkey % 4 = 0 THEN 'Discontinued' ELSE 'Active' END AS status",
        )

    def line_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id", "l_partkey AS product_id", "l_linenumber AS line_number",
            "CAST(l_quantity AS INT) AS quantity", "l_extendedprice / l_quantity AS unit_price",
            "l_extendedprice AS total_amount",
        )

    def order_heads(self) -> DataFrame:
        """Orders without the columns that a line has of its own."""
        return self.orders().drop("quantity", "unit_price", "total_amount")

    def order_lines(self) -> DataFrame:
        """Orders at line grain, which is where the product is known."""
        return self.line_items().join(self.order_heads(), "order_id")

    def dirty_orders(self) -> DataFrame:
        """Order lines with planted defects for the quality layers."""
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS order_id",
            "CASE WHEN l_orderkey % 50 <> 0 THEN l_suppkey END AS customer_id",
            "CASE WHEN l_partkey % 40 <> 0 THEN l_partkey END AS product_id",
            "CAST(CASE WHEN l_orderkey % 100 = 7 THEN -l_quantity ELSE l_quantity END AS INT)"
            " AS quantity",
            "CASE WHEN l_orderkey % 90 = 4 THEN 0.0D ELSE l_extendedprice END AS unit_price",
            "l_returnflag AS channel",
            "date_add(CAST(l_shipdate AS DATE), CASE WHEN l_orderkey % 200 = 11 THEN 36500 ELSE 0"
            " END) AS order_date",
            "CASE WHEN l_orderkey % 500 = 1 THEN '{\"x\":1}' END AS _rescued_data",
        )

    def inventory_events(self) -> DataFrame:
        return self.table("events").selectExpr(*INVENTORY_COLUMNS)

    # -- telemetry ------------------------------------------------------------------------------

    def job_runs(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id % 3 AS workspace_id",
            "user_id AS job_id",
            "user_id * 100 + day(ts) AS run_id",
            "CASE WHEN event_id % 10 = 0 THEN 'SUBMIT_RUN' ELSE 'JOB_RUN' END AS run_type",
            "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'TIMED_OUT'"
            " WHEN 'signup' THEN NULL ELSE 'SUCCEEDED' END AS result_state",
            "CASE event_type WHEN 'error' THEN 'RUN_EXECUTION_ERROR' WHEN 'signup' THEN NULL"
            " ELSE 'SUCCESS' END AS termination_code",
            "CASE WHEN event_id % 2 = 0 THEN 'SERVERLESS' ELSE 'CLASSIC' END AS compute_type",
            "ts AS period_start_time",
            "timestampadd(SECOND, CAST(round(value) AS INT), ts) AS period_end_time",
        )

    def jobs(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "(o_custkey % 150) % 3 AS workspace_id",
            "o_custkey % 150 AS job_id",
            "concat(CASE WHEN o_custkey % 2 = 0 THEN 'nightly-' ELSE 'flow-' END,"
            " o_custkey % 150) AS name",
            "o_custkey AS creator_id",
            "o_orderdate AS create_time",
            "o_orderdate AS change_time",
            "o_orderkey AS version_id",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS delete_time",
            "map('priority', o_orderpriority) AS tags",
        )

    def usage(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "(l_suppkey % 150) % 3 AS workspace_id",
            "l_returnflag AS sku_name",
            "CAST(l_shipdate AS DATE) AS usage_date",
            "l_shipdate AS usage_start_time",
            "l_quantity AS usage_quantity",
            "CASE WHEN l_linestatus = 'F' THEN 'JOBS' ELSE 'SQL' END AS billing_origin_product",
            "named_struct("
            "'job_id', CASE WHEN l_linestatus = 'F' THEN l_suppkey % 150 END,"
            "'job_run_id', CASE WHEN l_linestatus = 'F'"
            " THEN (l_suppkey % 150) * 100 + l_orderkey % 30 + 1 END,"
            "'warehouse_id', CASE WHEN l_linestatus = 'O' THEN concat('wh-', l_suppkey % 7) END"
            ") AS usage_metadata",
            "named_struct('run_as', CASE WHEN l_partkey % 9 <> 0"
            " THEN concat('user', l_partkey % 20) END) AS identity_metadata",
        )

    def list_prices(self) -> DataFrame:
        """Rate card: a literal table, as price lists are."""
        return self.spark.sql(
            "SELECT sku_name, currency_code, CAST(s AS TIMESTAMP_NTZ) AS price_start_time,"
            " CAST(e AS TIMESTAMP_NTZ) AS price_end_time, named_struct('default', p) AS pricing"
            f" FROM VALUES {RATE_CARD} AS t(sku_name, currency_code, s, e, p)"
        )

    def query_history(self) -> DataFrame:
        return (
            self.table("events")
            .selectExpr(
                "*",
                "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
                "CAST(round(value * 1000) AS BIGINT) AS total_duration_ms",
            )
            .selectExpr(*QUERY_COLUMNS)
        )

    def audit(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "ts AS event_time",
            "CAST(ts AS DATE) AS event_date",
            "user_id % 3 AS workspace_id",
            "'acc-1' AS account_id",
            "CASE WHEN event_id % 20 < 9 THEN 'warehouse' ELSE 'catalog' END AS service_name",
            "CASE event_id % 20 WHEN 0 THEN 'createWarehouse' WHEN 7 THEN 'createEndpoint'"
            " WHEN 6 THEN 'deleteWarehouse' WHEN 8 THEN 'editEndpoint' ELSE"
            " CASE WHEN event_id % 20 < 6 THEN 'editWarehouse' ELSE 'getTable' END"
            " END AS action_name",
            "concat('10.0.0.', user_id % 250) AS source_ip_address",
            "named_struct('email', concat('user', user_id, '@example.com')) AS user_identity",
            "map('id', concat('wh-', user_id % 40), 'name', concat('warehouse ', user_id % 40),"
            " 'warehouse_type', CASE WHEN user_id % 2 = 0 THEN 'PRO' ELSE 'CLASSIC' END,"
            " 'auto_stop_mins', CAST(user_id % 60 AS STRING), 'cluster_size', 'Small',"
            " 'min_num_clusters', '1', 'max_num_clusters', CAST(user_id % 5 + 1 AS STRING),"
            " 'channel', '{\"name\":\"CURRENT\"}',"
            " 'full_name_arg', concat('main.sales.t', user_id % 11)) AS request_params",
            "map('status_code', CASE WHEN event_type = 'error' THEN '403' ELSE '200' END,"
            " 'error_message', CASE WHEN event_type = 'error' THEN 'permission denied' END,"
            " 'result', concat('{\"id\":\"wh-', user_id % 40, '\"}')) AS response",
        )

    def event_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "ts AS timestamp",
            "CASE event_type WHEN 'view' THEN 'update_progress' WHEN 'signup' THEN 'create_update'"
            " ELSE 'flow_progress' END AS event_type",
            "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END"
            " AS level",
            "concat(event_type, ' of user ', user_id) AS message",
            "named_struct('pipeline_name', concat('p', user_id % 3), 'update_id', user_id,"
            " 'flow_name', concat('flow_', event_id % 4)) AS origin",
            "CASE event_type"
            " WHEN 'purchase' THEN to_json(named_struct('flow_progress', named_struct("
            "'status', 'COMPLETED', 'metrics', named_struct('num_output_rows', event_id % 1000,"
            " 'num_upserted_rows', event_id % 10, 'num_deleted_rows', event_id % 3),"
            " 'data_quality', named_struct('expectations', array("
            " named_struct('name', 'valid_id', 'dataset', concat('flow_', event_id % 4),"
            " 'passed_records', event_id % 100, 'failed_records', event_id % 7),"
            " named_struct('name', 'valid_time', 'dataset', concat('flow_', event_id % 4),"
            " 'passed_records', event_id % 50, 'failed_records', event_id % 5))))))"
            " WHEN 'click' THEN to_json(named_struct('flow_progress', named_struct("
            "'status', 'RUNNING', 'metrics', named_struct('num_output_rows', event_id % 100,"
            " 'numFilesOutstanding', event_id % 20, 'numBytesOutstanding', event_id % 20 * 1000))))"
            " WHEN 'view' THEN to_json(named_struct('update_progress', named_struct('state',"
            " CASE event_id % 3 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'COMPLETED' ELSE 'FAILED' END)))"
            " WHEN 'signup' THEN to_json(named_struct('create_update',"
            " named_struct('cause', CASE WHEN event_id % 2 = 0 THEN 'USER' ELSE 'JOB' END)))"
            " ELSE to_json(named_struct('error', named_struct('message', concat('bad row ',"
            " event_id), 'exceptions', array(concat('E', event_id % 5))))) END AS details",
        )

    def table_lineage(self) -> DataFrame:
        """Edges region -> nation -> supplier -> part -> brand report, plus one cycle."""
        nation = self.table("nation")
        fixed = "'TABLE' AS source_type", "'TABLE' AS target_type"
        down = nation.selectExpr(
            "concat('geo.region_', n_regionkey) AS source_table_full_name",
            "concat('geo.nation_', n_nationkey) AS target_table_full_name", *fixed,
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS event_time")
        back = nation.filter("n_nationkey = 24").selectExpr(
            "concat('geo.nation_', n_nationkey) AS source_table_full_name",
            "'geo.region_0' AS target_table_full_name", *fixed,
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS event_time")
        sup = self.table("supplier").selectExpr(
            "concat('geo.nation_', s_nationkey) AS source_table_full_name",
            "concat('buy.supplier_', s_suppkey) AS target_table_full_name", *fixed,
            "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS event_time")
        part = self.table("lineitem").selectExpr(
            "concat('buy.supplier_', l_suppkey) AS source_table_full_name",
            "concat('sell.part_', l_partkey) AS target_table_full_name", *fixed,
            "l_shipdate AS event_time")
        brand = self.table("part").selectExpr(
            "concat('sell.part_', p_partkey) AS source_table_full_name",
            "concat('report.', p_brand) AS target_table_full_name", *fixed,
            "TIMESTAMP_NTZ '2024-01-03 00:00:00' AS event_time")
        return down.unionByName(back).unionByName(sup).unionByName(part).unionByName(brand)

    def clusters(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS cluster_id",
            "concat(CASE WHEN s_suppkey % 3 = 0 THEN 'Ops-' ELSE 'dev-' END, s_suppkey)"
            " AS cluster_name",
            "concat('user', s_nationkey) AS owned_by",
            "CASE WHEN s_suppkey % 2 = 0 THEN 'UI' ELSE 'JOB' END AS cluster_source",
            "'15.4' AS runtime_version",
            "concat('node-', s_nationkey % 5) AS worker_node_type",
            "concat('node-', s_nationkey % 4) AS driver_node_type",
            "CAST(floor(abs(s_acctbal) / 100) AS INT) AS auto_termination_minutes",
            "CASE WHEN s_suppkey % 4 <> 0 THEN map('team', concat('t', s_nationkey))"
            " ELSE map('env', 'dev') END AS tags",
            "timestampadd(DAY, -CAST(s_suppkey % 60 AS INT), TIMESTAMP_NTZ '2024-01-31 00:00:00')"
            " AS change_time",
            "CASE WHEN s_suppkey % 10 = 3 THEN TIMESTAMP_NTZ '2024-01-30 00:00:00' END"
            " AS delete_time",
        )

    def warehouses(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS warehouse_id",
            "concat('wh ', c_name) AS warehouse_name",
            "element_at(array('Small', 'Medium', 'Large'), CAST(c_custkey % 3 AS INT) + 1)"
            " AS warehouse_size",
            "CAST(floor(abs(c_acctbal) / 200) AS INT) AS auto_stop_minutes",
            "CASE WHEN c_custkey % 9 = 2 THEN TIMESTAMP_NTZ '2024-01-15 00:00:00' END"
            " AS delete_time",
        )

    def workspaces(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "'acc-1' AS account_id", "n_nationkey AS workspace_id",
            "CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS workspace_name",
            "concat('https://', lower(n_name), '.example.com') AS workspace_url",
            "CASE WHEN n_nationkey % 6 = 0 THEN 'CANCELLED' ELSE 'RUNNING' END AS status")

    def warehouse_events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id % 3 AS workspace_id", "concat('wh-', user_id % 7) AS warehouse_id",
            "CASE event_type WHEN 'click' THEN 'SCALED_UP' WHEN 'view' THEN 'SCALED_DOWN'"
            " ELSE 'RUNNING' END AS event_kind",
            "CAST(event_id % 4 AS INT) AS cluster_count", "ts AS event_time")

    def maintenance_ops(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id", "concat('c', user_id % 2) AS catalog_name",
            "concat('t', user_id) AS table_name",
            "CASE WHEN event_id % 2 = 0 THEN 'COMPACTION' ELSE 'CLEANUP' END AS operation_type",
            "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESSFUL' END"
            " AS operation_status",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS files_rewritten",
            "ts AS start_time",
            "timestampadd(SECOND, CAST(round(value) AS INT), ts) AS end_time")

    def log_lines(self) -> DataFrame:
        """Documents as log files: one row per line, file chosen by document and source."""
        return self.table("documents").select(
            F.expr("concat('/logs/', source, '/driver/', CASE doc_id % 3 WHEN 0 THEN 'stdout'"
                   " WHEN 1 THEN 'stderr' ELSE 'log4j-active.log' END)").alias("log_file"),
            F.col("doc_id"),
            F.posexplode(F.split("text", "\n")).alias("line_no", "log_line"),
        )


# Rate card rows (sku, currency, start, end, price).
RATE_CARD = """
 ('A', 'USD', '1994-01-01 00:00:00', '1997-01-01 00:00:00', 0.25D),
 ('A', 'USD', '1997-01-01 00:00:00', '2000-06-01 00:00:00', 0.5D),
 ('A', 'USD', '2000-06-01 00:00:00', NULL, 0.75D),
 ('A', 'EUR', '1994-01-01 00:00:00', NULL, 0.2D),
 ('N', 'USD', '1996-03-15 00:00:00', '1999-01-01 00:00:00', 1.0D),
 ('N', 'USD', '1999-01-01 00:00:00', NULL, 1.25D),
 ('R', 'USD', '1995-01-01 00:00:00', '2001-01-01 00:00:00', 2.0D)
"""

INVENTORY_COLUMNS = [
    "CASE WHEN event_id % 97 <> 0 THEN event_id END AS event_id",
    "CASE WHEN event_id % 89 <> 0 THEN user_id END AS product_id",
    "CASE WHEN event_id % 83 <> 0 THEN concat('W', event_id % 5) END AS warehouse",
    "event_type",
    "CAST(floor(value) AS INT) AS quantity_change",
    "CASE WHEN event_id % 101 = 0 THEN ts + INTERVAL '3650' DAY ELSE ts END AS event_timestamp",
]

QUERY_COLUMNS = [
    "'acc-1' AS account_id",
    "user_id % 3 AS workspace_id",
    "event_id",
    "concat('s-', event_id) AS statement_id",
    "concat('user', user_id % 50) AS executed_by",
    "CASE event_type"
    " WHEN 'purchase' THEN concat('/* {\"app\": \"dbt\", \"node_id\": \"model.', user_id,"
    " '\", \"profile_name\": \"ops\", \"target_name\": \"prod\", \"dbt_version\": \"1.8\"} */"
    " select * from gold_order_summary')"
    " WHEN 'click' THEN concat('/* QUERY_TAG:team_', user_id % 4, ' */ select 1')"
    " WHEN 'view' THEN 'SELECT * FROM gold_order_summary WHERE customer_region = ''EMEA'''"
    " WHEN 'error' THEN 'OPTIMIZE gold_order_summary'"
    " ELSE 'DESCRIBE gold_order_summary' END AS statement_text",
    "CASE WHEN event_id % 41 <> 0 THEN 'SELECT' END AS statement_type",
    "CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 13 = 0 THEN 'QUEUED'"
    " ELSE 'FINISHED' END AS execution_status",
    "CASE WHEN event_id % 3 <> 0 THEN 'SQL Editor' END AS client_application",
    "named_struct('warehouse_id', CASE WHEN event_id % 37 <> 0 THEN concat('wh-', user_id % 7) END)"
    " AS compute",
    "ts AS start_time",
    "timestampadd(SECOND, CAST(round(value) AS INT), ts) AS end_time",
    "timestampadd(SECOND, CAST(round(value) AS INT), ts) AS update_time",
    "total_duration_ms",
    "total_duration_ms * 6 div 10 AS execution_duration_ms",
    "total_duration_ms div 10 AS compilation_duration_ms",
    "total_duration_ms div 20 AS waiting_for_compute_duration_ms",
    "CASE WHEN event_id % 4 = 0 THEN total_duration_ms div 5 ELSE 0L END"
    " AS waiting_at_capacity_duration_ms",
    "total_duration_ms div 40 AS result_fetch_duration_ms",
    "CASE WHEN event_id % 17 <> 0 THEN total_duration_ms * 3 END AS total_task_duration_ms",
    "k * 4000000 AS read_bytes",
    "CASE WHEN event_type = 'purchase' THEN k * 1000 ELSE 0L END AS written_bytes",
    "CASE WHEN k > 90 THEN k * 1000000 ELSE 0L END AS spilled_local_bytes",
    "k * 1000 AS read_rows",
    "k * 3 AS produced_rows",
    "k % 10 AS read_files",
    "k % 7 AS pruned_files",
    "k % 3 * 10 AS read_io_cache_percent",
    "event_id % 11 = 0 AS from_result_cache",
    "CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN"
    " '[DIVIDE_BY_ZERO] bad value' ELSE 'plain failure' END END AS error_message",
    "named_struct("
    "'job_info', named_struct('job_id', CASE WHEN event_id % 7 = 0 THEN concat('j', user_id) END),"
    "'legacy_dashboard_id', CASE WHEN event_id % 7 = 1 THEN concat('ld', user_id) END,"
    "'dashboard_id', CASE WHEN event_id % 5 = 2 THEN concat('d', user_id) END,"
    "'alert_id', CASE WHEN event_id % 7 = 3 THEN concat('a', user_id) END,"
    "'notebook_id', CASE WHEN event_id % 7 = 4 THEN concat('n', user_id) END,"
    "'sql_query_id', CASE WHEN event_id % 7 = 5 THEN concat('q', user_id) END,"
    "'genie_space_id', CASE WHEN event_id % 14 = 6 THEN concat('g', user_id) END) AS query_source",
]
