"""Sources, sinks, projections, aggregates, top-k, set operations and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from lakewarden.functions import ago, at, bucket, first_present, since, trunc
from lakewarden.operators.aggregates import count_where, distinct_counts, pctl, share
from lakewarden.operators.sets import keyless_diff, snapshot_diff
from lakewarden.operators.shape import domain, evolve, first_rows, flatten_params, replicate
from lakewarden.plans import retail
from lakewarden.plans.queries import QUERY_SOURCES, query_source
from lakewarden.plans.views import EVENTS_AS_OF
from lakewarden.session import fresh_dir
from lakewarden.sources import files, generators, jsonlines, layout, tables

Y1998 = datetime(1998, 1, 1)


def folder(lake, label):
    return fresh_dir(lake.spark, label)


# -- A: scans, sources, sinks -------------------------------------------------------------------

@query("a01_read_table", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
       "o_totalprice")
def a01(lake):
    return tables.read_table(lake.spark, f"{lake.folder}/orders.parquet", "o_orderdate", Y1998)


@query("a02_read_json", "SELECT event_id, user_id, event_type, value FROM events", "value")
def a02(lake):
    path = folder(lake, "json")
    lake.table("events").select("event_id", "user_id", "event_type", "value").write.json(path)
    return tables.read_json(lake.spark, path)


@query("a05_file_inventory",
       "SELECT source AS folder, true AS has_bytes FROM documents GROUP BY source")
def a05(lake):
    path = folder(lake, "files")
    lake.table("documents").select("source", "text").write.partitionBy("source").text(path)
    listing = files.file_inventory(lake.spark, path)
    data = listing.withColumn("folder", F.regexp_extract("file_path", r"source=([^/]+)/", 1))
    return data.filter("folder <> ''").groupBy("folder").agg(
        (F.sum("size_bytes") > 0).alias("has_bytes"))


# The error patterns searched for in logs, and some that occur in the documents.
LOG_PATTERNS = ["OutOfMemory", "java.lang.Exception", "FATAL", "spill", "http", "License"]


@query("a06_log_search",
       "SELECT log_file, doc_id, line_no, log_line FROM v_logs WHERE "
       + " OR ".join(f"contains(log_line, '{p}')" for p in LOG_PATTERNS))
def a06(lake):
    return files.log_search(lake.log_lines(), LOG_PATTERNS)


@query("a07_log_stream", "SELECT log_line FROM v_logs WHERE log_file LIKE '%driver/stderr'")
def a07(lake):
    return files.log_stream(lake.log_lines(), "driver/stderr")


@query("a10_infer_schema",
       "SELECT * FROM (SELECT 'event_id' AS field, 'BIGINT' AS kind, count(event_id) AS row_count"
       " FROM events UNION ALL SELECT 'event_type', 'STRING', count(event_type) FROM events"
       " UNION ALL SELECT 'mixed', 'VARIANT', count(*) FROM events)")
def a10(lake):
    mixed = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(
        "event_id", "event_type", F.lit(1).alias("mixed")))).otherwise(F.to_json(F.struct(
            "event_id", "event_type", F.lit("x").alias("mixed"))))
    return jsonlines.field_types(lake.table("events").select(mixed.alias("value")))


@query("a23_overwrite_append",
       "SELECT channel, 2 * count(*) AS row_count FROM v_orders GROUP BY channel")
def a23(lake):
    path = folder(lake, "table")
    rows = lake.orders().select("order_id", "channel")
    tables.write_table(rows, path, "append")
    tables.write_table(rows, path, "overwrite")
    tables.write_table(rows, path, "append")
    return tables.read_table(lake.spark, path).groupBy("channel").agg(
        F.count("*").alias("row_count"))


@query("a24_application_log",
       "SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS \"timestamp\", CASE WHEN event_type = 'error'"
       " THEN 'ERROR' ELSE 'INFO' END AS level, 'my_etl' AS logger,"
       " event_type || ' ' || event_id AS message, CAST(user_id AS VARCHAR) AS job_run_id"
       " FROM events ORDER BY ts DESC LIMIT 20")
def a24(lake):
    path = folder(lake, "applog")
    rows = lake.table("events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.lit("my_etl").alias("logger"),
        F.concat_ws(" ", "event_type", "event_id").alias("message"),
        F.col("user_id").cast("string").alias("job_run_id"))
    for level in ("ERROR", "INFO"):
        tables.write_table(rows.filter(F.col("level") == level), path, "append")
    log = tables.read_table(lake.spark, path)
    return first_rows(log, [F.desc("timestamp"), F.col("message")], 20)


@query("a25_create_from_query",
       "SELECT * FROM v_orders WHERE order_timestamp >= TIMESTAMP '2000-01-01'",
       "unit_price total_amount")
def a25(lake):
    orders = lake.orders()
    recent = orders.filter(F.col("order_timestamp") >= at(orders, "order_timestamp",
                                                          datetime(2000, 1, 1)))
    return tables.materialise(recent, folder(lake, "ctas"))


@query("a26_json_sample", "SELECT least(count(*), 10000) AS row_count FROM events")
def a26(lake):
    path = folder(lake, "sample")
    tables.write_json_sample(lake.table("events").select("event_id", "value"), 10_000, path)
    return tables.read_json(lake.spark, path, "event_id bigint, value double").agg(
        F.count("*").alias("row_count"))


@query("a27_run_noop", "SELECT count(*) AS row_count FROM v_gold")
def a27(lake):
    gold = retail.gold_orders(lake.order_lines(), lake.customers(), lake.products())
    tables.run_noop(gold)
    return gold.agg(F.count("*").alias("row_count"))


@query("a28_snapshot_tables",
       "SELECT 'jobs' AS name, count(*) AS row_count FROM v_jobs UNION ALL"
       " SELECT 'job_runs', count(*) FROM v_runs"
       " WHERE period_start_time >= TIMESTAMP '2024-01-24' UNION ALL"
       " SELECT 'query_history', count(*) FROM v_history"
       " WHERE start_time >= TIMESTAMP '2024-01-01'")
def a28(lake):
    sources = {"jobs": lake.jobs(), "job_runs": lake.job_runs(),
               "query_history": lake.query_history()}
    paths = tables.snapshot_tables(
        sources, folder(lake, "snap"), EVENTS_AS_OF,
        {"job_runs": ("period_start_time", 7), "query_history": ("start_time", 30)})
    out = None
    for name, path in paths.items():
        row = lake.spark.read.parquet(path).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def unit(seed: int, key: str = "id") -> str:
    return (f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT)"
            " / CAST(4294967296 AS DOUBLE))")


def floored(u: str, n: int) -> str:
    return f"CAST(floor({u} * {n}) AS INTEGER)"


LINE_IDS = "SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem"
U42 = unit(42)


@query("a29_skewed_orders",
       "SELECT promo_code, count(*) AS row_count, sum(order_total) AS total, min(customer_id) AS"
       " first_customer, max(order_date) AS last_day FROM (SELECT 'P' || lpad(CAST(CASE WHEN"
       f" {U42} < 0.7 THEN 0 WHEN {U42} < 0.85 THEN 1 ELSE 2 + least(7, CAST(floor(({U42} - 0.85)"
       " / 0.15 * 8) AS INTEGER)) END AS VARCHAR), 2, '0') AS promo_code,"
       f" 'CUST-' || lpad(CAST({floored(unit(44), 50_000)} AS VARCHAR), 6, '0') AS customer_id,"
       f" round({unit(43)} * 280 + 20, 2) AS order_total,"
       f" DATE '2024-01-01' + {floored(unit(45), 451)} AS order_date FROM ({LINE_IDS}))"
       " GROUP BY promo_code", "total")
def a29(lake):
    ids = lake.table("lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS id")
    return generators.skewed_orders(ids).groupBy("promo_code").agg(
        F.count("*").alias("row_count"), F.sum("order_total").alias("total"),
        F.min("customer_id").alias("first_customer"), F.max("order_date").alias("last_day"))


@query("a30_replicate",
       "SELECT channel, 3 * count(*) AS row_count, 3 * count(*) AS ids FROM v_orders"
       " GROUP BY channel")
def a30(lake):
    copies = replicate(lake.orders().select("order_id", "channel"), 3, "batch_id", ["order_id"])
    return copies.groupBy("channel").agg(F.count("*").alias("row_count"),
                                         F.countDistinct("batch_id").alias("ids"))


@query("a31_retail_orders",
       "SELECT count(*) AS row_count,"
       f" count(*) FILTER ({unit(42)} < 0.02) AS null_keys,"
       f" count(*) FILTER ({unit(45)} < 0.01) AS negative,"
       f" count(*) FILTER ({unit(50)} < 0.005) AS future,"
       f" sum(round((CASE WHEN {unit(45)} < 0.01 THEN -1 ELSE 1 END *"
       f" ({floored(unit(46), 5)} + 1)) * round({unit(47)} * 230 + 19.99, 2), 2)) AS total,"
       f" max(TIMESTAMP '2024-01-01' + to_days(CASE WHEN {unit(50)} < 0.005 THEN"
       f" {floored(unit(51), 335)} + 36500 ELSE {floored(unit(51), 451)} END)) AS last_time"
       " FROM (SELECT o_orderkey AS id FROM orders)", "total")
def a31(lake):
    ids = lake.table("orders").selectExpr("o_orderkey AS id")
    rows = generators.retail_orders(ids)
    return rows.agg(
        F.count("*").alias("row_count"), count_where(F.col("customer_id").isNull())
        .alias("null_keys"), count_where(F.col("quantity") < 0).alias("negative"),
        count_where(F.col("order_timestamp") > at(rows, "order_timestamp", datetime(2100, 1, 1)))
        .alias("future"), F.sum("total_amount").alias("total"),
        F.max("order_timestamp").alias("last_time"))


def reason_sql(seed: int) -> str:
    names = ", ".join(f"'{r}'" for r in generators.REASONS)
    return f"([{names}])[{floored(unit(seed + 2), 6)} + 1]"


def returns_sql(variant: int) -> str:
    seed = 99 + 100 * variant
    amount = f"round({unit(seed + 4)} * 235 + 15, 2)"
    own = {1: f"{amount} AS refund_amount, CAST(NULL AS BIGINT) AS score",
           2: f"{amount} AS refund_amount, CAST({floored(unit(seed + 5), 5)} + 1 AS BIGINT)"
              " AS score",
           3: "CAST(NULL AS DOUBLE) AS refund_amount, CAST(NULL AS BIGINT) AS score",
           4: "CAST(NULL AS DOUBLE) AS refund_amount, CAST(NULL AS BIGINT) AS score"}[variant]
    return (f"SELECT {variant} AS variant, {reason_sql(seed)} AS return_reason, {own}"
            " FROM (SELECT event_id AS id FROM events)")


@query("a32_returns",
       "SELECT variant, return_reason, count(*) AS row_count, sum(refund_amount) AS refunds,"
       " CAST(sum(score) AS BIGINT) AS score FROM ("
       + " UNION ALL ".join(map(returns_sql, (1, 2, 3, 4))) + ") GROUP BY variant, return_reason",
       "refunds")
def a32(lake):
    ids = lake.table("events").selectExpr("event_id AS id")
    out = None
    for variant in (1, 2, 3, 4):
        lines = generators.returns(ids, variant)
        rows = lines.select(
            F.lit(variant).alias("variant"),
            F.get_json_object("value", "$.return_reason").alias("return_reason"),
            F.get_json_object("value", "$.refund_amount").try_cast("double")
            .alias("refund_amount"),
            F.get_json_object("value", "$.customer_satisfaction_score").try_cast("bigint")
            .alias("score"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("variant", "return_reason").agg(
        F.count("*").alias("row_count"), F.sum("refund_amount").alias("refunds"),
        F.sum("score").alias("score"))


# -- B: projections, filters, predicates --------------------------------------------------------

@query("b01_projection",
       "SELECT order_id, customer_id AS buyer, total_amount AS amount FROM v_orders", "amount")
def b01(lake):
    return lake.orders().select("order_id", F.col("customer_id").alias("buyer"),
                                F.col("total_amount").alias("amount"))


@query("b02_comparison",
       "SELECT order_id, customer_id, quantity, total_amount, channel, region, order_timestamp"
       " FROM v_orders WHERE order_timestamp >= TIMESTAMP '1998-06-01' AND total_amount > 50000",
       "total_amount")
def b02(lake):
    return retail.extract_orders(lake.orders(), datetime(1998, 6, 1), 50_000)


@query("b03_null_test",
       "SELECT (customer_id IS NULL) AS missing, count(*) AS row_count FROM v_orders GROUP BY 1")
def b03(lake):
    return lake.orders().groupBy(F.col("customer_id").isNull().alias("missing")).agg(
        F.count("*").alias("row_count"))


@query("b04_in_list",
       "SELECT event_id, action_name FROM v_audit"
       " WHERE action_name IN ('createWarehouse', 'deleteWarehouse')")
def b04(lake):
    return lake.audit().filter(F.col("action_name").isin("createWarehouse", "deleteWarehouse")
                               ).select("event_id", "action_name")


@query("b05_like",
       "SELECT statement_id, statement_text FROM v_history WHERE statement_text LIKE"
       " '%gold_order_summary%' AND statement_text NOT LIKE '%OPTIMIZE%' AND"
       " (statement_text LIKE 'SELECT%' OR statement_text LIKE '%dbt%')")
def b05(lake):
    text = F.col("statement_text")
    return lake.query_history().filter(
        text.like("%gold_order_summary%") & ~text.contains("OPTIMIZE")
        & (text.startswith("SELECT") | text.contains("dbt"))).select("statement_id", text)


@query("b06_time_window",
       "SELECT 'minutes' AS unit, count(*) AS row_count FROM events"
       " WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 90 MINUTE UNION ALL"
       " SELECT 'hours', count(*) FROM events"
       " WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR UNION ALL"
       " SELECT 'days', count(*) FROM events"
       " WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY")
def b06(lake):
    noon = datetime(2024, 1, 30, 12)
    events = lake.table("events")
    edges = {"minutes": 90, "hours": 24, "days": 7}
    widest = since(events, "ts", noon, 7, "days")
    counts = widest.agg(*[
        F.count_if(F.col("ts") >= at(events, "ts", ago(noon, n, unit))).alias(unit)
        for unit, n in edges.items()])
    return counts.unpivot([], list(edges), "unit", "row_count")


@query("b07_struct_fields",
       "SELECT usage_date, sku_name, job_id, run_id, run_as FROM v_usage WHERE job_id IS NOT NULL")
def b07(lake):
    return lake.usage().filter("usage_metadata.job_id IS NOT NULL").select(
        "usage_date", "sku_name", F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("run_id"),
        F.col("identity_metadata.run_as").alias("run_as"))


@query("b08_bucket",
       "SELECT CASE WHEN total_amount > 400000 THEN 'HIGH' WHEN total_amount > 200000 THEN"
       " 'MEDIUM' ELSE 'OK' END AS label, count(*) AS row_count FROM v_orders GROUP BY 1")
def b08(lake):
    label = bucket(F.col("total_amount"), [(400_000, "HIGH"), (200_000, "MEDIUM")], "OK")
    return lake.orders().groupBy(label.alias("label")).agg(F.count("*").alias("row_count"))


SOURCE_IDS = ["src_job", "src_legacy", "src_dashboard", "src_alert", "src_notebook", "src_query",
              "src_space"]
SOURCE_SQL = (
    "CASE " + " ".join(f"WHEN {column} IS NOT NULL THEN '{label}'"
                       for column, (_, label) in zip(SOURCE_IDS, QUERY_SOURCES, strict=True))
    + " ELSE coalesce(client_application, 'UNKNOWN') END AS query_source_type,"
    f" coalesce({', '.join(SOURCE_IDS)}, 'UNKNOWN') AS query_source_id")


@query("b09_query_source", f"SELECT statement_id, {SOURCE_SQL} FROM v_history")
def b09(lake):
    return query_source(lake.query_history()).select("statement_id", "query_source_type",
                                                     "query_source_id")


@query("b10_lateral_alias",
       "SELECT order_id, total_amount * 0.9::DOUBLE AS net, total_amount * 0.9::DOUBLE * 2 AS"
       " double_net FROM v_orders", "net double_net")
def b10(lake):
    return lake.spark.sql(
        "SELECT order_id, total_amount * 0.9D AS net, net * 2 AS double_net FROM {orders}",
        orders=lake.orders())


@query("b11_evolve",
       "SELECT order_id, customer_id, quantity, unit_price, total_amount AS order_total, channel,"
       " status, order_timestamp, 'EUR' AS currency FROM v_orders", "unit_price order_total")
def b11(lake):
    return evolve(lake.orders(), {"total_amount": "order_total"}, {"currency": F.lit("EUR")},
                  ["region"])


@query("b12_channel_report",
       "SELECT channel, count(order_id) AS order_count, sum(total_amount) AS total_revenue"
       " FROM v_orders WHERE region = 'APAC' AND order_timestamp >= TIMESTAMP '1998-01-01'"
       " GROUP BY channel", "total_revenue")
def b12(lake):
    return retail.channel_report(lake.orders(), "APAC", Y1998)


@query("b13_optional_filter",
       "SELECT 'all' AS call, count(*) AS row_count FROM part UNION ALL"
       " SELECT 'city', count(*) FROM part WHERE p_brand = 'Brand#2' UNION ALL"
       " SELECT 'both', count(*) FROM part WHERE p_brand = 'Brand#2' AND contains(p_name, 'ring')")
def b13(lake):
    stock = lake.table("part").select(F.col("p_brand").alias("city"), F.col("p_name").alias("part"))
    calls = {"all": (None, None), "city": ("Brand#2", None), "both": ("Brand#2", "ring")}
    out = None
    for name, (city, term) in calls.items():
        row = retail.stock_lookup(stock, city, term).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("call"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("b14_domain", "SELECT DISTINCT region FROM v_orders")
def b14(lake):
    return domain(lake.orders(), "region")


# -- D: aggregates ------------------------------------------------------------------------------

@query("d01_count_sum", "SELECT channel, count(*) AS order_count, sum(total_amount) AS revenue"
       " FROM v_orders GROUP BY channel", "revenue")
def d01(lake):
    return retail.channel_revenue(lake.orders())


@query("d02_count_distinct",
       "SELECT channel, count(DISTINCT customer_id) AS customers, count(DISTINCT region) AS"
       " regions, count(DISTINCT status) AS states FROM v_orders GROUP BY channel")
def d02(lake):
    return distinct_counts(lake.orders(), ["channel"], {
        "customers": "customer_id", "regions": "region", "states": "status"})


@query("d03_spread",
       "SELECT channel, avg(total_amount) AS mean, min(total_amount) AS low, max(total_amount) AS"
       " high, stddev(total_amount) AS spread FROM v_orders GROUP BY channel",
       "mean low high spread")
def d03(lake):
    return lake.orders().groupBy("channel").agg(
        F.avg("total_amount").alias("mean"), F.min("total_amount").alias("low"),
        F.max("total_amount").alias("high"), F.stddev("total_amount").alias("spread"))


@query("d04_percentiles",
       "SELECT event_type, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50,"
       " quantile_disc(value, 0.75) AS p75, quantile_disc(value, 0.95) AS p95 FROM events"
       " GROUP BY event_type", "p25 p50 p75 p95")
def d04(lake):
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    return lake.table("events").groupBy("event_type").agg(
        *[pctl("value", p).alias(name) for name, p in shares.items()])


@query("d05_conditional",
       "SELECT workspace_id, count(*) FILTER (execution_status = 'FAILED') AS failed,"
       " CAST(sum(CASE WHEN waiting_at_capacity_duration_ms > 5000 THEN 1 ELSE 0 END) AS BIGINT)"
       " AS waited FROM v_history GROUP BY workspace_id")
def d05(lake):
    return lake.query_history().groupBy("workspace_id").agg(
        count_where(F.col("execution_status") == "FAILED").alias("failed"),
        count_where(F.col("waiting_at_capacity_duration_ms") > 5000).alias("waited"))


@query("d07_first_non_null",
       "SELECT job_id, run_id, max(run_as) AS run_as FROM v_usage WHERE job_id IS NOT NULL"
       " GROUP BY job_id, run_id")
def d07(lake):
    return lake.usage().filter("usage_metadata.job_id IS NOT NULL").groupBy(
        F.col("usage_metadata.job_id").alias("job_id"),
        F.col("usage_metadata.job_run_id").alias("run_id"),
    ).agg(F.max("identity_metadata.run_as").alias("run_as"))


@query("d08_interval_sum",
       "SELECT job_id, CAST(sum(epoch(period_end_time) - epoch(period_start_time)) AS DOUBLE)"
       " AS seconds FROM v_runs GROUP BY job_id", "seconds")
def d08(lake):
    total = F.sum(F.col("period_end_time") - F.col("period_start_time"))
    return lake.job_runs().groupBy("job_id").agg(total.alias("run_time")).select(
        "job_id", F.expr("CAST(extract(SECOND FROM run_time) + 60 * extract(MINUTE FROM run_time)"
                         " + 3600 * extract(HOUR FROM run_time)"
                         " + 86400 * extract(DAY FROM run_time) AS DOUBLE)").alias("seconds"))


@query("d09_group_by_all",
       "SELECT workspace_id, result_state, CAST(period_start_time AS DATE) AS day,"
       " count(*) AS row_count FROM v_runs GROUP BY ALL")
def d09(lake):
    return lake.spark.sql(
        "SELECT workspace_id, result_state, to_date(period_start_time) AS day, count(*) AS"
        " row_count FROM {runs} GROUP BY ALL", runs=lake.job_runs())


@query("d10_having",
       "SELECT job_id, run_id, count(*) - 1 AS retries_count FROM v_runs GROUP BY job_id, run_id"
       " HAVING count(*) - 1 > 0")
def d10(lake):
    return lake.job_runs().groupBy("job_id", "run_id").agg(
        (F.count("*") - 1).alias("retries_count")).filter("retries_count > 0")


@query("d11_global",
       "SELECT count(*) AS row_count, count(*) FILTER (customer_id IS NULL) AS null_keys,"
       " max(order_timestamp) AS newest FROM v_orders")
def d11(lake):
    return lake.orders().agg(
        F.count("*").alias("row_count"),
        count_where(F.col("customer_id").isNull()).alias("null_keys"),
        F.max("order_timestamp").alias("newest"))


@query("d13_share",
       "SELECT region, count(*) AS row_count, round(count(*) * 100.0::DOUBLE / (SELECT count(*)"
       " FROM v_orders), 2) AS pct FROM v_orders GROUP BY region", "pct")
def d13(lake):
    return share(lake.orders(), ["region"])


# -- F: sorts, limits, top-k --------------------------------------------------------------------

@query("f01_order_by",
       "SELECT region, channel, count(*) AS row_count FROM v_orders GROUP BY ALL")
def f01(lake):
    return lake.orders().groupBy("region", "channel").agg(F.count("*").alias("row_count")).orderBy(
        F.desc("row_count"), "region")


@query("f02_top_k",
       "SELECT order_id, total_amount FROM v_orders ORDER BY total_amount DESC, order_id LIMIT 10",
       "total_amount")
def f02(lake):
    return first_rows(lake.orders().select("order_id", "total_amount"),
                      [F.desc("total_amount"), F.col("order_id")], 10)


@query("f03_nulls_last",
       "SELECT order_id, customer_id FROM v_orders ORDER BY customer_id DESC NULLS LAST, order_id"
       " LIMIT 20")
def f03(lake):
    return first_rows(lake.orders().select("order_id", "customer_id"),
                      [F.desc_nulls_last("customer_id"), F.col("order_id")], 20)


@query("f04_limit", "SELECT order_id, status FROM v_orders ORDER BY order_id LIMIT 10")
def f04(lake):
    return lake.orders().select("order_id", "status").orderBy("order_id").limit(10)


# -- G: set operations --------------------------------------------------------------------------

@query("g01_union_shapes",
       "SELECT 'customer' AS kind, region AS place, count(*) AS row_count FROM v_customers"
       " GROUP BY region UNION ALL SELECT 'order', region, count(*) FROM v_orders GROUP BY region")
def g01(lake):
    def counted(df, kind):
        return df.groupBy(F.col("region").alias("place")).agg(
            F.count("*").alias("row_count")).withColumn("kind", F.lit(kind))
    return counted(lake.customers(), "customer").unionByName(counted(lake.orders(), "order"))


@query("g03_union_subsets",
       "SELECT event_id, 'create' AS kind FROM v_audit WHERE action_name = 'createWarehouse'"
       " UNION ALL SELECT event_id, 'edit' FROM v_audit WHERE action_name = 'editWarehouse'"
       " UNION ALL SELECT event_id, 'delete' FROM v_audit WHERE action_name = 'deleteWarehouse'")
def g03(lake):
    # One scan: the subsets are told apart by a label instead of being read three times.
    action = F.col("action_name")
    kind = first_present([(F.nullif(action == f"{k}Warehouse", F.lit(False)), F.lit(k))
                          for k in ("create", "edit", "delete")], F.lit(None).cast("string"))
    return lake.audit().select("event_id", kind.alias("kind")).filter("kind IS NOT NULL")


@query("g04_distinct", "SELECT DISTINCT source_table_full_name, target_table_full_name"
       " FROM v_lineage")
def g04(lake):
    return lake.table_lineage().select("source_table_full_name",
                                       "target_table_full_name").distinct()


# Two states of the orders: the old one ends with the year 2000, the new one has the rest, lacks
# the low-priority orders of one region, and has another status for open orders.
OLD_SQL = "SELECT * FROM v_orders WHERE order_timestamp < TIMESTAMP '2001-01-01'"
NEW_SQL = ("SELECT * REPLACE (CASE WHEN status = 'P' THEN 'X' ELSE status END AS status)"
           " FROM v_orders WHERE NOT (channel = '5-LOW' AND region = 'LATAM')")


def until_2000(orders):
    return orders.filter(F.col("order_timestamp") < at(orders, "order_timestamp",
                                                       datetime(2001, 1, 1)))


def two_states(lake):
    orders = lake.orders()
    new = orders.filter("NOT (channel = '5-LOW' AND region = 'LATAM')").withColumn(
        "status", F.when(F.col("status") == "P", "X").otherwise(F.col("status")))
    return until_2000(orders), new


@query("g05_snapshot_diff",
       f"SELECT coalesce(o.order_id, n.order_id) AS order_id, CASE WHEN o.order_id IS NULL THEN"
       " 'added' WHEN n.order_id IS NULL THEN 'removed' ELSE 'changed' END AS change"
       f" FROM ({OLD_SQL}) AS o FULL JOIN ({NEW_SQL}) AS n ON o.order_id = n.order_id"
       " WHERE o.order_id IS NULL OR n.order_id IS NULL OR o.status <> n.status")
def g05(lake):
    return snapshot_diff(*two_states(lake), ["order_id"])


@query("g05_keyless_diff",
       f"SELECT channel, status, abs(n) AS copies, CASE WHEN n > 0 THEN 'added' ELSE 'removed' END"
       " AS change FROM (SELECT channel, status, CAST(sum(w) AS BIGINT) AS n FROM ("
       f"SELECT channel, status, -1 AS w FROM ({OLD_SQL}) UNION ALL SELECT channel, status, 1"
       f" FROM ({NEW_SQL})) GROUP BY channel, status) WHERE n <> 0")
def g05_keyless(lake):
    old, new = two_states(lake)
    return keyless_diff(old.select("channel", "status"), new.select("channel", "status"))


# -- H: scalar functions ------------------------------------------------------------------------

@query("h01_strings",
       "SELECT event_id, 'W' || coalesce(client_application, '?') AS joined,"
       " substring(statement_text, 1, 12) AS head, instr(statement_text, 'gold') AS place,"
       " regexp_extract(error_message, '\\[(.*?)\\]', 1) AS error_class,"
       " regexp_replace(statement_text, '[0-9]+', '#', 'g') AS masked, lower(statement_text) AS low,"
       " lpad(CAST(event_id AS VARCHAR), 8, '0') AS padded FROM v_history")
def h01(lake):
    text = F.col("statement_text")
    return lake.query_history().select(
        "event_id", F.concat(F.lit("W"), F.coalesce("client_application", F.lit("?")))
        .alias("joined"), F.substring(text, 1, 12).alias("head"),
        F.instr(text, "gold").cast("bigint").alias("place"),
        F.regexp_extract("error_message", r"\[(.*?)\]", 1).alias("error_class"),
        F.regexp_replace(text, "[0-9]+", "#").alias("masked"),
        F.lower(text).alias("low"),
        F.lpad(F.col("event_id").cast("string"), 8, "0").alias("padded"))


@query("h05_format_number",
       "SELECT channel, format('{:,}', count(*)) AS row_count FROM v_orders GROUP BY channel")
def h05(lake):
    return lake.orders().groupBy("channel").agg(
        F.format_number(F.count("*"), 0).alias("row_count"))


@query("h06_times",
       "SELECT event_id, date_trunc('month', ts)::TIMESTAMP AS month, date_trunc('week',"
       " ts)::TIMESTAMP AS week, date_trunc('day', ts)::TIMESTAMP AS day, date_trunc('hour',"
       " ts)::TIMESTAMP AS hour, date_trunc('minute', ts)::TIMESTAMP AS minute, CAST(ts AS DATE)"
       " AS date, CAST(ts AS DATE) + 7 AS next_week,"
       " CAST(floor(epoch(TIMESTAMP '2024-02-01' - ts) / 60) AS BIGINT) AS minutes FROM events")
def h06(lake):
    events, ts = lake.table("events"), F.col("ts")
    return events.select(
        "event_id", *[trunc(events, u, "ts").alias(u)
                      for u in ("month", "week", "day", "hour", "minute")],
        F.to_date(ts).alias("date"),
        F.date_add(F.to_date(ts), 7).alias("next_week"),
        F.expr("timestampdiff(MINUTE, ts, TIMESTAMP_NTZ '2024-02-01 00:00:00')").alias("minutes"))


@query("h12_numbers",
       "SELECT order_id, round(total_amount / 3, 3) AS third, quantity // nullif(quantity - 2, 0)"
       " AS safe FROM v_orders", "third")
def h12(lake):
    return lake.orders().select(
        "order_id", F.round(F.col("total_amount") / 3, 3).alias("third"),
        F.expr("quantity div nullif(quantity - 2, 0)").cast("int").alias("safe"))


@query("h14_collections",
       "SELECT event_id, unnest(range(1, 4)) AS step, (['a', 'b', 'c'])[event_id % 3 + 1] AS pick"
       " FROM events")
def h14(lake):
    return lake.table("events").select(
        "event_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))).alias("step"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")),
                     (F.col("event_id") % 3 + 1).cast("int")).alias("pick"))


@query("h16_json_and_maps",
       "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,"
       " 'warehouse ' || (user_id % 40) AS name FROM events")
def h16(lake):
    events = lake.table("events").select(
        "event_id", F.from_json("props", "map<string,bigint>")["k"].alias("k"))
    names = lake.audit().select("event_id", F.col("request_params")["name"].alias("name"))
    return events.join(names, "event_id")


@query("h20_file_metadata", "SELECT 'events.parquet' AS file_name, count(*) AS row_count"
       " FROM events")
def h20(lake):
    return lake.table("events").groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count("*").alias("row_count"))


@query("i10_flatten_params",
       "SELECT event_id, event_type AS page, CAST(json_extract_string(props, '$.k') AS BIGINT) AS"
       " clicks, CAST(NULL AS VARCHAR) AS missing FROM events")
def i10(lake):
    params = F.array(
        F.struct(F.lit("page").alias("key"), F.col("event_type").alias("value")),
        F.struct(F.lit("clicks").alias("key"),
                 F.get_json_object("props", "$.k").alias("value")))
    nested = lake.table("events").select("event_id", params.alias("event_params"))
    return flatten_params(nested, "event_params",
                          {"page": "string", "clicks": "bigint", "missing": "string"})


# -- layout of files ----------------------------------------------------------------------------

@query("k23_compact", "SELECT count(*) AS row_count, sum(value) AS total, true AS fewer_files"
       " FROM events", "total")
def k23(lake):
    small, packed = folder(lake, "small"), folder(lake, "packed")
    lake.table("events").repartition(24, "event_id").write.parquet(small)
    layout.compact(lake.spark, small, packed, 64 << 20)
    before, after = (files.file_inventory(lake.spark, p).filter("file_path LIKE '%.parquet'").agg(
        F.count("*").alias("n")).scalar() for p in (small, packed))
    return lake.spark.read.parquet(packed).agg(
        F.count("*").alias("row_count"), F.sum("value").alias("total")).withColumn(
        "fewer_files", after < before)


def clustered(lake, out):
    events = lake.table("events")
    layout.cluster(events, ["event_type", "ts"], "event_id", out, 8)
    return events


@query("k24_cluster", "SELECT event_type, count(*) AS row_count, min(ts) AS first_ts"
       " FROM events GROUP BY event_type")
def k24(lake):
    out = folder(lake, "clustered")
    clustered(lake, out)
    return lake.spark.read.parquet(out).groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.min("ts").alias("first_ts"))


@query("k25_layout_report", "SELECT count(*) AS row_count, true AS skips_half FROM events")
def k25(lake):
    out = folder(lake, "clustered")
    clustered(lake, out)
    report = files.layout_report(lake.spark, out, "event_type")
    edge = F.lit("view")
    return files.skip_share(report, low=edge, high=edge).select(
        "row_count", (F.col("skip_share") >= 0.5).alias("skips_half"))
