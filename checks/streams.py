"""Streaming ingest, medallion layers and streamed telemetry models."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.joins import SCD_SQL
from checks.registry import query
from checks.reports import J1_DOUBLES, J1_SQL, query_model
from lakewarden.operators import quality
from lakewarden.plans import access, queries
from lakewarden.plans.views import EVENTS_AS_OF, INVENTORY_COLUMNS
from lakewarden.session import fresh_dir
from lakewarden.sources.jsonlines import unrescue
from lakewarden.streaming import ingest, ledger, logs, medallion, merged, refine
from lakewarden.streaming.profile import profile_stream

BASE = ["event_id", "event_type", "value"]


def job(lake, mode, **settings):
    root = fresh_dir(lake.spark, "ingest")
    return ingest.Ingest(f"{root}/landing", f"{root}/table", f"{root}/checkpoint",
                         f"{root}/schema", mode=mode, **settings)


def land(df, path, *columns):
    """Add rows as JSON lines to a landing folder."""
    df.select(F.to_json(F.struct(*columns)).alias("value")).write.mode("append").text(path)


def halves(lake):
    """All events as two arrivals, the first up to the middle of the month."""
    events = lake.table("events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    return events.filter(early), events.filter(~early)


def two_batches(lake, mode, *second, **settings):
    """Ingest the first arrival, then the second with other columns."""
    setup = job(lake, mode, **settings)
    first, later = halves(lake)
    land(first, setup.source, *BASE)
    setup.run(lake.spark)
    land(later, setup.source, *second)
    try:
        setup.run(lake.spark)
    except ingest.NewFieldsError:
        pass
    return ingest.read_ingested(lake.spark, setup)


def named(text, name):
    return F.expr(text).alias(name)


@query("a09_ingest", "SELECT event_id, event_type, value, CAST(NULL AS VARCHAR) AS _rescued_data"
       " FROM events", "value")
def a09(lake):
    return two_batches(lake, ingest.ADD, *BASE)


@query("a11_evolve_add",
       "SELECT event_id, event_type, value, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN user_id % 5 + 1 END AS"
       " score FROM events", "value")
def a11(lake):
    rows = two_batches(lake, ingest.ADD, *BASE, named("user_id % 5 + 1", "score"))
    return rows.drop("_rescued_data")


RENAMED = ["event_id", "event_type"]


def renamed(lake):
    return two_batches(lake, ingest.RESCUE_MODE, *RENAMED, F.col("value").alias("amount"),
                       named("concat('user', user_id)", "origin"))


@query("a12_rescue",
       "SELECT event_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN value END AS value,"
       " ts >= TIMESTAMP '2024-01-15' AS rescued, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value"
       " END AS amount, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'user' || user_id END AS origin"
       " FROM events", "value amount")
def a12(lake):
    kept = unrescue(renamed(lake), {"amount": "double", "origin": "string"})
    return kept.select("event_id", "event_type", "value",
                       F.col("_rescued_data").isNotNull().alias("rescued"),
                       F.col("rescued_amount").alias("amount"),
                       F.col("rescued_origin").alias("origin"))


@query("a13_fail_on_new", "SELECT event_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-15'",
       "value")
def a13(lake):
    rows = two_batches(lake, ingest.FAIL, *BASE, named("user_id % 5 + 1", "score"))
    return rows.drop("_rescued_data")


@query("a14_ignore_new", "SELECT event_id, event_type, value FROM events", "value")
def a14(lake):
    return two_batches(lake, ingest.NONE, *BASE, named("user_id % 5 + 1", "score"), rescue=False)


@query("a15_type_drift",
       "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN value END AS value, CASE WHEN ts >="
       " TIMESTAMP '2024-01-15' THEN '{\"value\":\"EUR ' || user_id || '\"}' END AS _rescued_data FROM events",
       "value")
def a15(lake):
    rows = two_batches(lake, ingest.RESCUE_MODE, "event_id", "event_type",
                       named("concat('EUR ', user_id)", "value"))
    return rows.drop("event_type")


@query("a16_unrescue",
       "SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value END AS rescued_amount, CASE WHEN"
       " ts >= TIMESTAMP '2024-01-15' THEN 'user' || user_id END AS rescued_origin FROM events",
       "rescued_amount")
def a16(lake):
    rows = unrescue(renamed(lake), {"amount": "double", "origin": "string"})
    return rows.select("event_id", "rescued_amount", "rescued_origin")


def by_type(lake, types=None):
    """An ingest whose landing folder has one sub-folder per event type."""
    setup = job(lake, ingest.ADD)
    events = lake.table("events")
    first = events if types is None else events.filter(F.col("event_type").isin(types))
    return setup, first, events


def land_by_type(df, path):
    df.select("event_type", F.to_json(F.struct("event_id", "value")).alias("value")).repartition(
        "event_type").write.mode("append").partitionBy("event_type").text(path)


def type_of(path_column):
    return F.regexp_extract(path_column, r"event_type=([^/]+)/", 1)


@query("a17_processed_files",
       "SELECT event_type, count(*) AS row_count, true AS committed, true AS has_size FROM events"
       " GROUP BY event_type")
def a17(lake):
    setup, first, _ = by_type(lake)
    land_by_type(first, setup.source)
    setup.run(lake.spark)
    done = ledger.processed_files(lake.spark, setup.checkpoint)
    return done.groupBy(type_of("file_path").alias("event_type")).agg(
        F.sum("row_count").alias("row_count"),
        F.bool_and(F.col("committed_at").isNotNull()).alias("committed"),
        F.bool_and(F.col("size_bytes") > 0).alias("has_size"))


LATE = ["signup", "view"]


@query("a18_backlog",
       "SELECT event_type, true AS waiting FROM events WHERE event_type IN ('signup', 'view')"
       " GROUP BY event_type")
def a18(lake):
    setup, first, events = by_type(lake, ["click", "error", "purchase"])
    land_by_type(first, setup.source)
    setup.run(lake.spark)
    land_by_type(events.filter(F.col("event_type").isin(LATE)), setup.source)
    waiting = ledger.backlog_files(lake.spark, setup.source, setup.checkpoint)
    return waiting.filter("file_path LIKE '%.txt'").groupBy(
        type_of("file_path").alias("event_type")).agg(
        (F.sum("size_bytes") > 0).alias("waiting"))


@query("a19_throttle",
       "SELECT count(DISTINCT event_type) AS batches, count(*) AS row_count FROM events")
def a19(lake):
    setup, first, _ = by_type(lake)
    setup.max_files = 1
    land_by_type(first, setup.source)
    setup.run(lake.spark)
    done = ledger.processed_files(lake.spark, setup.checkpoint)
    batches = done.agg(F.countDistinct("batch_id").alias("batches"))
    return ingest.read_ingested(lake.spark, setup).agg(F.count("*").alias("row_count")).withColumn(
        "batches", batches.scalar())


@query("a20_source_cleanup",
       "SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type")
def a20(lake):
    # Files of a finished batch are moved away while later ones arrive; no row is lost or repeated.
    setup = job(lake, ingest.ADD, clean="archive", max_age="30d")
    setup.archive = f"{setup.source}-archive"
    for part in halves(lake):
        land(part, setup.source, *BASE)
        setup.run(lake.spark)
    setup.run(lake.spark)
    return ingest.read_ingested(lake.spark, setup).groupBy("event_type").agg(
        F.count("*").alias("row_count"))


@query("a21_reprocess",
       "SELECT 'appended' AS target, 2 * count(*) AS row_count, count(*) AS ids FROM events UNION"
       " ALL SELECT 'created anew', count(*), count(*) FROM events")
def a21(lake):
    setup = job(lake, ingest.ADD)
    land(lake.table("events"), setup.source, *BASE)
    setup.run(lake.spark)
    out = None
    for name, target in (("appended", None), ("created anew", f"{setup.target}-new")):
        again = ingest.reprocess(lake.spark, setup, f"{setup.checkpoint}-{name[0]}", target)
        row = ingest.read_ingested(lake.spark, again).agg(
            F.count("*").alias("row_count"), F.countDistinct("event_id").alias("ids")).select(
            F.lit(name).alias("target"), "row_count", "ids")
        out = row if out is None else out.unionByName(row)
    return out


def streamed(lake, name, schema_of=None):
    """A driver table as a stream."""
    schema = (schema_of or lake.table(name)).schema
    return refine.stream_table(lake.spark, lake.folder, schema, f"{name}.parquet")


def project(stream, model, label):
    root = fresh_dir(stream.sparkSession, label)
    return refine.stream_project(stream, model, f"{root}/table", f"{root}/checkpoint")


def stored_stream(lake, df, label):
    """A canonical view stored as an append-only table and read as a stream."""
    path = fresh_dir(lake.spark, label)
    df.write.parquet(path)
    return refine.stream_table(lake.spark, path, df.schema)


@query("a22_stream_project", "SELECT event_id, user_id, event_type FROM events")
def a22(lake):
    return project(streamed(lake, "events"),
                   lambda s: s.select("event_id", "user_id", "event_type"), "project")


def inventory_landing(lake):
    path = fresh_dir(lake.spark, "inventory")
    lake.table("events").selectExpr(*INVENTORY_COLUMNS).write.json(path)
    return path


INVENTORY_SQL = ("SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(product_id AS VARCHAR) AS"
                 " product_id, warehouse, event_type, quantity_change,"
                 " date_trunc('millisecond', event_timestamp)::TIMESTAMP AS event_timestamp")


@query("a03_bronze_ingest", f"{INVENTORY_SQL}, true AS traced FROM v_inventory")
def a03(lake):
    root = fresh_dir(lake.spark, "bronze")
    stream = medallion.bronze_ingest(lake.spark, inventory_landing(lake))
    medallion.run_once(stream, f"{root}/table", f"{root}/checkpoint")
    rows = lake.spark.read.parquet(f"{root}/table")
    traced = F.col("_ingested_at").isNotNull() & F.col("_source_file").endswith(".json")
    return rows.withColumn("traced", traced).drop("_ingested_at", "_source_file")


GOLD_SQL = ("SELECT warehouse, CAST(product_id AS VARCHAR) AS product_id, event_type,"
            " CAST(sum(quantity_change) AS BIGINT) AS total_quantity_change, count(*) AS"
            " event_count, date_trunc('millisecond', min(event_timestamp))::TIMESTAMP AS"
            " first_event, date_trunc('millisecond', max(event_timestamp))::TIMESTAMP AS last_event"
            " FROM v_silver GROUP BY ALL")


def layers(lake):
    root = fresh_dir(lake.spark, "medallion")
    return medallion.medallion(lake.spark, inventory_landing(lake), f"{root}/out",
                               f"{root}/checkpoint", EVENTS_AS_OF)


@query("i01_medallion", GOLD_SQL)
def i01(lake):
    return layers(lake)["gold"]


@query("i02_silver_rules", f"{INVENTORY_SQL} FROM v_silver")
def i02(lake):
    return layers(lake)["silver"].drop("_ingested_at", "_source_file")


def dropped_sql() -> str:
    conditions = {"valid_event_id": "event_id IS NOT NULL", "valid_product":
                  "product_id IS NOT NULL", "valid_warehouse": "warehouse IS NOT NULL",
                  "valid_timestamp": "event_timestamp <= TIMESTAMP '2024-01-31'"}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, 'inventory' AS dataset, 'drop' AS action, count(*) FILTER ({c})"
        f" AS passed_records, count(*) FILTER (NOT {c}) AS failed_records FROM v_inventory"
        for name, c in conditions.items())


@query("i02_rule_counts", dropped_sql())
def i02_counts(lake):
    return quality.expectation_report(lake.inventory_events(),
                                      medallion.silver_rules(EVENTS_AS_OF), "inventory")


@query("i02_streamed_rule_counts",
       f"SELECT name, passed_records, failed_records FROM ({dropped_sql()})")
def i02_streamed(lake):
    return layers(lake)["rules"].groupBy("name").agg(
        F.sum("passed_records").alias("passed_records"),
        F.sum("failed_records").alias("failed_records"))


@query("i03_inventory_summary",
       "SELECT warehouse, product_id, event_type, CAST(sum(quantity_change) AS BIGINT) AS"
       " total_quantity_change, count(*) AS event_count, min(event_timestamp) AS first_event,"
       " max(event_timestamp) AS last_event FROM v_inventory GROUP BY ALL")
def i03(lake):
    root = fresh_dir(lake.spark, "summary")
    stream = streamed(lake, "events").selectExpr(*INVENTORY_COLUMNS)
    stored = medallion.inventory_summary(f"{root}/table")
    merged.run_merged(stream, stored, f"{root}/checkpoint")
    return stored.read(lake.spark, merged.schema_of(stored, stream))


@query("i04_silver_copies",
       "SELECT CAST(event_id AS VARCHAR) AS event_id, count(*) AS row_count FROM v_silver"
       " GROUP BY event_id")
def i04_silver(lake):
    # The whole folder arrives a second time: every event has a copy in a later batch.
    root = fresh_dir(lake.spark, "copies")
    raw = inventory_landing(lake)
    for _ in range(2):
        lake.spark.read.text(raw).write.mode("append").text(f"{root}/raw")
        found = medallion.medallion(lake.spark, f"{root}/raw", f"{root}/out", f"{root}/checkpoint",
                                    EVENTS_AS_OF)
    return found["silver"].groupBy("event_id").agg(F.count("*").alias("row_count"))


@query("e05_streamed_windows",
       "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS num_rows,"
       " count(*) FILTER (event_id % 89 = 0) AS nulls_product_id FROM events GROUP BY 1"
       " HAVING window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def e05_streamed(lake):
    stream = streamed(lake, "events").selectExpr(
        "ts", "CASE WHEN event_id % 89 <> 0 THEN user_id END AS product_id")
    return project(stream, lambda s: profile_stream(s, "ts", ["product_id"]), "profile")


@query("i04_dedup_stream", "SELECT event_id, ts, user_id, event_type, value FROM events", "value")
def i04(lake):
    # Every event twice: the same rows arrive from two files of one folder.
    path = fresh_dir(lake.spark, "twice")
    events = lake.table("events").drop("props")
    events.write.parquet(path)
    events.write.mode("append").parquet(path)
    stream = refine.stream_table(lake.spark, path, events.schema)
    return project(stream, lambda s: medallion.dedup_stream(s, "event_id", "ts"), "dedup")


@query("i04_dedup_batch",
       "SELECT user_id, ts, event_id, event_type, value FROM events QUALIFY row_number() OVER"
       " (PARTITION BY user_id ORDER BY ts DESC) = 1", "value")
def i04_batch(lake):
    return medallion.dedup_batch(lake.table("events").drop("props"), "user_id", "ts")


@query("i06_stream_query_model", J1_SQL, " ".join(J1_DOUBLES))
def i06(lake):
    stream = stored_stream(lake, lake.query_history(), "history")
    return project(stream, query_model, "model")


@query("i07_stream_usage",
       "SELECT warehouse_id, workspace_id, sku_name, usage_date, usage_quantity, CAST("
       "usage_start_time AS DATE) AS usage_start_date FROM v_usage WHERE warehouse_id IS NOT NULL",
       "usage_quantity")
def i07(lake):
    rows = project(stored_stream(lake, lake.usage(), "usage"), access.refine_usage, "usage")
    return rows.select("warehouse_id", "workspace_id", "sku_name", "usage_date", "usage_quantity",
                       "usage_start_date")


@query("i07_stream_scaling",
       "SELECT user_id % 3 AS workspace_id, 'wh-' || (user_id % 7) AS warehouse_id, CASE event_type"
       " WHEN 'click' THEN 'SCALED_UP' WHEN 'view' THEN 'SCALED_DOWN' ELSE 'RUNNING' END AS"
       " event_kind, CAST(event_id % 4 AS INTEGER) AS cluster_count, ts AS event_time, CAST(ts AS"
       " DATE) AS event_date FROM events")
def i07_scaling(lake):
    return project(stored_stream(lake, lake.warehouse_events(), "scaling"), access.refine_scaling,
                   "scaling")


@query("i07_stream_warehouse_events", SCD_SQL)
def i07_events(lake):
    changes = project(stored_stream(lake, lake.audit(), "audit"),
                      lambda s: access.refine_warehouse_events(s, "warehouse"), "changes")
    return access.warehouse_scd(changes)


@query("i08_progress",
       "SELECT count(*) AS input_rows, count(*) AS output_rows, true AS timed FROM events")
def i08(lake):
    root = fresh_dir(lake.spark, "progress")
    ledger.run_recorded(streamed(lake, "events").select("event_id"), f"{root}/table",
                        f"{root}/checkpoint")
    return ledger.batch_counts(lake.spark, f"{root}/checkpoint").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("output_rows").alias("output_rows"),
        (F.max("duration_ms") > 0).alias("timed"))


@query("i09_restart", "SELECT count(*) AS row_count, count(*) AS ids FROM events")
def i09(lake):
    setup = job(lake, ingest.ADD)
    land(lake.table("events"), setup.source, *BASE)
    for _ in range(3):
        setup.run(lake.spark)
    return ingest.read_ingested(lake.spark, setup).agg(
        F.count("*").alias("row_count"), F.countDistinct("event_id").alias("ids"))


@query("a08_centralise_logs",
       "SELECT CASE doc_id % 3 WHEN 0 THEN 'stdout' WHEN 1 THEN 'stderr' ELSE 'engine' END AS"
       " log_class, count(*) AS row_count FROM v_logs GROUP BY 1")
def a08(lake):
    root = fresh_dir(lake.spark, "logs")
    lines = lake.log_lines().withColumn("stream", F.element_at(F.split("log_file", "/"), -1))
    lines.select("stream", F.col("log_line").alias("value")).write.partitionBy("stream").text(
        f"{root}/raw")
    logs.centralise_logs(lake.spark, f"{root}/raw", f"{root}/out", f"{root}/checkpoint")
    return lake.spark.read.parquet(f"{root}/out").groupBy("log_class").agg(
        F.count("*").alias("row_count"))
