"""Reports on the event log of a dataset flow: progress, errors, expectations, run times."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakewarden.operators.shape import first_rows

# Fields of the JSON details that the reports read. Spark parses only those a report uses.
DETAILS = (
    "flow_progress struct<status:string,"
    "metrics:struct<num_output_rows:bigint,num_upserted_rows:bigint,num_deleted_rows:bigint,"
    "numFilesOutstanding:bigint,numBytesOutstanding:bigint>,"
    "data_quality:struct<expectations:array<struct<"
    "name:string,dataset:string,passed_records:bigint,failed_records:bigint>>>>,"
    " update_progress struct<state:string>, create_update struct<cause:string>,"
    " error struct<message:string,exceptions:string>"
)


def _parsed(events: DataFrame, *kinds: str) -> DataFrame:
    """Events of the given types (all when none is given) with their details as ``d``."""
    rows = events.filter(F.col("event_type").isin(*kinds)) if kinds else events
    return rows.withColumn("d", F.from_json("details", DETAILS))


def event_overview(events: DataFrame, n: int | None = None) -> DataFrame:
    report = events.select("timestamp", "event_type", "level", "message",
                           F.col("origin.pipeline_name").alias("pipeline_name"),
                           F.col("origin.flow_name").alias("flow_name"))
    return first_rows(report, [F.desc("timestamp"), F.col("message")], n)


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "level").agg(
        F.count("*").alias("event_count"), F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event")).orderBy(F.desc("event_count"))


def flow_rows(events: DataFrame, n: int | None = None) -> DataFrame:
    """Rows written, upserted and deleted per progress event."""
    metrics = "d.flow_progress.metrics"
    report = _parsed(events, "flow_progress").select(
        "timestamp", F.col("origin.flow_name").alias("table_name"),
        F.col("d.flow_progress.status").alias("flow_status"),
        F.col(f"{metrics}.num_output_rows").alias("rows_written"),
        F.col(f"{metrics}.num_upserted_rows").alias("rows_upserted"),
        F.col(f"{metrics}.num_deleted_rows").alias("rows_deleted"))
    return first_rows(report, [F.desc("timestamp"), F.col("table_name")], n)


def rows_per_run(events: DataFrame) -> DataFrame:
    return _parsed(events, "flow_progress").groupBy(
        F.col("origin.update_id").alias("update_id"), F.col("origin.flow_name").alias("table_name"),
    ).agg(F.coalesce(F.sum("d.flow_progress.metrics.num_output_rows"), F.lit(0))
          .alias("rows_written"))


def flow_backlog(events: DataFrame) -> DataFrame:
    """Files and bytes each flow has found but not yet read: at its newest report, at most, and whether
    there are more of them than at its first report."""
    order = F.struct("timestamp", "event_id")
    reported = _parsed(events, "flow_progress").select(
        F.col("origin.flow_name").alias("table_name"), "timestamp", "event_id",
        F.col("d.flow_progress.metrics.numFilesOutstanding").alias("files"),
        F.col("d.flow_progress.metrics.numBytesOutstanding").alias("bytes")).filter("files is not null")
    return reported.groupBy("table_name").agg(
        F.count("*").alias("reports"), F.max("timestamp").alias("reported_at"),
        F.max_by("files", order).alias("files_outstanding"), F.max_by("bytes", order).alias("bytes_outstanding"),
        F.max("files").alias("most_files"), F.max("bytes").alias("most_bytes"),
        F.min_by("files", order).alias("_first")) \
        .withColumn("growing", F.col("files_outstanding") > F.col("_first")).drop("_first")


def flow_errors(events: DataFrame, n: int | None = None) -> DataFrame:
    report = _parsed(events.filter(F.col("level").isin("ERROR", "WARN"))).select(
        "timestamp", "level", F.col("origin.flow_name").alias("table_name"), "message",
        F.col("d.error.message").alias("error_detail"),
        F.col("d.error.exceptions").alias("exceptions"))
    return first_rows(report, [F.desc("timestamp"), F.col("message")], n)


def errors_of_latest_run(events: DataFrame) -> DataFrame:
    """Errors of the update that logged the newest event."""
    newest = events.agg(F.max_by("origin.update_id", F.struct("timestamp", "event_id"))
                        .alias("u")).scalar()
    return flow_errors(events.filter(
        (F.col("level") == "ERROR") & (F.col("origin.update_id") == newest)), n=None)


def update_lifecycle(events: DataFrame, n: int | None = None) -> DataFrame:
    report = _parsed(events, "update_progress", "create_update").select(
        "timestamp", "event_type", "message",
        F.col("d.update_progress.state").alias("update_state"),
        F.col("d.create_update.cause").alias("trigger_cause"))
    return first_rows(report, [F.desc("timestamp"), F.col("message")], n)


def update_durations(events: DataFrame) -> DataFrame:
    """Seconds from the first RUNNING to the last COMPLETED state of each update."""
    state = F.col("d.update_progress.state")
    per_update = _parsed(events, "update_progress").groupBy(
        F.col("origin.update_id").alias("update_id")
    ).agg(
        F.min(F.when(state == "RUNNING", F.col("timestamp"))).alias("started_at"),
        F.max(F.when(state == "COMPLETED", F.col("timestamp"))).alias("completed_at"))
    return per_update.filter("completed_at >= started_at").withColumn(
        "duration_sec", F.expr("timestampdiff(SECOND, started_at, completed_at)"))


def expectation_results(events: DataFrame) -> DataFrame:
    """One row per expectation and progress event."""
    return _parsed(events, "flow_progress").select(
        "timestamp", F.col("origin.flow_name").alias("table_name"),
        F.explode("d.flow_progress.data_quality.expectations").alias("e"),
    ).select("timestamp", "table_name", F.col("e.name").alias("expectation_name"),
             F.col("e.dataset").alias("dataset"), "e.passed_records", "e.failed_records")


def expectation_totals(events: DataFrame) -> DataFrame:
    return expectation_results(events).groupBy("expectation_name", "dataset").agg(
        F.sum("passed_records").alias("passed_records"),
        F.sum("failed_records").alias("failed_records"))
