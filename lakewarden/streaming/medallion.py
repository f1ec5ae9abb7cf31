"""Bronze, silver and gold layers of inventory events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewarden.operators.quality import DROP, Rule, apply_drops, drop_rules_hold
from lakewarden.sources.tables import ANY_AGE, opened
from lakewarden.streaming.ledger import read_recorded, removed_copies, rule_counts, run_recorded
from lakewarden.streaming.merged import Merged, schema_of, summary

# Hinted types of an inventory event.
HINTS = ("event_id string, product_id string, warehouse string, event_type string,"
         " quantity_change int, event_timestamp timestamp_ntz")


def bronze_ingest(spark: SparkSession, path: str, hints: str = HINTS,
                  files_per_batch: int = 1000) -> DataFrame:
    """Stream of a JSON folder with ingest time and source file; files of any age are read."""
    reader = spark.readStream.schema(hints).option("maxFileAge", ANY_AGE) \
        .option("maxFilesPerTrigger", files_per_batch)
    stream = opened(path, reader.json)
    return stream.select("*", F.current_timestamp().alias("_ingested_at"),
                         F.col("_metadata.file_path").alias("_source_file"))


def silver_rules(as_of: datetime) -> list[Rule]:
    """Rows without id, product or warehouse, without a time or from the future are dropped."""
    return [
        Rule("valid_event_id", "event_id IS NOT NULL", DROP),
        Rule("valid_product", "product_id IS NOT NULL", DROP),
        Rule("valid_warehouse", "warehouse IS NOT NULL", DROP),
        Rule("valid_timestamp", "event_timestamp IS NOT NULL AND event_timestamp <= "
             f"TIMESTAMP_NTZ '{as_of}'", DROP),
    ]


def silver(events: DataFrame, as_of: datetime) -> DataFrame:
    return apply_drops(events, silver_rules(as_of))


# The stored aggregate of inventory events.
SUMMARY_KEYS = ("warehouse", "product_id", "event_type")
SUMMARY = (("total_quantity_change", "sum", "quantity_change"), ("event_count", "count", "*"),
           ("first_event", "min", "event_timestamp"), ("last_event", "max", "event_timestamp"))


def inventory_summary(path: str) -> Merged:
    return summary(path, SUMMARY_KEYS, SUMMARY)


def first_copies(stream: DataFrame, key: str, counts: Column, seen: str, keep: str = "7 days",
                 salts: int = 16) -> DataFrame:
    """Rows without later copies of their key, for a stream over stored files; rows that ``counts`` is
    not true for all stay, for the rules to see.

    State is kept for ``keep`` after a key was first seen. The clock is ``seen``, the time of ingestion,
    which only grows, so rows of any event time are in time and none is lost as late. Copies are
    removed per input partition first, as in ``dedup_stream``.
    """
    # A row that does not count gets a name of its own: its file and place.
    own = F.when(F.coalesce(counts, F.lit(False)), F.lit("")).otherwise(
        F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string")))
    timed = stream.withColumn("_own", own).withWatermark(seen, keep)
    if salts > 1:
        timed = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))) \
            .dropDuplicatesWithinWatermark([key, "_own", "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark([key, "_own"]).drop("_own")


def dedup_stream(stream: DataFrame, key: str, ts: str, delay: str = "1 hour",
                 salts: int = 16) -> DataFrame:
    """One row per key in a stream; state is kept for ``delay`` of event time.

    Copies are removed in two steps. The first works per key and salt, where the salt is the input
    partition and does not depend on the row, so many copies of one key are divided over tasks.
    The second sees at most ``salts`` of them. ``salts=1`` saves the first step.
    """
    timed = stream.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark(
        "_event_time", delay)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        timed = timed.withColumn("_salt", salt).dropDuplicatesWithinWatermark(
            [key, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark([key]).drop("_event_time")


def dedup_batch(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """Newest row per key, combined on the map side. Of rows with the same time the choice falls on a
    hash of the row, so a repeated batch keeps the same one."""
    rest = [c for c in rows.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(ts, F.xxhash64(*rest))).alias("r")
    return rows.groupBy(key).agg(newest).select(key, "r.*").select(*rows.columns)


def run_once(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a Parquet folder."""
    query = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def medallion(spark: SparkSession, source: str, out: str, checkpoint: str, as_of: datetime,
              files_per_batch: int = 1000, keep: str = "7 days") -> dict[str, DataFrame]:
    """Ingest new files to bronze, clean new bronze rows to silver without copies of an event, and add
    each cleaned batch to gold.

    ``rules`` holds the counters of every batch that was ever cleaned, ``copies`` the copies removed.
    """
    run_once(bronze_ingest(spark, source, files_per_batch=files_per_batch), f"{out}/bronze", f"{checkpoint}/bronze")
    bronze = spark.read.parquet(f"{out}/bronze")
    stream = spark.readStream.schema(bronze.schema).option("maxFileAge", ANY_AGE) \
        .option("maxFilesPerTrigger", files_per_batch).parquet(f"{out}/bronze")
    checks = silver_rules(as_of)
    single = first_copies(stream, "event_id", drop_rules_hold(checks), "_ingested_at", keep)
    gold = inventory_summary(f"{out}/gold")
    run_recorded(single, f"{out}/silver", f"{checkpoint}/silver", checks, gold.add)
    cleaned = read_recorded(spark, f"{out}/silver", bronze.schema)
    return {"bronze": bronze, "silver": cleaned, "gold": gold.read(spark, schema_of(gold, bronze)),
            "rules": rule_counts(spark, f"{checkpoint}/silver"),
            "copies": removed_copies(spark, f"{checkpoint}/silver")}
