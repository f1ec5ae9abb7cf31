"""What streaming jobs have processed and what is still waiting.

Every batch function writes its own rows to a folder beside the checkpoint, one sub-folder per
batch that a repeated batch replaces. Nothing is read from the files that Spark keeps for itself, so
old batches stay known however many follow. A checkpoint that is given up takes a new path.

``compact`` merges the batches so far into one base. A base counts from the moment its marker is
written; readers take the newest base and the batches after it. Folders that the base before already
held are removed, so a reader that began earlier still finds its files until the next but one merge,
and the number of files stays below about twice COMPACT_EVERY per kind.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakewarden.operators.quality import Rule, counters, drop_rules_hold, enforce
from lakewarden.sources.files import file_inventory

FILES = ("file_path string, modified_at timestamp, size_bytes bigint, row_count bigint,"
         " batch_id bigint, committed_at timestamp")
BATCHES = ("batch_id bigint, started_at timestamp, duration_ms bigint, input_rows bigint,"
           " output_rows bigint")
RULES = "batch_id bigint, name string, passed_records bigint, failed_records bigint"
COPIES = "batch_id bigint, input_rows bigint, removed_copies bigint"
KINDS = {"files": FILES, "batches": BATCHES, "rules": RULES, "copies": COPIES}
#: Batches after which the entries of a kind are merged.
COMPACT_EVERY = 100


def _folder(checkpoint: str, kind: str) -> str:
    return f"{checkpoint.rstrip('/')}-ledger/{kind}"


def _write(rows: DataFrame, checkpoint: str, kind: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{_folder(checkpoint, kind)}/batch={batch_id}")


def _there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no batch has finished


def _read(spark: SparkSession, checkpoint: str, kind: str, schema: str) -> DataFrame:
    folder = _folder(checkpoint, kind)
    last = _merged_up_to(spark, folder)
    if last < 0:
        return _there(spark, folder, schema)
    base = spark.read.schema(schema).parquet(f"{folder}-base/{last}")
    # Only the batches after the base are listed: the others may go while this reader is at work.
    later = [path for n, path in _folders(spark, folder) if n > last]
    return base.unionByName(spark.read.schema(schema).parquet(*later)) if later else base


def _merged_up_to(spark: SparkSession, folder: str) -> int:
    """Last batch of the newest base, -1 without one."""
    return _there(spark, f"{folder}-bases", "last bigint").agg(
        F.coalesce(F.max("last"), F.lit(-1)).alias("v")).first()["v"]


def _folders(spark: SparkSession, parent: str) -> list[tuple[int, str]]:
    """Number and path of the sub-folders ``batch=<n>`` or ``<n>``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(parent)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []
    numbers = [(name.rpartition("=")[2], name) for name in names]
    return sorted((int(n), f"{parent}/{name}") for n, name in numbers if n.isdigit())


def _remove(spark: SparkSession, parent: str, belongs: Callable[[int], bool]) -> None:
    """Remove the sub-folders whose number ``belongs``."""
    for number, path in _folders(spark, parent):
        if belongs(number):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def compact(spark: SparkSession, checkpoint: str, every: int = COMPACT_EVERY) -> list[str]:
    """Merge each kind of entry with more than ``every`` batches since its last base; which ones were.
    Call it while no batch of this checkpoint runs."""
    merged = []
    for kind, schema in KINDS.items():
        folder = _folder(checkpoint, kind)
        before = _merged_up_to(spark, folder)
        found = _there(spark, folder, schema).filter(F.col("batch_id") > before).agg(
            F.countDistinct("batch_id").alias("n"), F.max("batch_id").alias("last")).first()
        if found["n"] <= every:
            continue
        last = found["last"]
        _read(spark, checkpoint, kind, schema).filter(F.col("batch_id") <= last).coalesce(8) \
            .write.mode("overwrite").parquet(f"{folder}-base/{last}")
        spark.createDataFrame([(last,)], "last bigint").coalesce(1).write.mode("overwrite") \
            .parquet(f"{folder}-bases/{last}")
        _remove(spark, folder, lambda n: n <= before)
        _remove(spark, f"{folder}-base", lambda n: n < before)
        _remove(spark, f"{folder}-bases", lambda n: n < before)
        merged.append(kind)
    return merged


def record_files(files: DataFrame, checkpoint: str, batch_id: int) -> None:
    """Store the files of a batch; ``files`` has the ``_metadata`` of every row as ``_file``.

    Call it in the batch function after the rows are written.
    """
    path = F.url_decode(F.replace("_file.file_path", F.lit("+"), F.lit("%2B")))
    found = files.groupBy("_file.file_path").agg(
        F.any_value(path).alias("path"), F.max("_file.file_modification_time").alias("modified_at"),
        F.max("_file.file_size").alias("size_bytes"), F.count("*").alias("row_count"))
    _write(found.select(
        F.col("path").alias("file_path"), "modified_at", "size_bytes", "row_count",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.current_timestamp().alias("committed_at")), checkpoint, "files", batch_id)


def processed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Files of finished batches: path, file time, size, rows, batch and time of the commit."""
    return _read(spark, checkpoint, "files", FILES)


def backlog_files(spark: SparkSession, source: str, checkpoint: str) -> DataFrame:
    """Files below ``source`` that no finished batch contains; files without a byte hold no rows."""
    # One spelling for local files, which the two listings write as file:/ and file:///.
    spelled = F.regexp_replace("file_path", "^file:/+", "file:/")
    done = processed_files(spark, checkpoint).select(spelled.alias("file_path"))
    return file_inventory(spark, source).filter("size_bytes > 0") \
        .withColumn("file_path", spelled).join(done, "file_path", "left_anti")


def backlog(spark: SparkSession, source: str, checkpoint: str) -> DataFrame:
    """Number and bytes of the files still to be processed."""
    return backlog_files(spark, source, checkpoint).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))


def run_recorded(stream: DataFrame, out: str, checkpoint: str, checks: Sequence[Rule] = (),
                 after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Write everything available now to a folder per batch, and record the counters of each batch.

    Rows that violate a ``drop`` rule are left out; a violated ``fail`` rule ends the batch before
    anything of it is written. Rows are computed once: the counters are observed while they are
    written. ``after`` gets the rows that were written, read back, and the number of the batch.
    """
    checks = list(checks)

    def write(rows: DataFrame, batch_id: int) -> None:
        began = time.time()
        spark = rows.sparkSession
        seen = Observation()
        watched = rows.observe(seen, *counters(checks), F.count_if(drop_rules_hold(checks)).alias("kept"))
        folder = f"{out}/batch={batch_id}"
        enforce(watched, checks).write.mode("overwrite").parquet(folder)
        counts = seen.get
        if after is not None:
            after(spark.read.schema(rows.schema).parquet(folder), batch_id)
        failed = [(batch_id, r.name, counts["rows"] - counts[f"failed_{r.name}"], counts[f"failed_{r.name}"])
                  for r in checks]
        _write(spark.createDataFrame(failed, RULES).coalesce(1), checkpoint, "rules", batch_id)
        took = int(1000 * (time.time() - began))
        batch = spark.createDataFrame([(batch_id, took, counts["rows"], counts["kept"])],
                                      "batch_id long, duration_ms long, input_rows long, output_rows long")
        _write(batch.select("batch_id", F.timestamp_millis(F.lit(int(began * 1000))).alias("started_at"),
                            "duration_ms", "input_rows", "output_rows").coalesce(1),
               checkpoint, "batches", batch_id)

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    record_copies(stream.sparkSession, query, checkpoint)
    compact(stream.sparkSession, checkpoint)
    return query


def record_copies(spark: SparkSession, query: StreamingQuery, checkpoint: str) -> None:
    """Store how many copies the keyed state of a finished run has removed, per batch with new rows."""
    for p in query.recentProgress:
        dropped = [op.customMetrics["numDroppedDuplicateRows"] for op in p.stateOperators
                   if "numDroppedDuplicateRows" in op.customMetrics]
        if dropped and p.numInputRows:
            row = (p.batchId, p.numInputRows, sum(dropped))
            _write(spark.createDataFrame([row], COPIES).coalesce(1), checkpoint, "copies", p.batchId)


def removed_copies(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows read and copies removed per batch of ``run_recorded`` over a stream with keyed state."""
    return _read(spark, checkpoint, "copies", COPIES)


def read_recorded(spark: SparkSession, out: str, schema) -> DataFrame:
    """The rows that ``run_recorded`` has written."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)


def batch_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Start, duration and rows of every batch that ``run_recorded`` has finished."""
    return _read(spark, checkpoint, "batches", BATCHES)


def rule_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Passed and failed rows per rule of every batch that ``run_recorded`` has finished."""
    return _read(spark, checkpoint, "rules", RULES)
