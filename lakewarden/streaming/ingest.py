"""Incremental ingest of JSON-line folders with a stored, evolving schema.

The file source with its checkpoint finds new files; each micro-batch is parsed with the newest
stored schema and written to a folder named after query and batch. A batch that runs again after a
failure replaces its own folder, so every row arrives once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakewarden.sources.jsonlines import RESCUE, infer_schema, new_fields, parse
from lakewarden.sources.tables import ANY_AGE, opened
from lakewarden.streaming.ledger import record_files

ADD, RESCUE_MODE, FAIL, NONE = "add", "rescue", "fail", "none"


class NewFieldsError(Exception):
    """A batch has fields the schema does not know and the mode forbids them."""


@dataclass
class SchemaStore:
    """Schema versions of one ingest as JSON files."""

    spark: SparkSession
    path: str

    def versions(self) -> DataFrame:
        return self.spark.read.schema("version bigint, schema string").json(self.path)

    def newest(self) -> tuple[int, T.StructType] | None:
        try:
            row = self.versions().orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if row is None:
            return None
        return row["version"], T.StructType.fromDDL(row["schema"])

    def add(self, version: int, schema: T.StructType) -> None:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        row = self.spark.createDataFrame([(version, ddl)], "version bigint, schema string")
        row.coalesce(1).write.mode("append").json(self.path)


@dataclass
class Ingest:
    """Settings of one ingest."""

    source: str
    target: str
    checkpoint: str
    schema_path: str
    mode: str = ADD
    rescue: bool = True
    typed: bool = True
    hints: Mapping[str, str] = field(default_factory=dict)
    max_files: int | None = 1000
    max_bytes: int | None = None
    clean: str = "off"
    archive: str | None = None
    max_age: str | None = None

    def run(self, spark: SparkSession) -> StreamingQuery:
        """Process all files that are there now, then stop."""
        refused: list[NewFieldsError] = []
        query = (
            self._lines(spark).writeStream.foreachBatch(self._batch(spark, refused))
            .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if refused:
                raise refused[0] from None
            raise
        return query

    def _lines(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format("text").option("cleanSource", self.clean)
        limits = {"maxFilesPerTrigger": self.max_files, "maxBytesPerTrigger": self.max_bytes,
                  "maxFileAge": self.max_age or ANY_AGE, "sourceArchiveDir": self.archive}
        if self.max_bytes is not None:  # the source accepts one of the two limits
            limits["maxFilesPerTrigger"] = None
        for name, value in limits.items():
            if value is not None:
                reader = reader.option(name, value)
        return opened(self.source, reader.load).select("*", F.col("_metadata").alias("_file"))

    def _batch(self, spark: SparkSession,
               refused: list[NewFieldsError]) -> Callable[[DataFrame, int], None]:
        store = SchemaStore(spark, self.schema_path)

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.persist()  # read for the schema and again for the write
            lines = batch.drop("_file")
            try:
                schema = self._schema_for(lines, store)
                query_id = spark.read.json(f"{self.checkpoint}/metadata").first()["id"]
                parse(lines, schema, self.rescue).write.mode("overwrite").parquet(
                    f"{self.target}/query={query_id}/batch={batch_id}")
                record_files(batch, self.checkpoint, batch_id)
            except NewFieldsError as e:
                refused.append(e)
                raise
            finally:
                batch.unpersist()

        return write

    def _schema_for(self, lines: DataFrame, store: SchemaStore) -> T.StructType:
        """Newest schema, widened first when the batch has new fields and the mode allows it."""
        known = store.newest()
        if known is None:
            schema = infer_schema(lines, self.typed, self.hints)
            store.add(0, schema)
            return schema
        version, schema = known
        if self.mode in (RESCUE_MODE, NONE):
            return schema
        unknown = new_fields(lines, schema)
        if not unknown:
            return schema
        if self.mode == FAIL:
            raise NewFieldsError(f"fields not in the schema: {unknown}")
        found = infer_schema(lines, self.typed, self.hints)
        wider = T.StructType([*schema.fields, *[found[name] for name in unknown]])
        store.add(version + 1, wider)
        return wider


def read_ingested(spark: SparkSession, job: Ingest) -> DataFrame:
    """The target under the newest schema; rows written before a field was known have NULL in it.

    The schema comes from the store, so no file footers are merged.
    """
    _, schema = SchemaStore(spark, job.schema_path).newest()
    if job.rescue:
        schema = T.StructType([*schema.fields, T.StructField(RESCUE, T.StringType())])
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(job.target)


def reprocess(spark: SparkSession, job: Ingest, checkpoint: str, target: str | None = None,
              ) -> Ingest:
    """Read every source file again with a new checkpoint.

    Without a new ``target`` the rows are appended a second time; with one the table is created
    anew and has no duplicates.
    """
    again = Ingest(**{**job.__dict__, "checkpoint": checkpoint, "target": target or job.target})
    again.run(spark)
    return again
