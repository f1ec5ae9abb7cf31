"""A stored aggregate that grows by batches: partial results, merged when they are read.

Every batch writes one row for each group it touches into a folder of its own, which a repeated batch
replaces. Reading merges these rows, at most one per group and batch. ``fold`` merges the batches so
far into one base beside them; the base counts when its marker is there, and readers then leave out
the batches it holds, so at any moment one state is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

#: How a partial result is made from rows and how partial results are merged.
MEASURES: dict[str, tuple[Callable[[str], Column], Callable[[str], Column]]] = {
    "sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


@dataclass(frozen=True)
class Merged:
    """An aggregate below ``path`` per ``keys``; ``measures`` are (name, kind, column), with "*" for the
    column of a count of rows."""

    path: str
    keys: tuple[str, ...]
    measures: tuple[tuple[str, str, str], ...]

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[MEASURES[k][0](c).alias(n) for n, k, c in self.measures])

    def merge(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(*[MEASURES[k][1](n).alias(n) for n, k, _ in self.measures])

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """The groups of a batch, in place of what an earlier attempt of the same batch has left."""
        self.partial(rows).write.mode("overwrite").parquet(f"{self.path}/parts/batch={batch_id}")

    def _base(self, spark: SparkSession) -> int:
        """Last batch of the newest base, -1 without one."""
        try:
            return spark.read.schema("last bigint").option("recursiveFileLookup", True) \
                .parquet(f"{self.path}/bases").agg(F.coalesce(F.max("last"), F.lit(-1)).alias("v")).first()["v"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1

    def _state(self, spark: SparkSession, schema: T.StructType, last: int) -> DataFrame:
        parts = spark.read.schema(T.StructType([*schema, T.StructField("batch", T.LongType())])) \
            .parquet(f"{self.path}/parts").filter(F.col("batch") > last).drop("batch")
        if last < 0:
            return parts
        return spark.read.schema(schema).parquet(f"{self.path}/base-{last}").unionByName(parts)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The aggregate over all batches. ``schema`` is that of ``partial``."""
        return self.merge(self._state(spark, schema, self._base(spark)))

    def fold(self, spark: SparkSession, schema: T.StructType, last: int) -> None:
        """Merge the batches up to ``last``, which must be finished, into a base. Nothing is removed: who
        reads the earlier base goes on undisturbed."""
        before = self._base(spark)
        if last <= before:
            return
        parts = spark.read.schema(T.StructType([*schema, T.StructField("batch", T.LongType())])) \
            .parquet(f"{self.path}/parts").filter(F.col("batch").between(before + 1, last)).drop("batch")
        if before >= 0:
            parts = parts.unionByName(spark.read.schema(schema).parquet(f"{self.path}/base-{before}"))
        self.merge(parts).write.mode("overwrite").parquet(f"{self.path}/base-{last}")
        spark.createDataFrame([(last,)], "last bigint").coalesce(1).write.mode("overwrite") \
            .parquet(f"{self.path}/bases/{last}")


def run_merged(stream: DataFrame, stored: Merged, checkpoint: str) -> StreamingQuery:
    """Add everything available now to a stored aggregate, batch by batch."""
    query = (
        stream.writeStream.foreachBatch(stored.add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def schema_of(stored: Merged, rows: DataFrame) -> T.StructType:
    """Columns and types of the partial results over ``rows``; nothing is computed."""
    fields = stored.partial(rows).schema
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def summary(path: str, keys: Sequence[str], measures: Sequence[tuple[str, str, str]]) -> Merged:
    for name, kind, _ in measures:
        if kind not in MEASURES:
            raise ValueError(f"{name}: a {kind} can't be merged; take one of {sorted(MEASURES)}")
    return Merged(path, tuple(keys), tuple(measures))
