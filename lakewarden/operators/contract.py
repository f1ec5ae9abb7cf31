"""Schema contracts, checked before a job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def schema_diff(expected: T.StructType, df: DataFrame) -> DataFrame:
    """One row per column: ok, missing, added or type_changed.

    Schemas are driver metadata; no data is read.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    rows = [
        (name, want.get(name), have.get(name),
         "missing" if name not in have else "added" if name not in want
         else "ok" if have[name] == want[name] else "type_changed")
        for name in dict.fromkeys([*want, *have])
    ]
    schema = "column_name string, expected_type string, actual_type string, status string"
    return df.sparkSession.createDataFrame(rows, schema)


def rename_candidates(old: DataFrame, new: DataFrame) -> DataFrame:
    """Share of a missing column's distinct values that an added column of its type contains.

    Both sides are reduced to distinct value hashes per column, then matched on the hash: a value
    meets at most one row per added column.
    """
    kinds_old = {f.name: f.dataType.simpleString() for f in old.schema}
    kinds_new = {f.name: f.dataType.simpleString() for f in new.schema}
    missing = [c for c in old.columns if c not in kinds_new]
    added = [c for c in new.columns if c not in kinds_old]

    def values(df: DataFrame, columns: list[str], kinds: dict[str, str], name: str) -> DataFrame:
        items = F.array(*[
            F.when(F.col(c).isNotNull(), F.struct(
                F.lit(c).alias(name), F.lit(kinds[c]).alias("kind"), F.xxhash64(c).alias("h")))
            for c in columns])
        return df.select(F.explode(items).alias("i")).filter("i IS NOT NULL").select(
            "i.*").distinct()

    if not missing or not added:
        schema = "missing_column string, added_column string, overlap double"
        return old.sparkSession.createDataFrame([], schema)
    lost = values(old, missing, kinds_old, "missing_column")
    found = values(new, added, kinds_new, "added_column")
    sizes = lost.groupBy("missing_column").agg(F.count("*").alias("size"))
    shared = lost.join(found, ["kind", "h"]).groupBy("missing_column", "added_column").agg(
        F.count("*").alias("shared"))
    return shared.join(sizes, "missing_column").select(
        "missing_column", "added_column", (F.col("shared") / F.col("size")).alias("overlap"))
