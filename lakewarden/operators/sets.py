"""Differences and row changes between two states of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose row was added, removed or changed. Keys must be unique in each state; a NULL in a
    key is a value like others. A column that one state lacks is NULL there.

    Both states are reduced to key and row hash before the shuffle.
    """
    types = {f.name: f.dataType for df in (new, old) for f in df.schema}
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]

    def reduced(df: DataFrame, name: str) -> DataFrame:
        cells = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in values]
        text = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}) if cells else F.lit("")
        return df.select(*[F.col(f"`{k}`").alias(f"{name}_{i}") for i, k in enumerate(keys)],
                         F.sha2(text, 256).alias(name))

    same = F.lit(True)
    for i in range(len(keys)):
        same &= F.col(f"_old_{i}").eqNullSafe(F.col(f"_new_{i}"))
    both = reduced(old, "_old").join(reduced(new, "_new"), same, "full")
    joined = both.select(
        *[F.coalesce(f"_old_{i}", f"_new_{i}").alias(k) for i, k in enumerate(keys)], "_old", "_new")
    change = (
        F.when(F.col("_old").isNull(), F.lit("added"))
        .when(F.col("_new").isNull(), F.lit("removed"))
        .when(F.col("_old") != F.col("_new"), F.lit("changed"))
    )
    return joined.withColumn("change", change).filter("change IS NOT NULL").select(*keys, "change")


def keyless_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows added and removed, counting repeated rows, for tables without a key.

    One grouped count per distinct row instead of two ``exceptAll`` passes.
    """
    columns = old.columns
    both = old.select(*columns, F.lit(-1).alias("_w")).unionByName(
        new.select(*columns, F.lit(1).alias("_w")))
    net = both.groupBy(*columns).agg(F.sum("_w").alias("copies")).filter("copies <> 0")
    return net.withColumn("change", F.when(F.col("copies") > 0, F.lit("added"))
                          .otherwise(F.lit("removed"))).withColumn("copies", F.abs("copies"))


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows)


def update(df: DataFrame, where: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Rows matching ``where`` with new values; a NULL condition leaves the row as it is."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(*[
        F.when(hit, changes[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
        if c in changes else F.col(c) for c in df.columns])


def delete(df: DataFrame, where: Column) -> DataFrame:
    """Rows not matching ``where``; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matched keys, insert the rest. A source key that occurs twice is an error, as in a merge;
    it is counted on the partitioning that the join needs anyway."""
    rest = [c for c in target.columns if c not in keys]
    once = F.count("*").over(Window.partitionBy(*keys)) == 1
    repeated = F.raise_error(F.lit("several source rows have the same key"))
    right = source.withColumn("_once", once).select(
        *keys, F.when(F.col("_once"), F.struct(*rest)).otherwise(repeated).alias("_src"))
    left = target.select(*keys, F.struct(*rest).alias("_tgt"))
    row = F.coalesce("_src", "_tgt")
    return left.join(right, list(keys), "full").select(
        *keys, *[row[c].alias(c) for c in rest]).select(*target.columns)
