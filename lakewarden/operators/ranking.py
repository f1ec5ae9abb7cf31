"""Ordered calculations per key that do not put one key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakewarden.session import durable


def ordered_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   sums: Sequence[str] = (), ahead: str | None = None) -> DataFrame:
    """Add position and running values per key, for keys of any size.

    Adds ``rn`` and ``rn_desc`` (position from either end), ``<c>_running`` for every column of
    ``sums`` and ``next_<ahead>``. ``order`` must be unique within a key.

    Rows are range-partitioned by key and order, so a large key spans several partitions and each
    partition continues where the one before stopped. At most one key crosses each partition
    border, so the table of carried values has fewer rows than twice the number of partitions
    and is safe to broadcast. The partition number is written out first: recomputing it after a
    lost executor could give another split.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    split = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
    fixed = durable(split.withColumn("_part", F.spark_partition_id()), "ordered")

    pieces = fixed.groupBy(*keys, "_part").agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums],
        *([F.min_by(ahead, F.col(ahead)).alias("_first")] if ahead else []))
    by_part = Window.partitionBy(*keys).orderBy("_part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    later = by_part.rowsBetween(1, Window.unboundedFollowing)
    carried = pieces.select(
        *keys, "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_after"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
          for c in sums],
        *([F.lead("_first").over(by_part).alias("_next")] if ahead else []),
    ).filter("_before > 0 OR _after > 0")

    here = Window.partitionBy(*keys, "_part").orderBy(*order)
    running = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys, "_part")
    local = fixed.select(
        *df.columns, "_part",
        F.row_number().over(here).alias("_rn"), F.count("*").over(whole).alias("_size"),
        *[F.sum(c).over(running).alias(f"_run_{c}") for c in sums],
        *([F.lead(ahead).over(here).alias("_lead")] if ahead else []))

    renamed = carried.withColumnsRenamed({c: f"_c_{c}" for c in (*keys, "_part")})
    same = F.col("_part") == F.col("_c__part")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    zero = F.lit(0)
    return local.join(F.broadcast(renamed), same, "left").select(
        *df.columns,
        (F.col("_rn") + F.coalesce("_before", zero)).alias("rn"),
        (F.col("_size") - F.col("_rn") + 1 + F.coalesce("_after", zero)).alias("rn_desc"),
        *[(F.col(f"_run_{c}") + F.coalesce(f"_before_{c}", zero)).alias(f"{c}_running")
          for c in sums],
        *([F.coalesce("_lead", "_next").alias(f"next_{ahead}")] if ahead else []),
    )


def scd_history(events: DataFrame, keys: Sequence[str], order: Sequence[str],
                deleted: Column) -> DataFrame:
    """Position of every change, first to last and last to first, and the current state."""
    ranked = ordered_by_key(events, keys, order)
    state = F.when((F.col("rn_desc") == 1) & deleted, F.lit("Deleted")).otherwise(F.lit("Active"))
    return ranked.withColumn("is_deleted", state).withColumnsRenamed(
        {"rn": "change_rank", "rn_desc": "recency_rank"})
