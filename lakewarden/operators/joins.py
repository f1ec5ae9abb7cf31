"""Joins with a size check, NULL spreading, hot-key salting and validity intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def many_parts(spark: SparkSession, least: int = 64) -> int:
    """Number of parts for rows that an operator deals out itself: the shuffle partitions, ``least`` at least."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fits(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 << 20) -> bool:
    """True when ``df`` is proven to stay within both bounds.

    Rows are counted first, bytes only of a table with few of them; both are added up where the
    rows are, so no task gets them. The row text is an upper estimate of the row size.
    """
    if df.count() > max_rows:
        return False
    text = F.length(F.to_json(F.struct("*")))
    return (df.agg(F.sum(text).alias("bytes")).first()["bytes"] or 0) <= max_bytes


def lookup_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner",
                **bounds: int) -> DataFrame:
    """Broadcast ``dim`` when its measured size allows it, otherwise a join Spark may re-plan."""
    if fits(dim, **bounds):
        return fact.join(F.broadcast(dim), list(on), how)
    return fact.join(dim, list(on), how)


def merge_join(left: DataFrame, right: DataFrame, on: Sequence[str],
               how: str = "inner") -> DataFrame:
    """Join planned as shuffle and sort-merge, chosen per join instead of per session."""
    return left.hint("merge").join(right, list(on), how)


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def left_lookup(fact: DataFrame, dim: DataFrame, key: str, spread: str,
                buckets: int = 64) -> DataFrame:
    """Left join on a nullable key.

    NULL keys find no partner, yet a plain join sends all of them to one task. Here they get a
    bucket from the ``spread`` column as a second join key, so they are divided evenly.
    """
    bucket = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(buckets)) + 1)
    left = fact.withColumn("_bucket", F.coalesce(bucket, F.lit(0).cast("long")))
    # An expression over the key: a plain literal would be folded away from the join keys.
    right = dim.withColumn("_bucket", F.xxhash64(key) - F.xxhash64(key))
    return left.join(right, [key, "_bucket"], "left").drop("_bucket")


def hot_keys(df: DataFrame, key: str, parts: int) -> dict:
    """Keys that hold more than ``1/parts`` of the rows with a key, so fewer than ``parts`` of them,
    and the number of parts that such a share stands for.

    One mergeable sketch of the frequent values finds them: a row per task goes out, where a count
    per key would shuffle every key. It tracks 16 values for each part, so a count is off by less than
    a quarter of the share that is looked for; a key near the edge may be on either side of it.
    """
    tracked = 16 * parts
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count("*").alias("n"),
        F.expr(f"approx_top_k(`{key}`, {parts}, {tracked})").alias("top")).first()
    return {row["item"]: math.ceil(row["count"] * parts / found["n"])
            for row in found["top"] or [] if row["count"] * parts > found["n"]}


def _salts(hot: dict, key: str) -> Column:
    """Number of salts of a row's key, 1 for all keys that are not hot."""
    if not hot:
        return F.lit(1)
    listed = F.create_map(*[F.lit(v) for item in hot.items() for v in item])
    return F.coalesce(listed[F.col(key)], F.lit(1))


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str,
                parts: int | None = None, how: str = "inner",
                spread_right: str | None = None) -> DataFrame:
    """Equi join, by shuffle and sort-merge, that divides hot keys over tasks by their share of rows.

    Only keys above ``1/parts`` of the rows of ``left`` are salted, each ``parts`` times its share; the
    default is the number of shuffle partitions or of the cluster's cores, 64 at least. The rows of
    ``right`` with such a key are repeated as often as it has salts, no others. With ``spread_right``
    the hot keys of ``right`` are divided, too: a key that is hot on both sides is cut into a grid, in
    which each pair of rows meets once. NULL keys find no partner and are divided by ``spread``.

    The lists of hot keys, fewer than ``parts`` each, are found first and are fixed in the plan, so
    both sides agree on the salts when a lost stage runs again. Neither side is broadcast: a side
    that is small enough for it needs no salts (see ``lookup_join``).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join repeats rows of the right side: use inner or left")
    if spread_right is not None and how != "inner":
        raise ValueError("salts of the right side repeat rows of the left one: use inner")
    spark = left.sparkSession
    if parts is None:
        parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")),
                    spark.sparkContext.defaultParallelism)
    across = _salts(hot_keys(left, key, parts), key)
    down = _salts(hot_keys(right, key, parts) if spread_right else {}, key)
    wide = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(across)

    def place(name: str, salts: Column) -> Column:
        return F.pmod(F.xxhash64(name), salts).cast("int")

    def each(salts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), salts - 1))

    salted = left.withColumn("_salt", place(spread, wide))
    repeated = right.withColumn("_salt", each(across))
    on = [key, "_salt"]
    if spread_right is not None:
        salted = salted.withColumn("_salt_right", each(down))
        repeated = repeated.withColumn("_salt_right", place(spread_right, down))
        on.append("_salt_right")
    return salted.hint("merge").join(repeated, on, how).drop(*on[1:])


def salted_agg(df: DataFrame, key: Sequence[str], spread: str, salts: int,
               partial: Sequence[Column], final: Sequence[Column]) -> DataFrame:
    """Two-pass aggregate: by key and salt, then by key.

    Use it for aggregates without map-side combine (lists, exact percentiles); sums and counts
    are combined by Spark before the shuffle anyway.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(salts))
    first = df.withColumn("_salt", salt).groupBy(*key, "_salt").agg(*partial)
    return first.groupBy(*key).agg(*final)


def _rows_per_key(how: str) -> Column:
    """Rows that a join of kind ``how`` gives for a key with ``_a`` rows left and ``_b`` right."""
    a, b = F.col("_a"), F.col("_b")
    one = F.lit(1).cast("long")
    kinds = {
        "inner": a * b, "left": a * F.coalesce(b, one), "right": F.coalesce(a, one) * b,
        "full": F.coalesce(a, one) * F.coalesce(b, one),
        "semi": F.when(b.isNotNull(), a), "anti": F.when(b.isNull(), a)}
    kind = how.lower().replace("_", "")
    kind = {"leftsemi": "semi", "leftanti": "anti"}.get(kind, kind.replace("outer", "") or "full")
    if kind not in kinds:
        raise ValueError(f"no join of kind {how!r}; one of {', '.join(kinds)}")
    return kinds[kind]


def join_size(left: DataFrame, right: DataFrame, on: Sequence[str],
              how: str = "inner") -> DataFrame:
    """Rows a keyed join gives and rows it would give without keys, from key counts only.

    An outer join counts the rows without a partner, too; rows with a NULL key never have one.
    """
    a = left.groupBy(*on).agg(F.count("*").alias("_a"))
    b = right.groupBy(*on).agg(F.count("*").alias("_b"))
    rows = _rows_per_key(how)
    pairs = a.join(b, list(on), "inner" if how == "inner" else "full")
    keyed = pairs.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("n"))
    rows_a = a.agg(F.coalesce(F.sum("_a"), F.lit(0)).alias("n"))
    rows_b = b.agg(F.coalesce(F.sum("_b"), F.lit(0)).alias("n"))
    return keyed.select(
        F.col("n").alias("keyed_rows"),
        (rows_a.scalar().cast("decimal(38,0)") * rows_b.scalar()).cast("double")
        .alias("keyless_rows"),
    )


def guarded_join(left: DataFrame, right: DataFrame, on: Sequence[str], max_rows: int,
                 how: str = "inner") -> DataFrame:
    """Keyed join that is refused when its size, known from key counts, exceeds ``max_rows``.

    A join without keys is always refused.
    """
    if not on:
        raise ValueError("join without keys refused: every row would meet every other row")
    rows = join_size(left, right, on, how).first()["keyed_rows"]
    if rows > max_rows:
        raise ValueError(f"join on {list(on)} would give {rows} rows, more than {max_rows}")
    return left.join(right, list(on), how)


def validity_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], moment: str, start: str,
                  end: str, how: str = "left", closed: str = "left",
                  width: str = "month", newest: Column | None = None) -> DataFrame:
    """Rows of ``dim`` in force at ``moment`` (``end`` NULL means still in force).

    ``closed="left"`` treats the interval as ``[start, end)``; ``"both"`` includes the end.
    Intervals are laid out on calendar buckets and joined by key and bucket, so a key with many
    rows is divided by time and nothing needs to be broadcast. Open intervals reach to ``newest``,
    by default the newest ``moment``; pass it when ``fact`` is expensive to compute twice.
    """
    def slot(c: Column) -> Column:
        return F.date_trunc(width, c).cast("date")

    if newest is None:
        newest = fact.agg(F.max(moment).alias("m")).scalar()
    last = slot(newest)
    first_slot = slot(F.col(start))
    last_slot = F.least(F.coalesce(slot(F.col(end)), last), last)
    step = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH",
            "year": "INTERVAL 1 YEAR"}[width]
    laid_out = (
        dim.withColumn("_last", last_slot).filter(F.col("_last") >= first_slot)
        .withColumn("_slot", F.explode(F.sequence(first_slot, F.col("_last"), F.expr(step))))
        .drop("_last")
        .withColumnsRenamed({k: f"_d_{k}" for k in on})
    )
    keyed = fact.withColumn("_slot_of", slot(F.col(moment)))
    before_end = F.col(moment) <= F.col(end) if closed == "both" else F.col(moment) < F.col(end)
    condition = (F.col("_slot_of") == F.col("_slot")) & (F.col(start) <= F.col(moment)) & (
        F.col(end).isNull() | before_end)
    for k in on:
        condition &= F.col(k) == F.col(f"_d_{k}")
    return keyed.join(laid_out, condition, how).drop("_slot_of", "_slot", *[f"_d_{k}" for k in on])
