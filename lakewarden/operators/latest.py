"""Current version of slowly changing rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by the columns in ``order`` (put a unique tiebreak last).

    ``max_by`` combines on the map side, so a key that holds a large part of the table sends one
    row per task through the shuffle. A window would send and sort all of them in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def with_latest(fact: DataFrame, dim: DataFrame, keys: Sequence[str], order: Sequence[str],
                keep: Sequence[str], how: str = "inner") -> DataFrame:
    """Join each fact row to the newest version of its dimension row."""
    newest = latest(dim.select(*keys, *keep, *[o for o in order if o not in keep]), keys, order)
    return fact.join(newest.select(*keys, *keep), list(keys), how)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key.

    Spark limits each key to ``n`` rows per task before the shuffle when the filter on the row
    number is this simple, so a large key does not travel as a whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
