"""Rows in one global order over many partitions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

LOWEST = -(1 << 63)
PART_ROWS = 20_000


def order_key(name: str = "doc_id") -> Column:
    """An id as a long; a null comes before all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LOWEST))


def part_bounds(keys: DataFrame, rows: int = PART_ROWS) -> list[int]:
    """Values that divide the keys (one long column) into parts of about ``rows`` rows, at least as
    many as there are shuffle partitions; fewer where keys repeat. Equal keys stay together."""
    name = keys.columns[0]
    n = keys.count()
    parts = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // rows))
    if n == 0 or parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(name, shares, 10 * parts).alias("b")).first()["b"]
    return sorted(set(found))


def part_of(key: Column, bounds: list[int]) -> Column:
    """The part of a key: how many bounds are at or below it. The bounds are as many as parts."""
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def part(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right").astype(np.int32))

    return part(key)


def in_parts(df: DataFrame, bounds: list[int], *order: str) -> DataFrame:
    """Rows with ``_part`` brought together by part and sorted by part and ``order``."""
    return df.repartition(len(bounds) + 1, "_part").sortWithinPartitions("_part", *order)
