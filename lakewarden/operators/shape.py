"""Projections and row-shape changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def evolve(df: DataFrame, rename: Mapping[str, str] | None = None,
           add: Mapping[str, Column] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Rename, add and drop columns in one projection."""
    rename, add = rename or {}, add or {}
    kept = [F.col(c).alias(rename.get(c, c)) for c in df.columns if c not in drop]
    return df.select(*kept, *[value.alias(name) for name, value in add.items()])


def replicate(df: DataFrame, copies: int, id_name: str, key: Sequence[str]) -> DataFrame:
    """Every row ``copies`` times with a new id.

    The copies are made by a generator inside the scan stage, so nothing is shuffled. The id is
    made of two 64-bit hashes of the row key and the copy number: a retried task writes the same
    ids again.
    """
    numbered = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    first, second = F.xxhash64(*key, "_copy"), F.xxhash64("_copy", *key, F.lit("second"))
    return numbered.withColumn(id_name, F.concat_ws("-", F.hex(first), F.hex(second))).drop("_copy")


def domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column in order."""
    return df.select(column).distinct().orderBy(column)


def flatten_params(df: DataFrame, params: str, keys: Mapping[str, str], name: str = "key",
                   value: str = "value") -> DataFrame:
    """Repeated name/value parameters (array of struct) to one typed column per wanted name.

    ``keys`` maps a parameter name to its type. A lookup inside the row replaces explode and
    pivot, so the nested array costs no shuffle.
    """
    lookup = F.map_from_entries(
        F.transform(F.array_distinct(F.col(params)[name]), lambda k: F.struct(
            k, F.element_at(F.filter(F.col(params), lambda p: p[name] == k), 1)[value])))
    wide = df.withColumn("_params", lookup)
    return wide.select(
        *[c for c in df.columns if c != params],
        *[F.expr(f"try_cast(_params['{k}'] AS {kind})").alias(k) for k, kind in keys.items()],
    )


def first_rows(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """Ordered report, cut to its first ``n`` rows when ``n`` is given (top-k)."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)
