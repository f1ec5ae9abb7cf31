"""Upstream walk over a table lineage edge list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakewarden.session import durable

SOURCE, TARGET = "source_table_full_name", "target_table_full_name"


def lineage_edges(lineage: DataFrame, prefix: str) -> DataFrame:
    """Edges into tables whose name starts with ``prefix``, with the latest time."""
    return (
        lineage.filter(F.col(TARGET).startswith(prefix))
        .groupBy(SOURCE, "source_type", TARGET, "target_type")
        .agg(F.max("event_time").alias("last_updated"))
        .orderBy(F.desc("last_updated"), SOURCE, TARGET)
    )


def upstream(lineage: DataFrame, target: str, depth: int = 5) -> DataFrame:
    """All edges that lead to ``target`` within ``depth`` steps.

    Edges are made distinct once. Each step joins only the tables found in the step before, each
    once, and is written out, so a cycle costs no more than ``depth`` steps and a lost executor
    does not repeat earlier ones.
    """
    edges = durable(lineage.select(SOURCE, TARGET).distinct(), "edges")
    step = durable(edges.filter(F.col(TARGET) == target).withColumn("depth", F.lit(1)), "step")
    steps = [step]
    for level in range(2, depth + 1):
        frontier = step.select(F.col(SOURCE).alias(TARGET)).distinct()
        step = durable(edges.join(frontier, TARGET).select(
            SOURCE, TARGET, F.lit(level).alias("depth")), "step")
        if step.isEmpty():
            break
        steps.append(step)
    return reduce(DataFrame.unionByName, steps)
