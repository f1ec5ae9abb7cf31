"""Mixing sources to target weights with a low-discrepancy schedule.

The words of each source, its documents in shuffled order, are one stream, cut into blocks of equally
many words. Slot i of the schedule is the point ``i * golden ratio mod 1``, mapped through the
cumulative targets to a source; its rank among the slots of that source is the block it takes,
beginning anew after the last block. Every prefix of the schedule is close to the target shares.
A source gets exactly the blocks its target needs: surplus slots are left out, missing ones (a few
per source, the discrepancy) come at the end, and its last block is trimmed.

Documents are ordered by a hash, in about sqrt(n) buckets per source whose sums are added up first,
and slots are ranked in chunks the same way, so no task holds a source. Only the table of sources is
collected; more than MAX_SOURCES is an error. The golden-ratio points have 32 bits and repeat after
2**31 slots, which block sizes that grow with the root of the corpus stay far below.

Nulls and texts without a word have size 0 and are never taken. A null source is a source, the last.
Rows that repeat a doc_id are documents of their own. Reruns give the same result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakewarden.llm.scratch import Scratch

WEIGHTS = (5, 2, 1)
EPOCHS = 3
MAX_SOURCES = 100_000
GOLDEN = 2654435769  # 2**32 / golden ratio


def n_words(text: str):
    return F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")),
                                       F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, epochs: float) -> list[float]:
    """Split ``total`` by weight; nothing above ``epochs`` times its size, the excess is shared again
    by weight among the others until none is above."""
    out, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while free:
        all_weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / all_weight > epochs * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / all_weight
            break
        for i in over:
            out[i] = float(epochs * sizes[i])
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


@dataclass
class Plan:
    """Per source, in its order: name, size in words, target, words to take; and the block size."""
    names: list
    sizes: list[int]
    targets: list[float]
    takes: list[int]
    docs: int
    block: int

    @property
    def slots(self) -> int:
        return math.ceil(sum(self.takes) / self.block)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per source; at most MAX_SOURCES, so small enough to broadcast."""
        rows = []
        for i, (name, size, target, take) in enumerate(
                zip(self.names, self.sizes, self.targets, self.takes)):
            blocks = -(-size // self.block)
            rounds, rest = divmod(take, size) if size else (0, 0)
            last = -(-rest // self.block)
            rows.append((i, name, size, target, blocks, rounds * blocks + last,
                         rest - (last - 1) * self.block if rest else self.block))
        return spark.createDataFrame(
            rows, "sid int, source string, source_size long, target double, blocks long, "
                  "needed long, last_words long")


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS) -> Plan:
    """Targets from the sizes per source; sources in code point order, null last."""
    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")) \
        .limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in found]
    total = sum(sizes)
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], total, epochs)
    takes = [min(math.floor(a + 0.5), epochs * s) for a, s in zip(aims, sizes)]
    block = max(16, math.ceil(math.sqrt(total) / 16))
    return Plan([r["source"] for r in found], sizes, aims, takes, sum(r["docs"] for r in found), block)


def schedule(spark: SparkSession, mix: Plan) -> DataFrame:
    """The slots in order: position, sid, rank, block, words (at most; only a last block is cut)."""
    ends = np.cumsum(np.array(mix.takes, np.float64))
    ends = ends / ends[-1] if len(ends) and ends[-1] > 0 else ends
    known = mix.table(spark)
    if not mix.slots:
        return known.limit(0).selectExpr(
            "0L position", "sid", "0L rank", "0L block", "last_words words")

    @F.pandas_udf("int")
    def source_at(point: pd.Series) -> pd.Series:
        found = np.searchsorted(ends, point.to_numpy() / 2.0 ** 32, side="right")
        return pd.Series(np.minimum(found, len(ends) - 1).astype(np.int32))

    chunk = math.ceil(math.sqrt(mix.slots))
    points = spark.range(mix.slots).select(
        F.col("id").alias("position"),
        source_at(F.expr(f"((id % 2147483648L) * {GOLDEN}L) % 4294967296L")).alias("sid"),
        F.expr(f"id div {chunk}").alias("chunk"))
    counts = points.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    here = Window.partitionBy("sid", "chunk").orderBy("position")
    ranked = points.withColumn("nth", F.row_number().over(here) - 1).join(ahead, ["sid", "chunk"]) \
        .select("position", "sid", (F.col("ahead") + F.col("nth")).alias("rank"))
    known = F.broadcast(known)
    given = counts.groupBy("sid").agg(F.sum("n").alias("given"))
    missing = known.join(given, "sid", "left") \
        .withColumn("given", F.coalesce("given", F.lit(0))).filter("given < needed") \
        .select("sid", F.explode(F.sequence("given", F.col("needed") - 1)).alias("rank")) \
        .select((F.lit(mix.slots) + F.col("rank")).alias("position"), "sid", "rank")
    return ranked.unionByName(missing).join(known, "sid").filter("rank < needed").select(
        "position", "sid", "rank", F.expr("rank % blocks").alias("block"),
        F.when(F.col("rank") == F.col("needed") - 1, F.col("last_words"))
        .otherwise(F.lit(mix.block)).alias("words"))


def _streams(sized: DataFrame, mix: Plan) -> DataFrame:
    """Every document with words: sid and the place of its first word in its source's stream."""
    buckets = math.ceil(math.sqrt(max(mix.docs, 1)))
    known = F.broadcast(mix.table(sized.sparkSession).select(F.col("source").alias("_source"), "sid"))
    placed = sized.filter("size > 0").join(known, F.col("source").eqNullSafe(F.col("_source"))) \
        .select("doc_id", "size", "sid", F.xxhash64(F.lit(17), "doc_id", "size").alias("turn")) \
        .withColumn("bucket", F.expr(f"pmod(turn, {buckets})"))
    sums = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"))
    here = Window.partitionBy("sid", "bucket").orderBy("turn", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn("upto", F.sum("size").over(here)).join(ahead, ["sid", "bucket"]) \
        .select("doc_id", "size", "sid", (F.col("ahead") + F.col("upto") - F.col("size")).alias("start"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (words), source_size, target (words of its
    source in the mix), taken (words of the document in the mix, repeats counted)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    sized = scratch.save(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                                     n_words("text").alias("size")), "sizes")
    mix = plan(sized, weights, epochs)
    b = mix.block
    pieces = _streams(sized, mix).withColumn(
        "block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})"))
    ).select("doc_id", "size", "sid", "start", "block",
             F.expr(f"greatest(start - block * {b}, 0)").alias("low"),
             F.expr(f"least(start + size - block * {b}, {b})").alias("high"))
    slots = schedule(spark, mix).select("sid", "block", "words")
    reach = F.least("high", F.coalesce("words", F.lit(0)))  # a block without a slot takes nothing
    part = F.greatest(reach - F.col("low"), F.lit(0))
    taken = pieces.join(slots, ["sid", "block"], "left") \
        .groupBy("sid", "start", "doc_id", "size") \
        .agg(F.coalesce(F.sum(part), F.lit(0)).cast("long").alias("taken"))
    known = F.broadcast(mix.table(spark).select("sid", "source", "source_size", "target"))
    filled = taken.join(known, "sid").select(
        "doc_id", "source", "size", "source_size", "target", "taken")
    empty = sized.filter("size = 0").alias("e") \
        .join(known.alias("k"), F.col("e.source").eqNullSafe(F.col("k.source"))) \
        .select("doc_id", "e.source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return filled.unionByName(empty)


def mixture(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, columns as they came, in as many whole copies as epochs
    of their source reach them. Rows that repeat doc_id, source and size get equally many copies."""
    copies = mixed(docs, weights, epochs).filter("taken > 0") \
        .groupBy("doc_id", "source", "size") \
        .agg(F.max(F.expr("(taken + size - 1) div size")).alias("_copies")) \
        .select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "size")], "_copies")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & \
        F.col("source").cast("string").eqNullSafe(F.col("_source")) & (n_words("text") == F.col("_size"))
    return docs.join(copies, same).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
