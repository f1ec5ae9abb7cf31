"""Spelling variants: words that differ by one code point, by a dictionary of pairs of trie nodes.

Words are counted over whole texts. All prefixes of the counted words are the nodes of a forward trie,
all their suffixes those of a reversed one; both are numbered. A word stands under the integer pairs
(prefix node, suffix node) of every place between two code points ("whole") and under the pairs on
either side of every code point ("skipped"). Then, exactly and without comparing words:

* two words with the same skipped pair differ by one replaced code point, and share no other;
* a word that is whole where another one is skipped is that word with a code point deleted. Of a run
  of equal code points only the first counts as skipped here, so such words meet once.

All words under one pair fit between one prefix and one suffix, with at most one code point between
them: they are no more than the letters there are (90), whatever the corpus. What a pair tells (how
many near words, which comes first) is added up per word, so pairs of words are never listed.

Words are numbered by falling count, then by code points: the smallest number is the best near word.
A word's form is that near word, if it is at least ``ratio`` times as frequent; roots follow forms
to the last, by doubling, since counts grow at every step.

Nodes of more than BLOCK code points are known by a SHA-256 chain over their blocks and the rest, so
rows stay short for words of any length. Null texts have no words; a null id counts as an empty one
in the rule of deletion. Repeated rows count each. An empty table gives no rows. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.scratch import Scratch

RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIVISOR = 97
SHORTEST, LEAST, RATIO = 5, 3, 2
BLOCK = 64
ROWS = 1 << 16


def words(docs: DataFrame) -> DataFrame:
    """Every run of letters as a word: capitals A-Z made small, and of one in DIVISOR (id, run) a code
    point deleted."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", CAPITALS, SMALL), F.lit(RUN), F.lit(0))).alias("run"))
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    drawn = runs.select("run", mark.alias("mark"))
    at = F.pmod("mark", F.length("run")).cast("int")
    less = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return drawn.select(F.when(F.col("mark") % DIVISOR == 0, less).otherwise(F.col("run")).alias("word"))


def dictionary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """Words and their counts."""
    return words(docs).filter(F.length("word") >= shortest).groupBy("word") \
        .agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def node_names(word: str) -> list[str]:
    """Name of every prefix, from the empty one to the word. Short prefixes stand for themselves; a
    longer one is its length, the chain over its whole blocks and the rest."""
    out = [word[:i] for i in range(min(len(word), BLOCK) + 1)]
    chain, base = b"", 0
    for i in range(BLOCK + 1, len(word) + 1):
        if i - base > BLOCK:
            chain = hashlib.sha256(chain + word[base:base + BLOCK].encode()).digest()
            base += BLOCK
        out.append(f"{i}:{chain.hex()}:{word[base:i]}")
    return out


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        numbers, skips, firsts, prefixes, suffixes = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(skips, pa.bool_()), pa.array(firsts, pa.bool_()),
             pa.array(prefixes, pa.string()), pa.array(suffixes, pa.string())],
            ["number", "skipped", "first", "prefix", "suffix"])

    rows: list[tuple] = []
    for batch in batches:
        for number, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before, after = node_names(word), node_names(word[::-1])
            size = len(word)
            for i in range(size + 1):
                rows.append((number, False, False, before[i], after[size - i]))
                if i < size:
                    rows.append((number, True, not i or word[i] != word[i - 1],
                                 before[i], after[size - i - 1]))
                if len(rows) >= ROWS:
                    yield batch_of(rows)
                    rows = []
    if rows:
        yield batch_of(rows)


PLACE = "number long, skipped boolean, first boolean, prefix string, suffix string"


def numbered(names: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """A number for every different name: the nodes of a trie. Stored, so that numbers stay."""
    return scratch.save(names.select(name).distinct()
                        .withColumn(f"{name}_node", F.monotonically_increasing_id()), name)


def node_pairs(ranked: DataFrame, scratch: Scratch) -> DataFrame:
    """Every word (number) under its pairs of nodes."""
    places = scratch.save(ranked.select("number", "word").mapInArrow(_places, PLACE), "places")
    prefixes, suffixes = numbered(places, "prefix", scratch), numbered(places, "suffix", scratch)
    pairs = scratch.save(
        places.join(prefixes, "prefix").select("number", "skipped", "first", "suffix", "prefix_node")
        .join(suffixes, "suffix").select("number", "skipped", "first", "prefix_node", "suffix_node"), "pairs")
    scratch.drop(places, prefixes, suffixes)
    return pairs


def near(pairs: DataFrame) -> DataFrame:
    """Per word with near words: how many, and the first of them."""
    met = pairs.groupBy("prefix_node", "suffix_node").agg(
        F.max(F.when(~F.col("skipped"), F.col("number"))).alias("whole"),  # at most one: prefix + suffix
        F.collect_list(F.when(F.col("skipped"), F.col("number"))).alias("skips"),
        F.collect_list(F.when(F.col("first"), F.col("number"))).alias("firsts")) \
        .filter((F.size("skips") > 1) | (F.col("whole").isNotNull() & (F.size("firsts") > 0)))
    met = met.select("whole", F.array_sort("skips").alias("skips"), "firsts")

    def told(number, best, n):
        return F.struct(number.alias("number"), best.alias("best"), n.cast("long").alias("n"))

    some = F.filter("skips", lambda s: F.size("skips") > 1)  # none of a single word
    replaced = F.transform(some, lambda s: told(
        s, F.when(s == F.col("skips")[0], F.try_element_at("skips", F.lit(2))).otherwise(F.col("skips")[0]),
        F.size("skips") - 1))
    inserted = F.when(F.col("whole").isNotNull(), F.col("firsts")).otherwise(F.array().cast("array<long>"))
    longer = F.transform(inserted, lambda s: told(s, F.col("whole"), F.lit(1)))
    shorter = F.transform(
        F.filter(F.array(F.array_min(inserted)), lambda s: s.isNotNull()),
        lambda s: told(F.col("whole"), s, F.size("firsts")))
    return met.select(F.explode(F.concat(replaced, longer, shorter)).alias("t")) \
        .groupBy(F.col("t.number").alias("number")) \
        .agg(F.sum("t.n").alias("n_near"), F.min("t.best").alias("best"))


def last_of(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """The end of the chain that begins at every ``number`` with an ``up``; each round doubles the steps."""
    steps = scratch.save(forms.select("number", "up"), "steps")
    while True:
        above = steps.select(F.col("number").alias("up"), F.col("up").alias("top"))
        jumped = scratch.save(steps.join(above, "up", "left").select(
            "number", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "steps")
        scratch.drop(steps)
        if jumped.filter("moved").isEmpty():
            return jumped.select("number", F.col("up").alias("last"))
        steps = jumped.drop("moved")
        steps._scratch = jumped._scratch


def grouped(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession, "variants")
    counted = scratch.save(dictionary(docs, shortest, least), "counted")
    # Sorted before they are numbered, so numbers follow count and spelling.
    ranked = scratch.save(counted.orderBy(F.desc("n"), "word")
                          .select("word", "n", F.monotonically_increasing_id().alias("number")), "ranked")
    scratch.drop(counted)
    pairs = node_pairs(ranked, scratch)
    found = scratch.save(near(pairs), "near")
    scratch.drop(pairs)
    others = ranked.select(F.col("number").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    own = scratch.save(ranked.join(found, "number", "left").join(others, "best", "left").select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "own")
    ends = last_of(own.filter("best is not null").select("number", F.col("best").alias("up")), scratch)
    roots = ranked.select(F.col("number").alias("last"), F.col("word").alias("root"))
    return own.join(ends, "number", "left").join(roots, "last", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
