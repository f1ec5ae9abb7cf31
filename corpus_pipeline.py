"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.llm import bytepiece, dartminhash, langid, mixing, spans
from lakewarden.llm.queries import learned
from lakewarden.llm.registry import table
from lakewarden.llm.scratch import Scratch
from lakewarden.llm.ship import ship


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (``und``); a missing lang is filled with the found one.
    Without any label to learn from it stays null, and only texts that are null or have no letter go."""
    ship(spark)
    model = learned(docs)
    if not model.langs:  # nothing says that a text has no language, but that it has no letter
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model, "_lang", "_score").filter(F.col("_lang") != langid.NONE)
    return found.withColumn("lang", F.coalesce("lang", "_lang")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    ship(spark)
    return dartminhash.one_of_each(docs)


def span_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated sentences out of the texts; documents that nothing is left of go. Columns named
    like those of the operator's report keep the values they came with."""
    ship(spark)
    clean = spans.without_repeated_spans(docs) \
        .filter((F.col("removed_sentences") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    kept = spans.kept_names(docs.columns)
    return clean.select(*[F.col(f"`{k}`").alias(c) for k, c in zip(kept, docs.columns)])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the documents of each source as often as its target asks, up to three times."""
    ship(spark)
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with hashes of the ids and of the bytes they decode to."""
    ship(spark)
    return bytepiece.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                             public_tokenizers.PATTERN, with_ids=True, cache=CACHE)


#: The last stage finds executors that four stages have filled, so its tables of pieces are small.
CACHE = 16 << 20

STAGES = [("language", language), ("near_dedup", near_dedup), ("span_dedup", span_dedup),
          ("mix", mix), ("encode", encode)]

#: A trained classifier, random darts and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
