"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.llm import (
    bytepiece, compression, dartminhash, imatch, langid, mixing, quality, repair,
    spans, toxicity, variants, warc, whitening)
from lakewarden.session import fresh_dir
from lakewarden.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401


@query("op1_mix_sources")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op2_sentence_spans")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spans.without_repeated_spans(docs)


def learned(docs: DataFrame) -> langid.Model:
    """The language model of the rows that may be learned from."""
    return langid.train(docs.filter(~langid.held_out("doc_id", 5, 0)))


@query("op4_language")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs.select("doc_id", "text"), learned(docs)).select(
        "doc_id", langid.held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


@query("op6_dart_minhash")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "class_size", "copies",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


@query("op7_byte_pieces")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bytepiece.encoded(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query("op8_compression_bands")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return compression.judged(table(spark, folder, "documents"))


OP10_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
                  sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""


@query("op10_warc_transactions", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    archives = fresh_dir(spark, "warc")
    warc.write(table(spark, folder, "pages"), archives)
    return warc.resolved_bytes(warc.assemble(warc.read(spark, archives))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_imatch_subsets")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprints(table(spark, folder, "documents"))


@query("op5_repair_shards")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    shards = fresh_dir(spark, "repair")
    repair.write(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), shards)
    return repair.read(spark, shards)


@query("op3_quality_network")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    apart = langid.held_out("doc_id", 4, 2)
    labels = table(spark, folder, "labels").filter(~apart).select("doc_id", "quality")
    return quality.scored(table(spark, folder, "documents"), labels).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op11_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whitened(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query("op12_toxicity")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    apart = langid.held_out("doc_id", 3, 1)
    labels = table(spark, folder, "labels").filter(~apart).select("doc_id", "toxic")
    return toxicity.scored(table(spark, folder, "documents"), labels).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return variants.grouped(table(spark, folder, "documents"))
