"""Registered queries and the pipeline on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare, duck
from lakewarden.llm.registry import table
from tests.llm.helpers import documents, odd_documents, text

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_query_equals_oracle(spark, name):
    result, _ = compare(spark, duck(FOLDER), FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert result.startswith("ok"), result


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in entry.LLM_QUERIES if n != "pipeline") == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "span_dedup", "mix", "encode"]


@pytest.mark.parametrize("name", sorted(n for n in entry.LLM_QUERIES if n not in ("pipeline", "op10_warc_transactions", "op11_whitening",
                                                                           "op13_spelling_variants")))
def test_one_row_per_document(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    assert df.count() == table(spark, FOLDER, "documents").count()
    assert "doc_id" in df.columns


def test_pipeline_keeps_columns_and_round_trips(spark):
    docs = table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_documents(spark), documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            out.count()


def test_clean_documents_stay(spark):
    texts = [text(500 + i, 20) for i in range(60)]
    docs = documents(spark, texts)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 60, name
    assert sorted(r["text"] for r in docs.collect()) == sorted(texts)


def test_language_stage_without_labels_keeps_texts(spark):
    texts = [text(600 + i, 5) for i in range(8)] + [None, "", "12 34"]
    docs = documents(spark, texts).withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.language(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert sorted(r["text"] for r in out.collect()) == sorted(texts[:8])
