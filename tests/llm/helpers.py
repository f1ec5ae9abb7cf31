"""Small tables for the operators: nulls, empty, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

from lakewarden.llm.ship import ship

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("node", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("spans", T.StringType())])


def sentence(rng: random.Random, n: int = 9) -> str:
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8)))
             for _ in range(n)]
    return " ".join(words).capitalize() + "."


def text(seed: int, sentences: int = 12) -> str:
    rng = random.Random(seed)
    return " ".join(sentence(rng) for _ in range(sentences))


ODD = [None, "", " ", "\n\t ", "...", "12 34", "é", "one two", "日本語のテキスト", "a  b \n c d",
       "😀 <|endoftext|> x", "word " * 3000, text(1), text(1)]


def documents(spark, texts, ids=None):
    ship(spark)
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if k % 2 else None, [None, "a", "b"][k % 3], None if t is None else len(t),
             "x", "x", "x", "x") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def odd_documents(spark):
    """The odd texts, a null id, a repeated id with another text and a repeated row."""
    ids = [*range(len(ODD) - 2), None, 3, 3]
    return documents(spark, [*ODD, ODD[-1]], ids)
