"""Rows without an id, with a shared id, and columns named like those of an operator."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from lakewarden.llm import langid, quality, spans, warc
from lakewarden.llm.flat import Flat, slices
from lakewarden.llm.ship import ship
from lakewarden.session import fresh_dir
from tests.llm.helpers import documents, odd_documents, sentence, text

PASSAGE = " ".join(sentence(random.Random(77 + i), 12) for i in range(5))


def around(seed):
    return f"{text(seed, 4)} {PASSAGE} {text(seed + 1, 4)}"


def plainly(rows):
    """What must be left of (doc_id, text) rows: one text at a time, places in a dictionary."""
    places = collections.defaultdict(set)

    def runs_of(value):
        flat = Flat(np.frombuffer(value.encode(), np.uint8), np.array([0, len(value.encode())]))
        return spans.Runs(flat)

    def place(doc_id, value):
        return (doc_id is not None, doc_id or 0, marks[value])

    marks = dict(rows["marks"])
    for doc_id, value in rows["rows"]:
        for h in runs_of(value or "").hash:
            places[int(h)].add(place(doc_id, value))
    out = []
    for doc_id, value in rows["rows"]:
        runs, gone, seen = runs_of(value or ""), set(), set()
        for low, high, h in zip(runs.low, runs.high, runs.hash):
            if int(h) in seen or min(places[int(h)]) < place(doc_id, value):
                gone |= set(range(low, high))
            seen.add(int(h))
        raw, starts = (value or "").encode(), [int(runs.starts[w]) for w in runs.first_word]
        ends = [*starts[1:], len(raw)]
        head = raw[:starts[0]] if starts else raw
        left = head + b"".join(raw[a:b] for i, (a, b) in enumerate(zip(starts, ends)) if i not in gone)
        out.append((doc_id, value if value is None else left.decode(), len(gone)))
    return collections.Counter(out)


def against_plain(docs):
    marks = docs.selectExpr("text", "xxhash64(text) m").distinct().collect()
    rows = docs.select("doc_id", "text").collect()
    want = plainly({"rows": [tuple(r) for r in rows], "marks": [tuple(r) for r in marks]})
    got = spans.without_repeated_spans(docs).select("doc_id", "text", "removed_sentences").collect()
    assert collections.Counter(tuple(r) for r in got) == want
    return got


def test_passages_of_rows_without_an_id_or_with_one_id(spark):
    texts = [around(10 * i) for i in range(15)] + [text(900 + i) for i in range(20)] + [around(0)] * 3
    ids = [None] * 5 + [5] * 5 + list(range(100, 125)) + [None] * 3
    got = against_plain(documents(spark, texts, ids))
    kept = [r for r in got if PASSAGE in r["text"]]
    # One text keeps the passage. If it is the repeated row, all copies of that row keep it.
    assert len({(r["doc_id"], r["text"]) for r in kept}) == 1 and {r["doc_id"] for r in kept} == {None}
    against_plain(odd_documents(spark))


def test_spans_equal_a_plain_version(spark):
    rng = random.Random(3)
    stock = [sentence(rng, rng.randint(3, 12)) for _ in range(60)]
    texts = []
    for _ in range(120):
        at = rng.randrange(50)
        texts.append(" ".join([text(rng.random(), 2), *stock[at:at + rng.randint(2, 9)], text(rng.random(), 2)]))
    against_plain(documents(spark, [*texts, None, "", texts[0]], [*range(122), 7]))


def test_columns_named_like_the_report_stay(spark):
    ship(spark)
    rows = [(i, around(20 * i), "mine", "own", i, "a") for i in range(4)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, removed_words string, _text string, Spans int, _hits string")
    got = spans.without_repeated_spans(docs)
    kept = ["doc_id", "text", "_removed_words", "_text", "_Spans", "_hits"]
    assert spans.kept_names(docs.columns) == kept
    assert got.columns == [*kept, "sentences", "removed_sentences", "removed_words", "spans"]
    for r in got.collect():
        assert (r["_removed_words"], r["_text"], r["_Spans"], r["_hits"]) == ("mine", "own", r["doc_id"], "a")
        assert (r["removed_words"] >= 55) == (r["doc_id"] > 0) and len(r["spans"]) == (r["doc_id"] > 0)


@pytest.mark.parametrize("low, high, stop", [(0x4E00, 0x9000, "。"), (0x0E01, 0x0E2E, ""), (0x20000, 0x20900, "！")])
def test_text_without_spaces_has_runs(spark, low, high, stop):
    rng = random.Random(low)

    def line(n):
        return "".join(chr(rng.randint(low, high - 1)) + (stop if i % 17 == 16 else "") for i in range(n))

    passage = line(300)
    texts = [line(rng.randint(50, 120)) + passage + line(rng.randint(50, 120)) for _ in range(5)]
    rows = {r["doc_id"]: r for r in against_plain(documents(spark, texts + [line(400) for _ in range(20)]))}
    assert rows[0]["text"] == texts[0]
    for i in range(1, 5):
        assert len(rows[i]["text"]) < len(texts[i]) - 230
    assert all(rows[i]["removed_sentences"] == 0 for i in range(5, 25))


def test_words_of_scripts_without_spaces_cover_the_text():
    texts = ["日本語のテキスト。abc é", "", "。。 x！", "ไทย" * 50, "한국어 글", "a😀b", "漢"]
    for _, flat in slices(pa.array(texts)):
        starts, ends, _ = spans._units(flat)
        plain_starts, plain_ends = flat.words()
        assert (starts < ends).all() and (starts[1:] >= ends[:-1]).all()
        covered = np.zeros(len(flat.data) + 1, int)
        np.add.at(covered, starts, 1)
        np.add.at(covered, ends, -1)
        want = np.zeros(len(flat.data) + 1, int)
        np.add.at(want, plain_starts, 1)
        np.add.at(want, plain_ends, -1)
        assert (np.cumsum(covered) == np.cumsum(want)).all()
        assert set(plain_starts) <= set(starts) and set(plain_ends) <= set(ends)
        for a in starts:  # never inside a character
            assert flat.data[a] & 0xC0 != 0x80


def test_samples_count_texts_and_not_rows_of_one_id(spark, monkeypatch):
    ship(spark)
    one = text(5)
    rows = spark.range(30_000).selectExpr("7L doc_id", f"'{one}' text", "'xx' lang") \
        .unionByName(spark.range(3_000).selectExpr(
            "cast(null as long) doc_id", "concat('word ', id, ' text') text", "'yy' lang")) \
        .unionByName(spark.range(50).selectExpr("id + 100 doc_id", "concat('other ', id) text", "'xx' lang"))
    seen = {}
    monkeypatch.setattr(langid, "Model", lambda names, x: seen.update(lang=collections.Counter(names)))
    langid.train(rows, 100)
    assert 40 <= seen["lang"]["xx"] <= 51 and 20 <= seen["lang"]["yy"] <= 100
    vectors = spark.sparkContext.broadcast(quality.word_vectors(rows.limit(100)))
    monkeypatch.setattr(quality, "Network", lambda x, y: seen.update(rows=len(x)))
    labels = spark.createDataFrame([(7, 1), (100, 0), (101, 0), (None, 1)], "doc_id long, quality int")
    quality.train(rows, labels, vectors, 100)
    assert seen["rows"] == 3
    labels = spark.range(100, 150).selectExpr("id doc_id", "id % 2 quality")
    quality.train(rows, labels, vectors, 20)
    assert seen["rows"] == 20


def test_pages_dealt_out_differently_are_refused(spark):
    ship(spark)
    folder = fresh_dir(spark, "pages")
    spark.range(2_000).selectExpr(
        "id page_id", "concat('http://x/', id) url", "repeat(concat('page ', id % 20), 40) html", "rand(1) other") \
        .write.parquet(folder)
    pages = spark.read.parquet(folder)
    target = fresh_dir(spark, "warc")
    warc.write(pages, target)
    got = warc.assemble(warc.read(spark, target)).collect()
    assert len(got) == 2_000
    assert all(r["refers_to"] == (None if r["page_id"] < 20 else r["page_id"] % 20) for r in got)
    with pytest.raises(Exception, match="dealt out differently"):
        warc.write(pages.repartition(7), fresh_dir(spark, "warc"))


def test_the_stage_returns_the_columns_as_they_came(spark):
    import corpus_pipeline

    docs = documents(spark, [around(30 * i) for i in range(3)])
    rows = {r["doc_id"]: r for r in corpus_pipeline.span_dedup(spark, docs, "").collect()}
    assert all(r["spans"] == "x" and r["n_chars"] == len(r["text"]) for r in rows.values())
    assert PASSAGE in rows[0]["text"] and PASSAGE not in rows[1]["text"]
