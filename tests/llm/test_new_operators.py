"""Whitening, toxicity and spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakewarden.llm import toxicity, variants, whitening
from lakewarden.llm.flat import slices
from lakewarden.llm.registry import table
from tests.llm.helpers import documents, odd_documents, text

FOLDER = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, "x", "y") for i, v in rows],
        "vec_id long, embedding array<double>, n string, entries string").repartition(3)


def plain_whitening(rows, k=8):
    """Covariance and its eigenvectors by numpy; rows in the order given."""
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n = len(x)
    apart = n * x - x.sum(axis=0)
    value, vector = np.linalg.eigh((apart / n).T @ (apart / n) / n)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    return apart, value, (apart / n) @ vector / np.sqrt(value)


def test_whitening_equals_numpy(spark):
    rng = np.random.RandomState(1)
    mixed = rng.randn(400, 12) @ rng.randn(12, 12) + 3
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(5, mixed[5].tolist()), (None, mixed[6].tolist())]
    apart, value, white = plain_whitening(rows)
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert len(got) == 8 * len(rows)
    by = {(r["vec_id"], r["component"]): r for r in got}
    trace = ((apart / len(rows)) ** 2).sum() / len(rows)
    for at, (i, _) in enumerate(rows[:400]):
        for c in range(1, 9):
            r = by[i, c]
            assert abs(abs(r["whitened"]) - abs(white[at, c - 1])) < 1e-9
            assert abs(r["explained"] - value[c - 1] / trace) < 1e-12
            assert int(r["deviation"]) == int((apart[at] ** 2).sum())
            assert r["n"] == len(rows) and r["identity_error"] < 1e-9


def test_whitening_leaves_out_bad_vectors_and_directions_without_spread(spark):
    good = [(i, [float(i), 2.0 * i, 1.0]) for i in range(6)]
    bad = [(10, None), (11, []), (12, [1.0, None, 2.0]), (13, [1.0, float("nan"), 2.0]),
           (14, [float("inf"), 1.0, 2.0])]
    got = whitening.whitened(vectors(spark, good + bad)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got) == [(i, 1) for i in range(6)]
    assert all(abs(r["explained"] - 1) < 1e-12 for r in got)
    for rows in ([], bad, [(1, [1.0, 2.0])] * 3):
        assert whitening.whitened(vectors(spark, rows)).count() == 0
    with pytest.raises(Exception, match="different lengths"):
        whitening.whitened(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_whitening_is_exact_for_large_numbers():
    u = np.random.RandomState(3).randint(-(1 << 40), 1 << 40, (50, 4))
    assert (whitening.products(u) == u.T.astype(object) @ u.astype(object)).all()
    assert list(whitening.deviation(u)) == [sum(int(c) ** 2 for c in r) for r in u]


def test_factor_and_rotation_keep_the_scatter():
    a = np.random.RandomState(4).randn(9, 30)
    scatter = a @ a.T
    factor = whitening.triangular(scatter)
    turned = whitening.orthogonal_columns(factor)
    inner = turned.T @ turned
    assert np.abs(factor @ factor.T - scatter).max() < 1e-10
    assert np.abs(turned @ turned.T - scatter).max() < 1e-10
    assert np.abs(inner - np.diag(inner.diagonal())).max() < 1e-10 * inner.max()


def plain_variants(rows, shortest=5, least=3, ratio=2):
    small = str.maketrans(variants.CAPITALS, variants.SMALL)
    seen = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(small)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += 1
    n = {w: k for w, k in seen.items() if len(w) >= shortest and k >= least}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))

    close = defaultdict(list)
    for a in n:
        close[a] = [b for b in n if near(a, b)]
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= ratio * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(close[w]), n.get(form.get(w))) for w in n)


def test_variants_equal_brute_force(spark):
    rng = random.Random(6)
    base = ["aaaaaa", "aaaaa", "aaaaab", "banana", "bananna", "bannana", "Éclair", "éclair", "eclair", "straße",
            "strasse", "strase", "x×yza", "kitten", "kittens", "mitten", "mittens", "written", "ñandu", "ÑANDU"]
    for w in list(base):
        at = rng.randrange(len(w))
        base += [w[:at] + rng.choice("abné") + w[at + 1:], w[:at] + rng.choice("abné") + w[at:], w[:at] + w[at + 1:]]
    texts = [" ".join(rng.choice(base[:1 + rng.randrange(len(base))]) for _ in range(60)) + rng.choice("!1_日 ")
             for _ in range(40)]
    ids = [None, 3, 3, *range(10, 47)]
    rows = list(zip(ids, texts)) + [(99, None), (100, "")]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    assert sorted(tuple(r) for r in variants.grouped(docs).collect()) == plain_variants(rows)


def test_variants_of_very_long_words(spark):
    long = "".join(random.Random(7).choice("abcdefgh") for _ in range(700))
    rows = [(i, f"{long} {long[:300]}z{long[301:]} {long[:65]} {long[:64]} {long[:500]}{long[501:]}") for i in range(4)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    assert sorted(tuple(r) for r in variants.grouped(docs).collect()) == plain_variants(rows)
    names = variants.node_names(long)
    assert len(names) == 701 and len(set(names)) == 701 and max(map(len, names)) < 140


def test_new_operators_take_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    for docs in (odd_documents(spark), documents(spark, [])):
        n = docs.count()
        assert toxicity.scored(docs, labels).count() == n
        assert toxicity.scored(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
        variants.grouped(docs).count()
    assert variants.grouped(documents(spark, [])).count() == 0


def marked(n=240):
    """Texts with an insult in one of four, in two languages, the insults with many endings."""
    rng = random.Random(8)
    out = []
    for i in range(n):
        english = i % 2
        words = text(9000 + i, 4).split()
        words += (["the", "of", "and"] if english else ["der", "und", "nicht"]) * 4
        if i % 4 < 1 or i % 4 == 3 and i % 8 == 3:
            words += ["nasty" if english else "fieser" + rng.choice(["", "ung", "heit", "lich", "e"])] * 2
        rng.shuffle(words)
        out.append((" ".join(words), int("nasty" in words or any(w.startswith("fies") for w in words))))
    return out


def test_toxicity_learns_words_and_stems(spark):
    rows = marked()
    docs = documents(spark, [t for t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows[:160])], "doc_id long, toxic int")
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, labels).collect()}
    right = [(score[i] >= 0.7) == bool(y) for i, (_, y) in enumerate(rows) if i >= 160]
    assert sum(right) / len(right) > 0.95
    again = {r["doc_id"]: r["score"] for r in toxicity.scored(docs.repartition(5), labels).collect()}
    assert all(abs(score[i] - again[i]) < 1e-3 for i in score)


def test_toxicity_of_one_label_is_its_share(spark):
    docs = documents(spark, ["a b", "c d", None])
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.scored(docs, labels).collect()} == {0.75}


def test_toxicity_sample_counts_pairs_of_id_and_text(spark):
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    other = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("four five").alias("text"))
    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    assert toxicity.scored(same.union(other), labels).count() == 3050


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    rng = random.Random(5)
    n = 7200
    rows = [("vile " if i % 2 else "kind ") + " ".join(rng.choice("abcdefgh") * 3 for _ in range(4)) for i in range(n)]
    rows[:10] = [r + " word" * 5000 for r in rows[:10]]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TEXTS", 1000)
    seen = []
    monkeypatch.setattr(toxicity, "learned", lambda blocks, *rest, inner=toxicity.learned: (
        seen.append(blocks.toPandas()), inner(blocks, *rest))[1])
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, labels).collect()}
    [blocks] = seen
    assert len(blocks) >= 7 and sum(len(b) // 4 for b in blocks["sizes"]) == n
    assert sum(len(b) // 4 for b in blocks["codes"]) == sum(len(r.split()) for r in rows)
    assert all((score[i] >= 0.7) == bool(i % 2) for i in range(n))


def test_toxicity_learns_from_long_texts(spark):
    rows = [text(i, 2) + " word" * 4500 + (" vile" if i % 2 else " kind") * 3 for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, toxic int")
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(documents(spark, rows), labels).collect()}
    assert min(score[i] for i in range(1, 160, 2)) >= 0.7 > max(score[i] for i in range(0, 160, 2))


def test_toxicity_blocks_end_at_so_many_words(monkeypatch):
    monkeypatch.setattr(toxicity, "WORDS", 10)
    texts = [np.arange(n, dtype="<i4") for n in (4, 6, 1, 25, 0, 3)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 0, 0, 0, 0, 1], pa.int32()), pa.array([0, 1, 0, 1, 0, 1]), pa.array([0, 0, 1, 0, 0, 0]),
         pa.array([toxicity._planes(t) for t in texts], pa.binary())], ["part", "label", "apart", "codes"])
    rows = [r for b in toxicity._pack([batch]) for r in b.to_pylist()]
    assert [(r["part"], r["block"]) for r in rows] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0)]
    found = [toxicity._block(r) for r in rows]
    assert [np.diff(e, prepend=0).tolist() for _, e, _, _ in found] == [[4, 6], [1], [25], [0], [3]]
    assert np.concatenate([c for c, _, _, _ in found]).tolist() == np.concatenate(texts).tolist()


def test_word_counts_equal_a_plain_count():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["ab", "abcde", "abcdf", "x", "über"]) for _ in range(rng.randint(0, 9)))
             for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = {}
    for out in toxicity._count(iter([batch.slice(0, 100), batch.slice(100)])):
        for h, s, n in zip(*(c.to_pylist() for c in out.columns)):
            if s:
                found[h] = found.get(h, 0) + n
    plain = {}
    for t in texts:
        for w in set(t.split()):
            plain[w] = plain.get(w, 0) + 1
    assert {int(toxicity._hashes_of([w])[0].view(np.int64)[0]): n for w, n in plain.items()} == found


def test_peaks_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.RandomState(9)
    net = toxicity.Network(50)
    texts = [rng.randint(0, 50, (2, n)) for n in (0, 1, 2, 40, 7, 300)]
    doc = np.repeat(np.arange(len(texts)), [t.shape[1] for t in texts])
    line, start = toxicity.sequence(len(texts), doc, np.concatenate(texts, axis=1))
    top, place = net.peaks(line, start)
    assert np.allclose(top, net.largest(line, start))
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    again, where = net.peaks(line, start)
    assert np.allclose(again, top) and (where == place).all()


def test_largest_responses_do_not_depend_on_blocks():
    rng = np.random.RandomState(9)
    net = toxicity.Network(50)
    net.embedding = rng.randn(50, toxicity.DIMENSIONS).astype(np.float32)
    net.embedding[0] = 0
    texts = [rng.randint(0, 50, (2, n)).astype(np.int32) for n in (0, 1, 2, 40, 7, 300)]
    doc = np.repeat(np.arange(len(texts)), [t.shape[1] for t in texts])
    line, start = toxicity.sequence(len(texts), doc, np.concatenate([t.T for t in texts]).T)
    whole = net.largest(line, start)
    block, toxicity.BLOCK = toxicity.BLOCK, 16
    try:
        assert np.allclose(net.largest(line, start), whole, atol=1e-5)
    finally:
        toxicity.BLOCK = block
    for t, own in enumerate(texts):  # the forward pass by a plain loop
        x = np.vstack([net.embedding[own[0]] + net.embedding[own[1]],
                       np.zeros((toxicity._PAD + (own.shape[1] == 0), toxicity.DIMENSIONS))])
        for i, (w, f) in enumerate(zip(toxicity.WIDTHS, net.filters)):
            values = [x[p:p + w].ravel() @ f for p in range(max(own.shape[1], 1))]
            best = np.max(values, axis=0)
            assert np.allclose(whole[t, i * toxicity.FILTERS:(i + 1) * toxicity.FILTERS], best, atol=1e-4)


def test_word_hashes_fold_case_and_share_stems():
    texts = pa.array(["ÉCLAIR Haus", "éclair haus", "éclaircie hausen", "", "1 2"])
    [(_, flat)] = list(slices(texts))
    doc, hashes = toxicity.word_hashes(flat)
    assert doc.tolist() == [0, 0, 1, 1, 2, 2]
    assert (hashes[:, :2] == hashes[:, 2:4]).all()
    assert (hashes[1, 2:4] == hashes[1, 4:]).all() and (hashes[0, 2:4] != hashes[0, 4:]).all()


def test_registered_queries_cover_their_tables(spark):
    found = entry.queries()["op11_whitening"](spark, FOLDER)
    assert dict(found.dtypes)["deviation"] == "bigint"
    assert found.select("vec_id").distinct().count() == table(spark, FOLDER, "embeddings").count()
    docs = table(spark, FOLDER, "documents")
    got = sorted(tuple(r) for r in entry.queries()["op13_spelling_variants"](spark, FOLDER).collect())
    assert got == plain_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
