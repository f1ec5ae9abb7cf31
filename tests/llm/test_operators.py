"""Operators against brute force on small tables, with odd rows."""

import base64
import collections
import hashlib
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest

from lakewarden.llm import (
    bytepiece, compression, dartminhash, imatch, langid, mixing, quality, repair, spans, warc)
from lakewarden.llm.components import components
from lakewarden.llm.pieces import PieceTable, parts_of
from lakewarden.llm.scratch import Scratch
from lakewarden.llm.ship import ship
from lakewarden.session import fresh_dir
from tests.llm.helpers import ODD, documents, odd_documents, sentence, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# Mixing ---------------------------------------------------------------------------------------

def test_targets_are_shared_again_above_the_limit():
    assert mixing.targets([10, 100, 100], [5, 2, 1], 210, 3) == pytest.approx([30, 120, 60])
    assert mixing.targets([0, 5], [5, 2], 5, 3) == pytest.approx([0, 5])
    assert mixing.targets([], [], 0, 3) == []


def test_mix_takes_its_targets(spark):
    rng = random.Random(4)
    docs = documents(spark, [text(i, rng.randint(1, 30)) for i in range(300)])
    rows = mixing.mixed(docs).collect()
    assert len(rows) == 300
    taken, aim, sizes = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        aim[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in aim:
        assert abs(taken[s] - aim[s]) <= 1
    assert sum(aim.values()) == pytest.approx(sum(sizes.values()))
    again = {r["doc_id"]: r["taken"] for r in mixing.mixed(docs).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    copies = collections.Counter(r["doc_id"] for r in mixing.mixture(docs).collect())
    assert all(copies[r["doc_id"]] == -(-r["taken"] // r["size"]) for r in rows)


def test_schedule_is_close_to_its_shares_at_every_prefix(spark):
    ship(spark)
    plan = mixing.Plan(["a", "b", "c"], [60000, 30000, 10000], [50000.0, 30000.0, 20000.0],
                       [50000, 30000, 20000], 100, 16)
    rows = mixing.schedule(spark, plan).orderBy("position").collect()
    seen = collections.Counter()
    for i, r in enumerate(rows[:plan.slots], 1):
        seen[r["sid"]] += 1
        for s, share in enumerate((0.5, 0.3, 0.2)):
            assert abs(seen[s] - share * i) < 6
    for s in range(3):
        assert sorted(r["rank"] for r in rows if r["sid"] == s) == list(range(-(-plan.takes[s] // 16)))


def test_mix_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.mixture(docs).columns == docs.columns


# Spans ----------------------------------------------------------------------------------------

def test_repeated_passage_goes_from_all_but_the_first(spark):
    passage = text(99, 8)
    texts = [text(i) for i in range(40)]
    for i in (5, 9, 30):
        words = texts[i].split()
        texts[i] = " ".join(words[:31]) + " " + passage + " " + " ".join(words[31:])
    rows = by_id(spans.without_repeated_spans(documents(spark, texts)))
    for i in range(40):
        if i in (9, 30):
            left = rows[i]["text"]
            assert rows[i]["removed_words"] >= 60
            assert len(set(left.split()) & set(passage.split())) < 0.2 * len(set(passage.split()))
            a, b = rows[i]["spans"][0]
            assert left == texts[i][:a] + texts[i][b:]
        else:
            assert rows[i]["text"] == texts[i] and rows[i]["removed_sentences"] == 0


def test_every_lower_case_passage_of_51_words_is_found(spark):
    rng = random.Random(12)

    def plain(n):
        return "".join(rng.choice(["ba", "ko", "ti", "ru"]) + rng.choice("lmnprst") + str(rng.randint(0, 99)) + " "
                       for _ in range(n)).split()

    passages = [plain(51) for _ in range(300)]
    passages += [rng.choices(plain(3), k=51) for _ in range(30)]
    texts = [" ".join(plain(rng.randint(20, 60)) + p + plain(rng.randint(20, 60))) for _ in range(2) for p in passages]
    rows = by_id(spans.without_repeated_spans(documents(spark, texts)))
    n = len(passages)
    assert all(rows[n + i]["removed_words"] >= 20 for i in range(n))
    assert all(rows[i]["removed_words"] == 0 for i in range(300))


def test_spans_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = spans.without_repeated_spans(docs).collect()
    assert len(rows) == docs.count()
    assert [r["text"] for r in rows if r["doc_id"] == 0] == [None]
    # The row with a null id comes first and keeps its text; its copies with id 3 lose theirs.
    assert [r["text"] for r in rows if r["doc_id"] is None and r["text"]] == [ODD[-1]] or \
        all(r["text"] is not None for r in rows if r["doc_id"] is None)
    assert spans.without_repeated_spans(docs.limit(0)).count() == 0


# Quality --------------------------------------------------------------------------------------

def test_quality_network_learns_and_calibrates(spark):
    good = [text(i) for i in range(150)]
    bad = [" ".join(w + "###" for w in text(1000 + i).split()) for i in range(150)]
    docs = documents(spark, good + bad + [None, ""])
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 300, 2)], "doc_id long, quality int")
    rows = by_id(quality.scored(docs, labels))
    right = sum((rows[i]["score"] >= 0.7) == (i < 150) for i in range(1, 300, 2))
    assert right >= 145 and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[300]["score"] == rows[301]["score"]
    none = quality.scored(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.scored(docs.limit(0), labels).count() == 0


def test_context_sums_equal_a_plain_loop():
    from lakewarden.llm.flat import Flat
    import pyarrow as pa

    texts = ["a b c a", "b, c", ""]
    place, sign = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIMENSIONS), np.int64)
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, bucket = quality.tokens(Flat(raw, np.array([0, len(raw)])))
        for i in range(len(bucket)):
            for j in range(max(0, i - quality.WINDOW), min(len(bucket), i + quality.WINDOW + 1)):
                if i != j:
                    np.add.at(want[bucket[i]], place[bucket[j]], sign[bucket[j]])
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    got = np.zeros_like(want)
    for out in quality._contexts(iter([batch])):
        rows = np.stack([c.to_numpy() for c in out.columns[1:]], axis=1)
        got[out.column(0).to_numpy()] = rows
    assert (got == want).all()


# Language -------------------------------------------------------------------------------------

SAMPLES = {
    "en": "the house that we saw with them was not there when he came from this town and she",
    "de": "das haus und die frau nicht mit der zeit auf einen weg durch ist ein kleiner hund",
    "fr": "la maison que nous avons vue avec les enfants dans une petite ville est belle et",
    "es": "la casa que vimos con los niños en una ciudad pequeña era muy bonita y ella"}


def test_languages_and_rejects(spark):
    rng = random.Random(6)
    texts, langs = [], []
    for lang, words in SAMPLES.items():
        for _ in range(60):
            texts.append(" ".join(rng.choices(words.split(), k=30)))
            langs.append(lang)
    docs = documents(spark, texts + ODD)
    labelled = spark.createDataFrame(
        [(i, t, v) for i, (t, v) in enumerate(zip(texts, langs)) if i % 3], "doc_id long, text string, lang string")
    model = langid.train(labelled)
    assert model.families == ["germanic", "romance"]
    rows = by_id(langid.identify(docs, model))
    assert sum(rows[i]["lang_pred"] == v for i, v in enumerate(langs)) >= 235
    base = len(texts)
    for k in range(6):
        assert (rows[base + k]["lang_pred"], rows[base + k]["score"]) == ("und", 0.0)
    assert all(r["lang_pred"] != "und" and 0 <= r["score"] <= 1 for i, r in rows.items() if i >= base + 6)
    empty = langid.train(labelled.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0
    one = langid.train(labelled.filter("lang = 'fr'"))
    assert by_id(langid.identify(docs, one))[0]["lang_pred"] == "fr"


# Re-Pair --------------------------------------------------------------------------------------

def test_grammar_round_trip_and_random_access():
    rng = np.random.RandomState(1)
    for trial in range(30):
        sizes = rng.randint(1, 400, rng.randint(1, 30))
        ids = np.concatenate([rng.randint(0, rng.randint(2, 9), n) for n in sizes])
        ends = np.cumsum(sizes)
        rules, lengths, symbols, symbol_ends = repair.compress(ids, ends, 9, rounds=6, min_count=4)
        assert (repair.expand(symbols, rules, 9) == ids).all()
        starts = np.append(0, symbol_ends[:-1])
        for a, b, c, d in zip(starts, symbol_ends, ends - sizes, ends):
            assert (repair.expand(symbols[a:b], rules, 9) == ids[c:d]).all()
        assert [len(repair.expand(np.array([9 + i]), rules, 9)) for i in range(len(rules))] == lengths.tolist()
    assert len(symbols) < len(ids)
    same = np.zeros(1001, np.int64)
    rules, _, symbols, _ = repair.compress(same, np.array([1001]), 5)
    assert len(symbols) < 100 and (repair.expand(symbols, rules, 5) == same).all()


def most_frequent_first(ids, ends, min_count):
    """Re-Pair one pair at a time; counts of the pairs that it replaced, and the symbols left."""
    docs = [list(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    replaced, name = [], 1000
    while True:
        count = collections.Counter()
        for d in docs:
            i, last = 0, None
            for i, pair in enumerate(zip(d, d[1:])):
                if last != (i - 1, pair):
                    count[pair] += 1
                    last = (i, pair)
                else:
                    last = None
        pair, n = max(count.items(), key=lambda kv: kv[1], default=(None, 0))
        if n < min_count:
            return replaced, sum(map(len, docs))
        replaced.append(n)
        for k, d in enumerate(docs):
            new, i = [], 0
            while i < len(d):
                hit = tuple(d[i:i + 2]) == pair
                new.append(name if hit else d[i])
                i += 1 + hit
            docs[k] = new
        name += 1


def test_grammar_goes_on_until_no_pair_is_left_twice():
    passage = np.random.RandomState(3).permutation(400)
    ids = np.tile(passage, 300)
    rules, lengths, symbols, _ = repair.compress(ids, np.array([len(ids)]), 400)
    assert lengths.max() > 400 and len(symbols) < 20 and (repair.expand(symbols, rules, 400) == ids).all()
    # The symbols are numbered as they are made; none of their pairs is left twice.
    rng = np.random.RandomState(4)
    for trial in range(20):
        ends = np.cumsum(rng.randint(1, 300, 8))
        ids = np.minimum(rng.geometric(0.15, ends[-1]), 40)
        rules, _, symbols, stops = repair.compress(ids, ends, 41)
        left = collections.Counter()
        for a, b in zip(np.append(0, stops[:-1]), stops):
            left.update(p for p in zip(symbols[a:b], symbols[a + 1:b]) if p[0] != p[1])
        assert max(left.values(), default=0) < 2
        # One at a time, ties in another order: the same size but for what ties decide.
        replaced, size = most_frequent_first(ids, ends, 2)
        assert abs(len(symbols) - size) <= 0.03 * size and abs(len(rules) - len(replaced)) <= 0.08 * len(replaced)


def test_rare_pairs_wait_for_frequent_ones():
    """Rounds of frequent pairs leave the places of rare ones alone, so they cost little."""
    rng = np.random.RandomState(6)
    ids = np.minimum(rng.zipf(1.3, 60_000), 5000)
    looked = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def concatenate(self, parts, *args, **kwargs):
            out = np.concatenate(parts, *args, **kwargs)
            looked.append(len(out))
            return out

    own, repair.np = repair.np, Counting()
    try:
        rules, _, symbols, _ = repair.compress(ids, np.array([len(ids)]), 5001)
    finally:
        repair.np = own
    assert (repair.expand(symbols, rules, 5001) == ids).all()
    assert sum(looked) < 5 * len(ids)
    left = collections.Counter(p for p in zip(symbols, symbols[1:]) if p[0] != p[1])
    assert max(left.values()) < 2


def test_rounds_do_not_look_through_all_places():
    """Pairs keep their places, so no round searches the whole text for them."""
    rng = np.random.RandomState(7)
    ids = np.minimum(rng.zipf(1.3, 60_000), 5000)
    looked = []

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def flatnonzero(self, a):
            looked.append(len(a))
            return np.flatnonzero(a)

    own, repair.np = repair.np, Counting()
    try:
        rules, _, symbols, _ = repair.compress(ids, np.array([len(ids)]), 5001)
    finally:
        repair.np = own
    assert (repair.expand(symbols, rules, 5001) == ids).all()
    assert sum(n >= len(ids) - 1 for n in looked) <= 4


def test_pairs_too_wide_for_one_word_are_replaced_alike():
    rng = np.random.RandomState(8)
    ends = np.cumsum(rng.randint(0, 300, 20))
    ids = np.minimum(rng.geometric(0.15, ends[-1]), 40)
    narrow, wide = (repair.compress(ids, ends, size) for size in (41, 1 << 27))
    rules = np.where(wide[0] >= 1 << 27, wide[0] - (1 << 27) + 41, wide[0])
    symbols = np.where(wide[2] >= 1 << 27, wide[2] - (1 << 27) + 41, wide[2])
    assert (rules == narrow[0]).all() and (symbols == narrow[2]).all()
    assert (wide[1] == narrow[1]).all() and (wide[3] == narrow[3]).all()


def test_words_are_encoded_once_whatever_follows_them():
    own = repair.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    given = []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **options):
            given.extend(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    plain = own.tokenizer
    for name in ("tokenizer", "model"):
        if hasattr(own, name):
            setattr(own, name, Counting(getattr(own, name)))
    words = [f"w{chr(97 + i % 26)}{'xyz' * (i // 26 + 1)}" for i in range(200)]
    texts = [" ".join(w + end for w in words) for end in ("", ",", ".", ";", "!", "?", ":", "\n")]
    want = [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in own.encode_all(texts)] == want
    assert sum(given) < 3 * len(texts[0])


def test_encoder_equals_the_library_on_mixed_texts():
    own = repair.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.RandomState(9)
    signs = [*"ab Z  \n\t\r'19.,éßſА’_-", "'s", "'re", " don't", " the"]
    strange = [*"\0\x1c\x0b\u0085\xa0\u2028漢🙂\u0301²½ªҁ҂", " <|endoftext|>", "<|endoftext|>"]
    for some in (signs, signs * 9 + strange, signs + strange):
        texts = ["".join(rng.choice(some, rng.randint(0, 40))) for _ in range(500)] + ["", " ", "  ", " a"]
        want = [e.ids for e in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert [np.frombuffer(raw, "<u4").tolist() for raw in own.encode_all(texts)] == want
    assert own.encode_all([]) == [] and own.encode_all([None, "a"]) == [b"", own.encode("a")]


def test_most_frequent_pair_is_replaced_first():
    # (1, 2) is counted 40 times, (2, 3) 30, (0, 1) 20: only the first may be replaced whole.
    ids = np.array([0, 1, 2] * 20 + [1, 2, 3] * 20 + [9, 2, 3] * 10)
    rules, _, _, _ = repair.compress(ids, np.array([len(ids)]), 10, rounds=1)
    assert (1, 2) in set(map(tuple, rules.tolist()))
    assert not {(2, 3), (0, 1)} & set(map(tuple, rules.tolist()))


def test_shards_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = [*ODD, *[text(i) for i in range(50)]]
    docs = documents(spark, texts)
    folder = fresh_dir(spark, "shards")
    repair.write(docs, path, folder)
    rows = by_id(repair.read(spark, folder))
    start = 0
    for i, t in enumerate(texts):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    shard = next(r for r in spark.read.parquet(folder).collect() if 12 in r["doc_id"]).asDict()
    one = repair.document(shard, shard["doc_id"].index(12))
    assert one.tolist() == plain.encode(ODD[12], add_special_tokens=False).ids + [0]
    folder = fresh_dir(spark, "shards")
    repair.write(docs.limit(0), path, folder)
    assert repair.read(spark, folder).count() == 0
    folder = fresh_dir(spark, "shards")
    repair.write(odd_documents(spark), path, folder)
    assert repair.read(spark, folder).count() == odd_documents(spark).count()


# Near copies ----------------------------------------------------------------------------------

def weighted(t):
    words = WORD.findall((t or "").lower())
    return collections.Counter(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, bool(words))))


def brute_classes(texts, similarity=0.8):
    sets, up = [weighted(t) for t in texts], list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            if both >= similarity * (sum(sets[i].values()) + sum(sets[j].values()) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(texts))]


def variants(seed, n, changes):
    rng, base = random.Random(seed), text(seed, 14).split()
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        out.append(" ".join(words))
    return out


def test_near_copies_equal_brute_force(spark):
    texts = [*ODD, *variants(50, 60, 4), *variants(51, 10, 2), *[text(200 + i) for i in range(40)]]
    passage = text(77, 9)
    texts += [passage + " " + text(300 + i, 7) for i in range(60)]  # many alike at about one half
    rows = by_id(dartminhash.near_duplicates(documents(spark, texts)))
    assert [rows[i]["class_id"] for i in range(len(texts))] == brute_classes(texts)
    kept = dartminhash.one_of_each(documents(spark, texts))
    assert kept.count() == len(set(brute_classes(texts)))
    assert kept.columns == documents(spark, texts).columns


def edited(rng, words, share):
    """The words with single ones exchanged until only ``share`` of the base's shingles are left."""
    out, kept = list(words), set(range(len(words) - 4))
    while len(kept) > share * (len(words) - 4):
        at = rng.randrange(len(words))
        out[at] = f"x{rng.random()}"
        kept -= set(range(at - 4, at + 1))
    return " ".join(out)


def matrix_classes(texts, similarity=0.8):
    """``brute_classes`` of many texts without a repeated shingle, by one product of matrices."""
    place, sets = {}, [[*weighted(t)] for t in texts]
    own = np.zeros((len(texts), len({e for s in sets for e in s})), np.float32)
    for i, s in enumerate(sets):
        own[i, [place.setdefault(e, len(place)) for e in s]] = 1
    both, n = own @ own.T, own.sum(axis=1)
    alike, root = both >= similarity * (n[:, None] + n - both) - 1e-4, np.arange(len(texts))
    while (low := np.where(alike, root, len(texts)).min(axis=1)).tolist() != root.tolist():
        root = low
    return root.tolist()


@pytest.mark.parametrize("block", [dartminhash.BLOCK, 1 << 14])  # one block, and many that meet
def test_links_of_large_divided_buckets_are_all_found(spark, monkeypatch, block):
    monkeypatch.setattr(dartminhash, "BLOCK", block)
    rng = random.Random(9)
    base = text(400, 24).split()
    # 0.68 alike, and just above 0.8 to a few that are almost the base.
    texts = [edited(rng, base, rng.uniform(0.9, 0.92)) for _ in range(800)]
    texts += [edited(rng, base, 0.99) for _ in range(3)]
    half = text(401, 24).split()  # many alike at about 0.6, with pairs above 0.8 among them
    for _ in range(250):
        one = edited(rng, half, 0.87)
        texts += [one, edited(rng, one.split(), 0.92)]
    rows = by_id(dartminhash.near_duplicates(documents(spark, texts)))
    assert [rows[i]["class_id"] for i in range(len(texts))] == matrix_classes(texts)


def test_signatures_estimate_weighted_similarity():
    from lakewarden.llm.flat import Flat

    a, b = variants(5, 1, 0)[0], variants(5, 2, 6)[1]
    raw = [t.lower().encode() for t in (a, b)]
    flat = Flat(np.frombuffer(b"".join(raw), np.uint8), np.array([0, len(raw[0]), len(raw[0]) + len(raw[1])]))
    element, owner, _, _ = dartminhash.elements(flat)
    sig = dartminhash.signatures(element, owner, 2, k=2048)
    x, y = weighted(a), weighted(b)
    true = sum((x & y).values()) / sum((x | y).values())
    assert abs((sig[0] == sig[1]).mean() - true) < 0.05


def test_near_copies_of_odd_rows(spark):
    docs = odd_documents(spark)
    assert dartminhash.near_duplicates(docs).count() == docs.count()
    assert dartminhash.near_duplicates(docs.limit(0)).count() == 0
    assert dartminhash.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_keeps_different_texts_of_null_and_repeated_ids(spark):
    texts = [text(i) for i in range(500, 508)]
    ids = [None, None, None, 7, 7, 7, 1, 9]
    texts[5], texts[7] = texts[4], texts[6] + " "  # a copy under the same id, one under another
    kept = dartminhash.one_of_each(documents(spark, texts, ids)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == \
        sorted((ids[i] or 0, texts[i]) for i in (0, 1, 2, 3, 4, 6))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "cc")).collect()
    want = {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}
    assert {r["node"]: r["root"] for r in got} == want


# Byte pieces ----------------------------------------------------------------------------------

def test_byte_pieces_equal_the_rank_library(spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    signs = list(" \n\t\r 　'stdl12.,!é中文😀́") + ["  ", "'s", "<|endoftext|>", " the"]
    texts = [*ODD, *["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(500)]]
    rows = by_id(bytepiece.encoded(documents(spark, texts), path, public_tokenizers.PATTERN, with_ids=True))
    for i, t in enumerate(texts):
        ids = plain.encode_ordinary(t or "")
        assert rows[i]["ids"] == ids and rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
        assert "".join(parts_of(t or "x")) == (t or "x")
    assert bytepiece.decoded(rows[12]["ids"], path, public_tokenizers.PATTERN) == ODD[12].encode()
    assert bytepiece.encoded(documents(spark, []), path, public_tokenizers.PATTERN).count() == 0


def test_a_small_table_of_pieces_gives_the_same(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = documents(spark, [*ODD, *[text(i) for i in range(50)]])
    plain, small = (by_id(bytepiece.encoded(docs, path, public_tokenizers.PATTERN, with_ids=True, cache=cache))
                    for cache in (bytepiece.CACHE, 1 << 12))
    assert small == plain and len(plain) == len(ODD) + 50


# Compression bands ----------------------------------------------------------------------------

def test_base_counts_and_bands(spark):
    noise = base64.b64encode(np.random.RandomState(1).bytes(6000)).decode()
    half = text(8, 60) + " " + "again and again " * 400
    texts = [*ODD, text(3, 30), "a b c\na b c\n\na b c\n a b c", noise, " ".join(noise[i:i + 9] for i in
             range(0, len(noise), 9)), half]
    rows = by_id(compression.judged(documents(spark, texts)))
    for i, t in enumerate(texts):
        t = t or ""
        words, seen, repeated = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        n = collections.Counter(zip(words, words[1:], words[2:]))
        cover = {j + k for j in range(len(words) - 2) if n[tuple(words[j:j + 3])] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(cover) > 50 * len(words)
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == \
            (len(words), sum(map(len, words)), repeated, len(cover), failed)
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert not (failed and r["kept"])
    base = len(ODD)
    assert rows[base]["kept"] and not rows[base + 2]["kept"] and not rows[base + 3]["kept"]
    assert not rows[base + 4]["kept"]
    assert compression.judged(documents(spark, [])).count() == 0
    assert compression.judged(odd_documents(spark)).count() == odd_documents(spark).count()


def test_the_end_of_a_text_is_judged_as_its_front():
    import zstandard
    from lakewarden.llm.flat import Flat

    compressor = zstandard.ZstdCompressor(level=compression.LEVEL)
    plain, rest = text(21, 60).encode()[:1950], b"again and again " * 69
    for raw in (plain + rest, rest + plain):
        assert 2 * len(raw) < 3 * compression.CHUNK
        flat = Flat(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert compression.bands(flat, compressor)[1][0] == 0.5


# Fingerprints ---------------------------------------------------------------------------------

def test_fingerprints_and_neighbours(spark):
    texts = [text(i, 30) for i in range(80)] + ["", None, "unique"]
    texts[40] = texts[10]
    docs = documents(spark, texts)
    rows = by_id(imatch.fingerprints(docs))
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["n_chars"] == len(t)
        assert (rows[i]["fingerprint"] == rows[i]["edited_fingerprint"]) == (rows[i]["near_edited"] == 1.0)
        assert 0 <= rows[i]["near_next"] <= 1
    assert rows[10]["fingerprint"] == rows[40]["fingerprint"]
    assert rows[80]["fingerprint"] == rows[81]["fingerprint"] and rows[80]["near_next"] == 1.0
    known = imatch.lexicon(docs)
    n = collections.Counter(w for t in texts for w in set((t or "").split()))
    assert len(known) == sum(2 <= v <= max(2, len(texts) // 10) for v in n.values())
    assert imatch.fingerprints(docs.limit(0)).count() == 0
    assert imatch.fingerprints(documents(spark, ["alone here"])).collect()[0]["near_next"] == 1.0
    assert imatch.fingerprints(odd_documents(spark)).count() == odd_documents(spark).count()


# Web archives ---------------------------------------------------------------------------------

def test_archives_round_trip(spark):
    ship(spark)
    page = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n</p>"
    html = [page, None, "", "short", "short", page, "é" * 60, page, "é" * 60, "a" * 99, "a" * 99]
    rows = [(i, f"http://x/{i}\r\nWARC-Type: evil", h, "x") for i, h in enumerate(html)]
    rows += [(None, None, page, "x"), (3, "http://x/3", "other " * 30, "x"), (3, "http://x/3", "other " * 30, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = fresh_dir(spark, "warc")
    warc.write(pages, folder)
    found = warc.read(spark, folder)
    assert found.count() == 3 * len(rows)
    got = warc.resolved_bytes(warc.assemble(found)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is None or (r["page_id"] == 3 and r["payload_bytes"] > 100):
            assert r["record_type"] == "response" and r["refers_to"] is None
            continue
        payload = (html[r["page_id"]] or "").encode()
        first = html.index(html[r["page_id"]])
        again = len(payload) >= 100 and first != r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("revisit", first) if again else ("response", None))
        assert r["payload_digest"] == hashlib.sha256(payload).hexdigest()
        assert r["payload_bytes"] == len(payload)
        assert (r["payload"] is None) if again else (bytes(r["payload"]) == payload)
        assert r["request"]["url"] == r["url"] and r["url"].endswith("%0D%0AWARC-Type: evil")
        assert r["metadata"]["block"] == f"payload-bytes: {len(payload)}\r\n"
    folder = fresh_dir(spark, "warc")
    warc.write(pages.limit(0), folder)
    assert warc.assemble(warc.read(spark, folder)).count() == 0


def test_piece_table_is_bounded_by_bytes():
    rng = random.Random(12)
    table = PieceTable(lambda parts: [(len(p), p, p.encode(), p.encode()) for p in parts], 1 << 20)
    for _ in range(20):  # 200 texts of 100,000 characters without a space
        texts = ["".join(rng.choices("日本語abcdef\n", k=100_000)) for _ in range(10)]
        assert [f[0][0] for f in table.lookup_texts(texts)] == [100_000] * 10
    assert not table.young and not table.old  # none of them is kept
    for i in range(60):
        table.lookup_texts([" ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(300))])
        kept = sum(sys.getsizeof(k) + sum(map(sys.getsizeof, v)) for d in (table.young, table.old) for k, v in d.items())
        assert kept < 1 << 20
    assert table.young and table.old
    table.clear()
    assert not table.young and not table.old and table.bytes == 0
