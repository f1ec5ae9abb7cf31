"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the words whose document frequency is in a band of the inverse document frequency:
in at least one of RARE and at most one of COMMON documents, and in two at least. Words are counted
over all documents. The lexicon is bounded whatever the vocabulary: a document has some hundred
distinct words, so at most RARE times that many words reach the lower edge. It is checked against
MAX_TERMS and sent to all tasks as sorted hashes.

A fingerprint has a coordinate for each random subset of the lexicon: SETS families, each halved
LEVELS times, so that both short and long texts have subsets that hold only a few of their words.
A coordinate is a hash of the sorted distinct words of the text in the subset, or empty. Likeness
is the share of equal coordinates among those that are not empty on both sides, 1 for equal
fingerprints. A text without a word of the lexicon is fingerprinted by all its words, apart from
those with one.

The next document is the next larger doc_id (the smallest after the largest). Documents are dealt out
by ranges of doc_id; the first one of each range goes also to the range before it, so no task needs
more than its range. Nulls count as empty texts; a text without words has an empty fingerprint. Null
doc_ids come first. Rows that repeat a doc_id are ordered by a hash of their text; one that is
followed by its own repetition has that as its next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.flat import Flat, mix, occurrence, slices
from lakewarden.llm.ordered import in_parts, order_key, part_bounds, part_of

RARE, COMMON = 2000, 10
MAX_TERMS = 8_000_000
SETS, LEVELS = 12, 8

_U = np.uint64
_SALT = mix(np.arange(1, 65, dtype=_U) * _U(0x9E3779B97F4A7C15))


def terms(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of every text, as (text, hash), sorted."""
    starts, ends = flat.words()
    word = flat.hashes(starts, ends)
    doc = flat.doc_of(starts)
    order, nth, _ = occurrence(doc, word)
    first = order[nth == 0]
    return doc[first], word[first]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        term, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

    for batch in batches:
        for _, flat in slices(batch.column(0)):
            held.append(terms(flat)[1])
            size += len(held[-1])
            if size > 2_000_000:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def lexicon(docs: DataFrame, rare: int = RARE, common: int = COMMON) -> np.ndarray:
    """Sorted hashes of the words in the band. Of a corpus of fewer than 2 * common documents, words
    in up to half of them are kept, as the band would be empty."""
    total = docs.count()
    low, high = max(2, -(-total // rare)), max(2, total // common, min(total // 2, 2))
    found = docs.select(F.col("text").cast("string")).mapInArrow(_frequencies, "term long, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n").between(low, high)) \
        .select("term").limit(MAX_TERMS + 1).toArrow().column(0).to_numpy()
    if len(found) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} words in the band: choose a smaller value of rare")
    return np.sort(found.view(_U))


def coordinates(flat: Flat, known: np.ndarray) -> np.ndarray:
    """SETS * LEVELS 16-bit hashes per text; 0 is empty."""
    doc, term = terms(flat)
    at = np.searchsorted(known, term)
    inside = np.zeros(len(term), bool)
    if len(known):
        inside = known[np.minimum(at, len(known) - 1)] == term
    has = np.bincount(doc[inside], minlength=flat.docs) > 0
    use = inside | ~has[doc]
    doc, term = doc[use], term[use] ^ np.where(has[doc[use]], _U(0), _SALT[60])
    out = np.zeros((flat.docs, SETS * LEVELS), np.uint16)
    for family in range(SETS):
        draw, of = mix(term + _SALT[family]), doc
        for level in range(LEVELS):  # every level keeps half of the one before
            chosen = draw >> _U(level) & _U(1) == 0
            draw, of = draw[chosen], of[chosen]
            if not len(of):
                break
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            total = mix(np.add.reduceat(mix(draw), first) + _SALT[32 + level])
            out[of[first], family * LEVELS + level] = (total % _U(65535)).astype(np.uint16) + 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    filled = (a != 0) | (b != 0)
    same = (a == b) & filled
    out = same.sum(axis=1) / np.maximum(filled.sum(axis=1), 1)
    return np.where((a == b).all(axis=1), 1.0, out)


def fingerprint(values: np.ndarray) -> list[str]:
    raw = values.astype(">u2").tobytes().hex()
    wide = values.shape[1] * 4
    return [raw[i:i + wide] for i in range(0, len(raw), wide)]


def _of(texts: list[str], known: np.ndarray) -> np.ndarray:
    found = [coordinates(flat, known) for _, flat in slices(pa.array(texts, pa.string()))]
    return np.concatenate(found) if found else np.zeros((0, SETS * LEVELS), np.uint16)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(known):
    """Rows come sorted by part, guests of a part behind its own rows; a row's successor is next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows += zip(*[part.column(i).to_pylist() for i in range(3)])
                if len(rows) > 1:
                    yield out(rows)
                    rows = rows[-1:]
        # The last row is the guest of the last part, which has no row of its own here.

    def out(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[2] for r in rows]
        own = _of(texts, known.value)
        at = [i for i in range(len(rows) - 1) if not rows[i][1]]
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        new = _of(changed, known.value)
        at = np.array(at, np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][0] for i in at], pa.int64()),
            pa.array([len(texts[i]) for i in at], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(fingerprint(own[at]), pa.string()), pa.array(fingerprint(new), pa.string()),
            pa.array(likeness(own[at], new)), pa.array(likeness(own[at], own[at + 1]))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"])
    return run


def with_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, guest, text: all documents in order, each part ending with the document after it."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        order_key().alias("_key"))
    keys = docs.select(order_key().alias("_key"))
    bounds = part_bounds(keys)
    # The first key of every part: as many rows as there are parts.
    firsts = keys.groupBy(part_of(F.col("_key"), bounds).alias("_part")).agg(F.min("_key").alias("k")) \
        .orderBy("_part").collect()
    parts = [r["_part"] for r in firsts]
    before = [(r["k"], parts[i - 1]) for i, r in enumerate(firsts)]  # the first goes to the last
    lookup = F.broadcast(docs.sparkSession.createDataFrame(before, "_first long, _guest_of int"))
    own = keyed.withColumn("_part", part_of(F.col("_key"), bounds))
    both = own.join(lookup, F.col("_key") == F.col("_first"), "left").select(
        "doc_id", "text", "_key", F.explode(F.filter(F.array(
            F.struct(F.col("_part").alias("p"), F.lit(False).alias("g")),
            F.when(F.col("_guest_of").isNotNull(),
                   F.struct(F.col("_guest_of").alias("p"), F.lit(True).alias("g")))),
            lambda x: x.isNotNull())).alias("_to")) \
        .select("doc_id", F.col("_to.g").alias("guest"), "text", "_key", F.col("_to.p").alias("_part"),
                F.xxhash64("text").alias("_tie"))
    return in_parts(both, bounds, "guest", "_key", "_tie").select("doc_id", "guest", "text")


def fingerprints(docs: DataFrame, known: np.ndarray | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited and to the next text)."""
    kind = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")
    spark = docs.sparkSession
    if docs.isEmpty():
        return spark.createDataFrame([], kind)
    sent = spark.sparkContext.broadcast(lexicon(docs) if known is None else known)
    return with_neighbours(docs).mapInArrow(_compare(sent), kind)
