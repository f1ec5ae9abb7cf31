"""Quality rules with compression bands.

A text compresses to a share of its UTF-8 size that depends on its length: repeated text falls below
the band of its length, encoded or random data stays above. The whole text is compressed with
zstandard and held against WHOLE; then every chunk of about CHUNK bytes (a longer text is cut into as
many equal ones as fit best, so every byte is in one) against CHUNK_BAND, and a text with more than BAD_CHUNKS of its chunks outside
is rejected, so a repetitive half is seen in a text that is ordinary on the whole.

Counts come first: words, code points in words, symbols, repeated lines and words in repeated
three-word windows; a text of fewer than 50 words or with more than half its words in such windows
fails without a look at its compression.

A null or empty text has no words, fails the base and has ratio 1. Rows that repeat are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.flat import Flat, mix, occurrence, slices

LEVEL = 3
CHUNK = 2048
#: Up to so many bytes: the smallest and the largest share of a text that is kept.
WHOLE = ((128, 0.45, 1.80), (256, 0.40, 1.15), (512, 0.35, 1.00), (1024, 0.32, 0.95),
         (2048, 0.30, 0.85), (4096, 0.28, 0.78), (16384, 0.25, 0.72), (float("inf"), 0.22, 0.70))
CHUNK_BAND = (0.22, 0.80)
BAD_CHUNKS = 0.25
MIN_WORDS, MAX_REPEATED, WINDOW = 50, 50, 3

_U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_EDGES = np.array([w[0] for w in WHOLE])
_LOW, _HIGH = np.array([w[1] for w in WHOLE]), np.array([w[2] for w in WHOLE])


def counts(flat: Flat) -> dict[str, np.ndarray]:
    """The base counts of every text."""
    data, n = flat.data, flat.docs
    starts, ends = flat.words()
    begin = flat.bounds(starts)
    words = np.diff(begin)
    head = (data & 0xC0) != 0x80
    inside = ~np.isin(data, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])

    # Lines: pieces between line ends, those with a word in them.
    line_start, line_end = flat.runs(data != 0x0A)
    worded = np.searchsorted(starts, line_start) < np.searchsorted(starts, line_end)
    line_start, line_end = line_start[worded], line_end[worded]
    doc = flat.doc_of(line_start)
    order, nth, _ = occurrence(doc, flat.hashes(line_start, line_end))
    repeated_lines = np.bincount(doc[order][nth > 0], minlength=n)

    # Windows of three words found twice or more; a word counts once however many cover it.
    word = flat.hashes(starts, ends)
    doc = np.repeat(np.arange(n), words)
    place = np.arange(len(word)) - np.repeat(begin[:-1], words)
    at = np.flatnonzero(place + WINDOW <= words[doc])
    window = np.zeros(len(at), _U)
    for j in range(WINDOW):
        window = mix(window + word[at + j])
    order, _, size = occurrence(doc[at], window)
    covered = np.zeros(len(word), bool)
    for j in range(WINDOW):
        covered[at[order][size > 1] + j] = True
    return {
        "n_words": words, "word_chars": flat.per_doc(head & inside),
        "n_symbols": flat.per_doc(_SYMBOL[data]), "n_dup_lines": repeated_lines,
        "n_repeat_words": np.bincount(doc[covered], minlength=n)}


def bands(flat: Flat, compressor) -> tuple[np.ndarray, np.ndarray]:
    """Compressed share of every text, and which share of its chunks is outside the band."""
    ratio, outside = np.ones(flat.docs), np.zeros(flat.docs)
    for i in range(flat.docs):
        raw = flat.text(i)
        if not raw:
            continue
        ratio[i] = len(compressor.compress(raw)) / len(raw)
        if len(raw) > CHUNK:
            n = max(2, round(len(raw) / CHUNK))
            pieces = [raw[len(raw) * j // n:len(raw) * (j + 1) // n] for j in range(n)]
            shares = [len(compressor.compress(p)) / len(p) for p in pieces]
            bad = sum(not CHUNK_BAND[0] <= s <= CHUNK_BAND[1] for s in shares)
            outside[i] = bad / len(shares)
    return ratio, outside


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for low, flat in slices(batch.column(1)):
            found = counts(flat)
            ratio, outside = bands(flat, compressor)
            failed = (found["n_words"] < MIN_WORDS) | \
                (100 * found["n_repeat_words"] > MAX_REPEATED * found["n_words"])
            band = np.searchsorted(_EDGES, np.diff(flat.offsets))
            kept = ~failed & (ratio >= _LOW[band]) & (ratio <= _HIGH[band]) & (outside <= BAD_CHUNKS)
            columns = [pa.array(found[c].astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, flat.docs), *columns, pa.array(failed), pa.array(kept),
                 pa.array(ratio), pa.array(outside)],
                ["doc_id", *COUNTS, "base_failed", "kept", "ratio", "outside"])


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept, and what the verdict
    rests on: ratio (compressed share of the text) and outside (share of chunks out of the band)."""
    kind = ", ".join(["doc_id long", *[f"{c} long" for c in COUNTS],
                      "base_failed boolean, kept boolean, ratio double, outside double"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(_judge, kind)
