"""Substring dedup by sliding runs of sentences.

A sentence ends after a word that ends with ``.``, ``!`` or ``?``, at a line end, before a word that
starts with a capital. Of any WINDOW words of a text in a row at least one ends a sentence: if none
does by these rules, the one with the smallest hash (the last of equal ones), so no sentence is
longer than WINDOW words and places depend on less than WINDOW words around them. A passage set into
the middle of another sentence falls into the same sentences as elsewhere, but for its edges.

From every sentence the shortest run with at least SENTENCES sentences and WORDS words is hashed, and
the one of two sentences if they have WORDS words. So a passage of 51 words holds a complete run
wherever it stands: a run starts within its first 11 words and is over 29 words later. The
first place of a run is the one with the smallest doc_id, then the earliest in the text; every
sentence covered by the run at any other place is removed. Runs are counted over all texts: a
grouped minimum with map-side aggregation, then a join by hash, which adaptive execution splits
where one passage occurs in very many texts. No list of places is ever collected per run.

Scripts that are written without spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) are cut into
words before about every second character, by the hash of the character, and after a full-width stop.

Nulls and texts without a run of that size stay as they are (null stays null). A null doc_id comes
before all others; of rows that share a doc_id, or have none, the one with the smallest hash of its
text comes first. Rows alike in doc_id and text count as one document: a run found only in them is
in its first place in each. Removing all sentences leaves an empty text. White space after a
removed sentence goes with it. No column of the caller is lost: one that is named like a column of
the report gets underscores in front (``kept_names``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakewarden.llm.flat import SPACE, Flat, mix, occurrence, powers, slices
from lakewarden.llm.lean import lean
from lakewarden.llm.scratch import Scratch

SENTENCES, WORDS, WINDOW = 3, 20, 10
NO_ID = -(1 << 63)

_U = np.uint64
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
#: Code points of scripts without spaces, first and last, and their stops.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF),
            (0xFF00, 0xFFEF), (0x20000, 0x3FFFF))
WIDE_STOPS = (0x3002, 0xFF01, 0xFF0E, 0xFF1F)


def _units(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where words begin after a wide stop."""
    starts, ends = flat.words()
    data = flat.data
    at = np.flatnonzero(data >= 0xE0)
    if not len(at):
        return starts, ends, np.zeros(0, np.int64)
    long = (data[at] >= 0xF0).astype(np.int64)
    byte = data[np.minimum(at[:, None] + np.arange(4), len(data) - 1)].astype(np.int64) & 0x3F
    point = ((byte[:, 0] & 0x0F) << 12) | (byte[:, 1] << 6) | byte[:, 2]
    point = np.where(long, (((byte[:, 0] & 0x07) << 18) | (byte[:, 1] << 12) | (byte[:, 2] << 6) | byte[:, 3]), point)
    wide = np.zeros(len(at), bool)
    for low, high in UNSPACED:
        wide |= (point >= low) & (point <= high)
    cut = at[wide & (mix(point.astype(_U) + _U(1)) & _U(1) == 0)]
    stop = at[np.isin(point, WIDE_STOPS)] + 3
    stop = stop[stop < len(data)]
    stop = stop[~SPACE[data[stop]]]
    cut = np.setdiff1d(np.concatenate((cut, stop)), np.concatenate((starts, ends)))
    return np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut))), stop


def _window_ends(word: np.ndarray, opens: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The word that ends a sentence for every WINDOW words in a row of one text: the last one before
    a word that ``opens`` one, else the one with the smallest hash."""
    count = len(word) - WINDOW + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    key = mix(word + _U(5)) | _U(1)
    key[:-1][opens[1:]] = 0
    least, at = key[:count].copy(), np.arange(count)
    for j in range(1, WINDOW):
        other = key[j:count + j]
        smaller = other <= least
        least[smaller] = other[smaller]
        at[smaller] = np.flatnonzero(smaller) + j
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    return at[doc[:count] == doc[WINDOW - 1:]]


class Runs:
    """Sentences and runs of the texts of a slice, as arrays over all of them.

    ``first_word`` and ``doc`` per sentence; ``low`` and ``high`` (sentence numbers, end exclusive)
    and ``hash`` per run; ``begin`` says where the sentences of each text begin.
    """

    def __init__(self, flat: Flat):
        starts, ends, stops = _units(flat)
        word = flat.hashes(starts, ends)
        data, n = flat.data, len(starts)
        opens = np.zeros(n, bool)
        of_doc = flat.bounds(starts)
        if n:
            opens[of_doc[:-1][np.diff(of_doc) > 0]] = True
            lines = np.concatenate(([0], np.cumsum(data == 0x0A)))
            head = data[starts]
            second = data[np.minimum(starts + 1, len(data) - 1)]
            capital = (head >= 0x41) & (head <= 0x5A)
            capital |= (head == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
            opens |= capital
            opens[1:] |= _STOP[data[ends[:-1] - 1]] | (lines[starts[1:]] > lines[ends[:-1]])
            opens |= np.isin(starts, stops)
            at = _window_ends(word, opens, of_doc) + 1
            opens[at[at < n]] = True
        self.first_word = np.flatnonzero(opens)
        self.starts, self.flat = starts, flat
        self.doc = flat.doc_of(starts[self.first_word])
        self.begin = np.searchsorted(self.first_word, of_doc)
        edges = np.append(self.first_word, n)
        low = np.arange(len(self.first_word))
        enough = np.searchsorted(edges, self.first_word + WORDS)
        high = np.maximum(low + SENTENCES, enough)
        two = np.flatnonzero(enough == low + 2)
        low, high = np.insert(low, two, two), np.insert(high, two, two + 2)
        fits = high <= self.begin[self.doc[low] + 1]
        self.low, self.high = low[fits], high[fits]
        total = np.concatenate(([_U(0)], np.cumsum(mix(word) * powers(n), dtype=_U)))
        a, b = edges[self.low], edges[self.high]
        self.hash = mix((total[b] - total[a]) * powers(n + 1, "down")[a] + (b - a).astype(_U))
        self.edges = edges

    def first_in_text(self) -> np.ndarray:
        """Marks runs with no equal run earlier in the same text."""
        order, nth, _ = occurrence(self.doc[self.low], self.hash)
        first = np.zeros(len(self.low), bool)
        first[order] = nth == 0
        return first


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, flat in slices(batch.column("text")):
            runs = Runs(flat)
            at = np.flatnonzero(runs.first_in_text())
            row = pa.array(runs.doc[runs.low[at]] + low)
            place = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.hash[at].view(np.int64)), *(batch.column(c).take(row) for c in place)],
                ["run", *place])


REPORT = ("sentences int, removed_sentences int, removed_words int, "
          "spans array<struct<start:int,end:int>>")


def _cleaner(text_at: int, hits_at: int, names: list[str]):
    """Replaces the text of every row and adds the report columns; other columns pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, flat in slices(batch.column(text_at)):
                part = batch.slice(low, flat.docs)
                yield _clean(part, flat, part.column(hits_at))

    def _clean(part: pa.RecordBatch, flat: Flat, hits: pa.Array) -> pa.RecordBatch:
        runs = Runs(flat)
        repeated = ~runs.first_in_text()
        of_doc = np.searchsorted(runs.low, runs.begin)
        for doc in np.flatnonzero(hits.is_valid().to_numpy(False)):
            found = np.array(hits[int(doc)].as_py(), np.int64).view(_U)
            own = slice(of_doc[doc], of_doc[doc + 1])
            repeated[own] |= np.isin(runs.hash[own], found)
        change = np.zeros(len(runs.first_word) + 1, np.int64)
        np.add.at(change, runs.low[repeated], 1)
        np.add.at(change, runs.high[repeated], -1)
        gone = np.cumsum(change)[:-1] > 0
        size = np.diff(runs.edges)
        removed = np.bincount(runs.doc[gone], minlength=flat.docs)
        words = np.bincount(runs.doc[gone], weights=size[gone], minlength=flat.docs)
        texts, spans = part.column(text_at).to_pylist(), [[] for _ in range(flat.docs)]
        for doc in np.flatnonzero(removed):
            a, b = runs.begin[doc], runs.begin[doc + 1]
            raw, base, end = flat.text(doc), flat.offsets[doc], flat.offsets[doc + 1]
            marks = np.flatnonzero(np.diff(np.concatenate(([False], gone[a:b], [False])).astype(np.int8)))
            byte = np.append(runs.starts[runs.first_word[a:b]], end) - base
            kept, last = [], 0
            points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
            for x, y in zip(marks[::2], marks[1::2]):
                kept.append(raw[last:byte[x]])
                last = byte[y]
                spans[doc].append({"start": int(points[byte[x]]), "end": int(points[byte[y]])})
            texts[doc] = b"".join([*kept, raw[last:]]).decode()
        columns = [pa.array(texts, pa.string()) if i == text_at else part.column(i)
                   for i in range(part.num_columns) if i != hits_at]
        report = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        columns += [pa.array(np.diff(runs.begin).astype(np.int32)), pa.array(removed.astype(np.int32)),
                    pa.array(words.astype(np.int32)), pa.array(spans, pa.list_(report))]
        return pa.RecordBatch.from_arrays(columns, names)
    return run


def free_names(names: Iterable[str], taken: Iterable[str]) -> list[str]:
    """``names``, each with as many underscores in front as it takes to differ from those taken."""
    have, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def kept_names(columns: Iterable[str]) -> list[str]:
    """Names in the result of the ``columns`` of the caller."""
    columns, report = list(columns), T._parse_datatype_string(REPORT).fieldNames()
    return [free_names([c], [*report, *columns])[0] if c.lower() in report else c for c in columns]


def _shared_hits(texts: DataFrame, shared: DataFrame, first: DataFrame, scratch: Scratch) -> DataFrame:
    """doc, mark and the runs to remove of texts whose id other texts have, too."""
    places = scratch.save(texts.join(shared, "doc").select("doc", "mark", "text").mapInArrow(
        lean(_places), "run long, doc long, mark long"), "shared-places")
    least = places.groupBy("run", "doc").agg(F.min("mark").alias("least"), F.max("mark").alias("most")) \
        .filter("least < most").select("run", "doc", "least")
    beside = places.join(least, ["run", "doc"]).filter("mark > least").select("doc", "mark", "run")
    behind = places.join(first, "run").filter("doc > low").select("doc", "mark", "run")
    return beside.unionByName(behind).groupBy("doc", "mark").agg(F.collect_set("run").alias("runs"))


def without_repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated sentences taken out of ``text``, all other columns as they came
    under their ``kept_names``, and the columns of REPORT behind them; spans are places in the old text, in code points."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "spans")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    text = F.col("text").cast("string")
    mark = F.xxhash64(text)
    texts = docs.select(key.alias("doc"), mark.alias("mark"), text.alias("text"))
    places = scratch.save(
        texts.select("doc", "text").mapInArrow(lean(_places), "run long, doc long"), "places")
    # Ids of several texts: their places are told by the hash of the text, all others by id alone.
    shared = scratch.save(
        texts.groupBy("doc").agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
        .filter("least < most").select("doc"), "shared")
    several = not shared.isEmpty()
    first = places.groupBy("run").agg(F.min("doc").alias("low"), F.max("doc").alias("high")) \
        .filter("low < high").select("run", "low")
    single = places.join(shared, "doc", "left_anti") if several else places
    # A set, so rows alike in id and text send each run once.
    hits = single.join(first, "run").filter("doc > low") \
        .groupBy("doc").agg(F.collect_set("run").alias("runs"))
    names = free_names(["_whole", "_found", "_doc", "_doc2", "_mark", "_own"], docs.columns)
    whole, found, doc, doc2, own_mark, own = names
    joined = docs.withColumn(whole, text).join(
        hits.select(F.col("doc").alias(doc), F.col("runs").alias(found)), key == F.col(doc), "left")
    runs = F.col(found)
    if several:
        rest = scratch.save(_shared_hits(texts, shared, first, scratch), "shared-hits")
        joined = joined.join(
            rest.select(F.col("doc").alias(doc2), F.col("mark").alias(own_mark), F.col("runs").alias(own)),
            (key == F.col(doc2)) & (F.xxhash64(whole) == F.col(own_mark)), "left")
        runs = F.coalesce(own, found)
    report = T._parse_datatype_string(REPORT)
    keep, names = docs.columns, kept_names(docs.columns)
    kind = T.StructType(
        [T.StructField(n, T.StringType() if c == "text" else docs.schema[c].dataType)
         for c, n in zip(keep, names)] + report.fields)
    flow = joined.select(*[F.col(whole).alias("text") if c == "text" else F.col(f"`{c}`") for c in keep],
                         runs.alias(found))
    return flow.mapInArrow(lean(_cleaner(keep.index("text"), len(keep), kind.fieldNames())), kind)
