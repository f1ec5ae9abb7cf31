"""Hierarchical language identification: family first, then the languages of the family.

A text is a vector of hashed byte n-grams (one to three bytes of the lower-case text, everything but
letters read as one space), square roots of the counts scaled to length one. A linear support vector
machine per family (against the rest) finds the family; between the languages of a family every
pair has a machine of its own, the language with most votes wins, margins break ties. Margins become
probabilities by a logistic fit per machine; the score is the product of the two stages.

Machines are trained on the driver with dual coordinate descent, on at most SAMPLE labelled texts
in all (about the same number per language, chosen by a hash of doc_id) of the rows that are given
for learning. Prediction runs over all texts in the tasks; text, and nothing else, enters it.

A null text or one without a letter is ``und`` with score 0, as is every text when nothing could be
learned. With a single learned language every other text has that language, with score 1. Rows that
repeat a doc_id are predicted each by its text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.llm.flat import Flat, slices
from lakewarden.llm.lean import give_back, lean

SAMPLE = 4000
DIMENSIONS = 4096
SLICE_BYTES, SLICE_ROWS = 1 << 18, 128  # texts that are made vectors of together
NONE = "und"
#: Languages by family. Any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

_KEEP = np.full(256, 0x20, np.uint8)
_KEEP[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEEP[0x80:] = np.arange(0x80, 0x100)


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def vectors(flat: Flat) -> np.ndarray:
    """One row of DIMENSIONS numbers per text (lower case)."""
    byte = _KEEP[flat.data].astype(np.uint32)
    doc = np.repeat(np.arange(flat.docs), np.diff(flat.offsets))
    space = byte == 0x20
    inside = np.ones(len(byte), bool)
    inside[1:] = ~(space[1:] & space[:-1] & (doc[1:] == doc[:-1]))
    byte, doc = byte[inside], doc[inside]
    total = np.zeros(flat.docs * DIMENSIONS, np.int64)
    code = np.zeros(len(byte), np.uint32)
    for n in (1, 2, 3):
        code = code[:len(byte) - n + 1] * np.uint32(257) + byte[n - 1:] if n > 1 else byte
        same = doc[:len(code)] == doc[n - 1:]
        slot = ((code + np.uint32(n * 7919)) * np.uint32(2654435769)) >> np.uint32(20)
        total += np.bincount(doc[:len(code)][same] * DIMENSIONS + slot[same], minlength=len(total))
    out = np.sqrt(total.reshape(flat.docs, DIMENSIONS)).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def machine(x: np.ndarray, length: np.ndarray, rows: np.ndarray, positive: np.ndarray, cost: float = 4.0,
            rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the bias) of a linear support vector machine between the given rows of
    ``x``, then the two numbers of the logistic curve that turns its margin into a probability.
    ``length`` is the square of each row's length with the bias. No machine copies ``x``."""
    y = np.where(positive, 1.0, -1.0)
    c = np.where(positive, len(y) / (2 * max(positive.sum(), 1)),
                 len(y) / (2 * max((~positive).sum(), 1))) * cost
    alpha, w, bias = np.zeros(len(y)), np.zeros(x.shape[1], np.float32), 0.0
    rng = np.random.RandomState(7)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            row = x[rows[i]]
            new = min(max(alpha[i] - (y[i] * (float(row @ w) + bias) - 1) / length[rows[i]], 0.0), c[i])
            step = new - alpha[i]
            if step:
                w += np.float32(step * y[i]) * row
                bias += step * y[i]
                alpha[i], moved = new, max(moved, abs(step))
        if moved < 1e-3:
            break
    return np.concatenate((w, [bias], _curve((x @ w)[rows] + bias, positive)))


def _curve(margin: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Slope and offset of a logistic curve, by Newton steps on softened targets."""
    up, down = positive.sum(), (~positive).sum()
    goal = np.where(positive, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - goal) * margin).sum() + 1e-3 * a, (p - goal).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()],
                      [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return np.array([max(a, 1e-3), b])


class Model:
    """Families, their languages, and the machines between them."""

    def __init__(self, langs: np.ndarray, x: np.ndarray):
        self.langs = sorted(set(langs))
        family = np.array([family_of(v) for v in langs])
        self.families = sorted(set(family))
        self.members = [[v for v in self.langs if family_of(v) == f] for f in self.families]
        length = np.einsum("ij,ij->i", x, x) + 1.0
        every = np.arange(len(x))
        self.top = [machine(x, length, every, family == f) for f in self.families] \
            if len(self.families) > 1 else []
        self.pairs = {}
        for members in self.members:
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    rows = np.flatnonzero((langs == a) | (langs == b))
                    self.pairs[a, b] = machine(x, length, rows, langs[rows] == a)

    @staticmethod
    def _margin(x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margin = x @ m[:-3].astype(np.float32) + m[-3]
        return margin, 1 / (1 + np.exp(-np.clip(m[-2] * margin + m[-1], -30, 30)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        lang, score = np.full(n, NONE, object), np.zeros(n)
        if not self.langs or not n:
            return lang, score
        if self.top:
            margins, chances = zip(*[self._margin(x, m) for m in self.top])
            best = np.argmax(np.stack(margins), axis=0)
            sure = np.stack(chances)[best, np.arange(n)]
        else:
            best, sure = np.zeros(n, int), np.ones(n)
        for f, members in enumerate(self.members):
            rows = np.flatnonzero(best == f)
            if not len(rows):
                continue
            votes = np.zeros((len(members), len(rows)))
            chance = np.ones((len(members), len(rows)))
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    margin, p = self._margin(x[rows], self.pairs[a, members[j]])
                    win = margin > 0
                    votes[i] += win + np.clip(margin, -1, 1) * 1e-3
                    votes[j] += ~win - np.clip(margin, -1, 1) * 1e-3
                    chance[i], chance[j] = np.minimum(chance[i], p), np.minimum(chance[j], 1 - p)
            pick = np.argmax(votes, axis=0)
            lang[rows] = np.array(members, object)[pick]
            score[rows] = sure[rows] * chance[pick, np.arange(len(rows))]
        return lang, np.clip(score, 0.0, 1.0)


def _vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, flat in slices(batch.column(2), SLICE_BYTES, SLICE_ROWS):
            x = vectors(flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, flat.docs), batch.column(1).slice(low, flat.docs),
                 pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], ["mark", "lang", "x"])


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows (doc_id, text, lang) with a language; at most about ``sample`` of them. Different
    pairs of id and text are drawn, so an id on many rows sends no more to the driver than any other;
    of equal rows one counts. Languages beyond the ``sample // 2`` most frequent are not learned."""
    labelled = labelled.select("doc_id", F.lower("text").alias("text"), "lang") \
        .filter("lang is not null and text is not null").withColumn("mark", F.xxhash64("doc_id", "text"))
    different = F.approx_count_distinct("mark", 0.02)
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(different.alias("n"))
              .orderBy(F.desc("n"), "lang").limit(sample // 2).collect()}
    if not counts:
        return Model(np.array([], object), np.zeros((0, DIMENSIONS), np.float32))
    each = sample / len(counts)
    draw = F.pmod(F.xxhash64(F.lit(4), "mark"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))])
    found = labelled.filter(draw < share[F.col("lang")]).select("mark", "lang", "text") \
        .mapInArrow(lean(_vectorise), "mark long, lang string, x binary").distinct().toArrow()
    if not found.num_rows:
        return Model(np.array([], object), np.zeros((0, DIMENSIONS), np.float32))
    names, marks = found.column("lang").to_pylist(), found.column("mark").to_pylist()
    order = sorted(range(len(names)), key=lambda i: (marks[i], names[i]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    x = np.empty((len(order), DIMENSIONS), np.float32)
    for to, value in zip(place, itertools.chain.from_iterable(found.column("x").chunks)):
        x[to] = np.frombuffer(value.as_buffer(), np.float16)  # where it lies, not a copy of it
    del found, value
    give_back()  # the driver lives on, too
    model = Model(np.array([names[i] for i in order], object), x)
    del x
    give_back()
    return model


def identify(docs: DataFrame, model: Model, name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score behind the other columns."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # a few machines of DIMENSIONS numbers each

    @F.pandas_udf(f"{name} string, {score} double")
    def predicted(texts):
        import pandas as pd

        out = []
        for _, flat in slices(pa.array(texts, pa.string()), SLICE_BYTES, SLICE_ROWS):
            out.append(sent.value.predict(vectors(flat)))
        give_back()
        langs = np.concatenate([o[0] for o in out]) if out else np.array([], object)
        scores = np.concatenate([o[1] for o in out]) if out else np.zeros(0)
        return pd.DataFrame({name: langs, score: scores})

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = docs.select("*", predicted(F.lower("text")).alias("_found"), letters.alias("_letters"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (name, score)]
    return found.select(
        *keep,
        F.when(F.col("_letters"), F.col(f"_found.{name}")).otherwise(F.lit(NONE)).alias(name),
        F.when(F.col("_letters"), F.col(f"_found.{score}")).otherwise(F.lit(0.0)).alias(score))


def held_out(doc_id: str | Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is never held out."""
    value = F.crc32(F.col(doc_id).cast("string").cast("binary")) if isinstance(doc_id, str) \
        else F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(value, F.lit(modulus)) == rest, F.lit(False))
