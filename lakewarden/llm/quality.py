"""Quality classifier: random-indexing word vectors, pooled per text, into a two-layer network.

Tokens are runs of letters, of digits or of signs as they stand, hashed into BUCKETS. Every token has a
sparse random index vector (NONZERO entries of +1 or -1 in DIMENSIONS); the vector of a bucket is the
sum of the index vectors of its neighbours, WINDOW to either side, over the whole corpus. Tasks add up
what they read, sums per bucket meet in a grouped aggregate, and the result has a fixed size
(BUCKETS x DIMENSIONS), whatever the corpus, so it can be collected and sent to all tasks.

A text is pooled to the mean and the spread of its token vectors, its length, the share of different
tokens and the share of tokens that repeat the one before. The network (one hidden layer) is trained
with numpy on the driver, on at most about SAMPLE labelled texts; a fifth of them is set apart to find
the temperature that its probabilities are calibrated with. Only the text enters a score.

Nulls count as empty texts, which get the score of an all-zero pool. Several labels of a document are
averaged (from one half on good). Without labels every score is 0.5; with labels of one kind only it
is the smoothed share of that kind. Rows that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.flat import Flat, mix, slices

BUCKETS, DIMENSIONS, NONZERO, WINDOW = 1 << 14, 32, 2, 2
SAMPLE = 20_000
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 3e-3, 1e-4
SLICE = 1 << 18

_U = np.uint64
_KIND = np.full(256, 3, np.uint8)                 # signs
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0   # white space
_KIND[0x30:0x3A] = 2                              # digits
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1


def tokens(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every token, in order."""
    kind = _KIND[flat.data]
    begin, end = kind != 0, kind != 0
    change = kind[1:] != kind[:-1]
    begin[1:] &= change
    end[:-1] &= change
    filled = flat.offsets[1:] > flat.offsets[:-1]
    first, last = flat.offsets[:-1][filled], flat.offsets[1:][filled] - 1
    begin[first], end[last] = kind[first] != 0, kind[last] != 0
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    bucket = (flat.hashes(starts, ends) >> _U(20)).astype(np.int64) % BUCKETS
    return flat.doc_of(starts), bucket


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of the nonzero entries of every bucket's index vector."""
    draw = mix(np.arange(BUCKETS * NONZERO, dtype=_U) + _U(77)).reshape(BUCKETS, NONZERO)
    return (draw % _U(DIMENSIONS)).astype(np.int64), np.where(draw >> _U(40) & _U(1), 1, -1)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    total = np.zeros(BUCKETS * DIMENSIONS, np.int64)
    for batch in batches:
        for _, flat in slices(batch.column(0)):
            doc, bucket = tokens(flat)
            spots, signs = [], []
            for step in range(1, WINDOW + 1):
                near = doc[step:] == doc[:-step]
                a, b = bucket[:-step][near], bucket[step:][near]
                for k in range(NONZERO):
                    spots += [a * DIMENSIONS + place[b, k], b * DIMENSIONS + place[a, k]]
                    signs += [sign[b, k], sign[a, k]]
            if spots:
                total += np.bincount(np.concatenate(spots), np.concatenate(signs),
                                     len(total)).astype(np.int64)
    rows = total.reshape(BUCKETS, DIMENSIONS)
    used = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), *[pa.array(rows[used, d]) for d in range(DIMENSIONS)]],
        ["bucket", *[f"v{d}" for d in range(DIMENSIONS)]])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all buckets: roots of the context sums, scaled to length one."""
    columns = [f"v{d}" for d in range(DIMENSIONS)]
    kind = "bucket int, " + ", ".join(f"{c} long" for c in columns)
    found = docs.select(F.col("text").cast("string")).mapInArrow(_contexts, kind) \
        .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    if found.num_rows:
        raw = np.stack([found.column(c).to_numpy() for c in columns], axis=1).astype(np.float64)
        raw = np.sign(raw) * np.sqrt(np.abs(raw))
        raw /= np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
        out[found.column("bucket").to_numpy()] = raw
    return out


def pooled(flat: Flat, vectors: np.ndarray) -> np.ndarray:
    """One row per text: mean and spread of its token vectors, and three numbers on its tokens."""
    doc, bucket = tokens(flat)
    out = np.zeros((flat.docs, 2 * DIMENSIONS + 3), np.float32)
    n = np.bincount(doc, minlength=flat.docs)
    has = np.flatnonzero(n)
    if not len(has):
        return out
    first = (np.cumsum(n) - n)[has]
    many = n[has][:, None]
    own = vectors[bucket]
    mean = np.add.reduceat(own, first, axis=0) / many
    square = np.add.reduceat(own * own, first, axis=0) / many
    again = np.zeros(len(bucket))
    again[1:] = (bucket[1:] == bucket[:-1]) & (doc[1:] == doc[:-1])
    different = np.bincount(np.unique(doc * BUCKETS + bucket) // BUCKETS, minlength=flat.docs)[has]
    out[has, :DIMENSIONS] = mean
    out[has, DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[has, -3] = np.log1p(n[has])
    out[has, -2] = different / n[has]
    out[has, -1] = np.add.reduceat(again, first) / n[has]
    return out


class Network:
    """Two layers, trained with Adam; probabilities at a temperature found on texts set apart."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.constant = None
        if len(set(y.tolist())) < 2:
            self.constant = float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
            return
        rng = np.random.RandomState(3)
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.centre) / self.scale
        order = rng.permutation(len(y))
        apart = order[:len(y) // 5] if len(y) >= 50 else order
        learn = order[len(y) // 5:] if len(y) >= 50 else order
        self.w = [rng.randn(x.shape[1], HIDDEN) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
                  rng.randn(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(p) for p in self.w], [np.zeros_like(p) for p in self.w], 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(learn), max(1, len(learn) // 128)):
                step += 1
                for i, g in enumerate(self._gradients(x[part], y[part])):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] -= RATE * (m[i] / (1 - 0.9 ** step)) / (
                        np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.temperature = self._calibrated(self._logit(x[apart]), y[apart])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.w
        return np.tanh(x @ a + b) @ c + d[0]

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = self.w
        h = np.tanh(x @ a + b)
        error = (1 / (1 + np.exp(-np.clip(h @ c + d[0], -30, 30))) - y) / len(y)
        back = error[:, None] * c * (1 - h * h)
        return [x.T @ back + DECAY * a, back.sum(axis=0), h.T @ error + DECAY * c,
                np.array([error.sum()])]

    @staticmethod
    def _calibrated(logit: np.ndarray, y: np.ndarray) -> float:
        def loss(t: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logit / t, -30, 30))), 1e-9, 1 - 1e-9)
            return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
        return min(np.geomspace(0.25, 8, 61).tolist(), key=loss)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logit = self._logit((x - self.centre) / self.scale)
        return 1 / (1 + np.exp(-np.clip(logit / self.temperature, -30, 30)))


def _pool(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, flat in slices(batch.column(2), SLICE):
                x = pooled(flat, vectors.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, flat.docs), batch.column(1).slice(low, flat.docs),
                     pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "x"])
    return run


def train(docs: DataFrame, labels: DataFrame, vectors, sample: int = SAMPLE) -> Network:
    """Learn from ``labels`` (doc_id, quality). At most ``sample`` different pairs of id and text are
    drawn by hash, so an id on many rows sends no more to the driver than any other."""
    marked = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id") \
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    texts = docs.filter("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text")) \
        .withColumn("mark", F.xxhash64("text"))
    draw = F.xxhash64(F.lit(3), "doc_id", "mark")
    drawn = texts.select("doc_id", "mark").join(marked, "doc_id").distinct() \
        .orderBy(draw, "doc_id", "mark").limit(sample)
    chosen = docs.sparkSession.createDataFrame(drawn.collect(), drawn.schema)  # three numbers a row
    rows = texts.join(F.broadcast(chosen), ["doc_id", "mark"]).select("doc_id", "label", "text") \
        .mapInArrow(_pool(vectors), "doc_id long, label double, x binary").distinct().collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float32)
    return Network(x.reshape(len(rows), 2 * DIMENSIONS + 3).astype(np.float64),
                   np.array([r["label"] for r in rows]))


def _score(vectors, network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, flat in slices(batch.column(1), SLICE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, flat.docs),
                     pa.array(network.value.score(pooled(flat, vectors.value)).astype(np.float64))],
                    ["doc_id", "score"])
    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and score. Words are counted over all of ``docs``; labels are
    those that may be learned from."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs))
    network = context.broadcast(train(docs, labels, vectors))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_score(vectors, network), "doc_id long, score double")
