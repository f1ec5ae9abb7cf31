"""Toxicity: a convolutional network over hashed word embeddings, with thresholds by language.

Words are runs of letters (ASCII letters and all bytes from 0x80 on), with A-Z and the Latin-1 capitals
made small. A word is known by two hashes, its own and that of its first STEM code points, and each
by the slot of the hash and a second part of it that the slot keeps. Its embedding is the sum of both;
what the network has not learned has an embedding of zeros. Filters of WIDTHS words
run over the whole text, the largest value of every filter is kept, and a linear layer turns these
into a probability.

Every labelled text is learned from, whole. Spark counts in how many texts of the table each word and
stem is; those of at least MIN_TEXTS are numbered, of those that share one of 2**SLOT_BITS slots the most
frequent, so the model is bounded whatever the table. The labelled texts are dealt by a hash of id and
text into blocks of about TEXTS and stored as numbers. In each of EPOCHS turns every block trains from
the same parameters (numpy, Adagrad, words left out at random), and Spark averages what the blocks
changed, each parameter over the blocks that changed it, by their texts. Words that no text learned from
holds stay zero.

A fifth of the labelled texts, by another hash, is set apart. The language of a text is the one of most
of its function words (``lang`` is not read). The threshold of a language is the middle of the gap, on
all texts set apart, where F1 is best; logits are counted there in steps of 1 / GRID. A language with
fewer than ENOUGH texts of either label set apart gets the threshold of all. The score is the probability
moved, on the logit scale, so that the threshold of the text's language lies at 0.7. Only the text enters
a score.

Nulls count as empty texts; a text without words is scored as one unknown word. Several labels of a
document are averaged (from one half on toxic). Without labels every score is 0.5, with labels of one
kind the smoothed share of that kind. Rows that repeat are scored each, and learned from once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.flat import Flat, mix, slices
from lakewarden.llm.lean import lean
from lakewarden.llm.scratch import Scratch

MIN_TEXTS = 5
TEXTS, WORDS = 8192, 1 << 23  # of a block; a longer text is a block of its own
KEPT = 1 << 19  # different words counted in a task before it passes them on
SLOT_BITS, STEM = 20, 4
DIMENSIONS, FILTERS, WIDTHS = 16, 16, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY, LEFT_OUT = 6, 64, 0.05, 1e-5, 0.25
MARK, ENOUGH, GRID = 0.7, 20, 256
SLICE, BLOCK = 1 << 18, 1 << 15

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to is that it for with are this by",
    "de": "der die das und ist nicht ein eine mit den von zu",
    "fr": "le les et des est dans pour qui pas au du sur",
    "es": "el los las y del por una con para su al como",
    "it": "il di che gli della per sono nel anche alla dei non",
    "pt": "o os do da em um uma não na ao dos foi",
    "nl": "het een van en dat niet zijn op voor aan met ook",
}
OTHER = len(FUNCTION_WORDS)

_U = np.uint64
_PAD = max(WIDTHS) - 1
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 0x20


def small(flat: Flat) -> Flat:
    """The texts with A-Z and the Latin-1 capitals (0xC3 0x80 to 0x9E, but the sign 0x97) made small."""
    data = _SMALL[flat.data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[1:][capital] += 0x20
    return Flat(data, flat.offsets)


def word_hashes(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Text of every word, in order, and its two hashes: the word's and, scrambled once more, the stem's."""
    flat = small(flat)
    starts, ends = flat.runs(_LETTER[flat.data])
    begins = (flat.data & 0xC0) != 0x80  # of code points
    places = np.append(np.flatnonzero(begins), len(flat.data))
    fourth = np.searchsorted(places, starts) + STEM
    stems = np.minimum(places[np.minimum(fourth, len(places) - 1)], ends)
    return flat.doc_of(starts), np.stack((flat.hashes(starts, ends), mix(flat.hashes(starts, stems) + _U(1))))


def _hashes_of(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    return word_hashes(Flat(np.frombuffer(b"".join(raw), np.uint8), offsets))[1]


_FUNCTION = {lang: _hashes_of(words.split()) for lang, words in FUNCTION_WORDS.items()}


class Lexicon:
    """Number of a word or stem by its hash: 0 for those that were not learned."""

    def __init__(self, hashes: np.ndarray, stems: np.ndarray):
        """``hashes`` come most frequent first, after the function words; a slot belongs to the first
        that claims it. ``stems`` holds the hash of the stem of each word, 0 for a stem itself."""
        known = np.concatenate(list(_FUNCTION.values()), axis=1)
        hashes, stems = np.append(known[0], hashes), np.append(known[1], stems)
        first = np.sort(np.unique((hashes >> _U(64 - SLOT_BITS)).astype(np.int64), return_index=True)[1])
        kept = hashes[first]
        slots = (kept >> _U(64 - SLOT_BITS)).astype(np.int64)
        self.size = len(kept) + 1
        self.number = np.zeros(1 << SLOT_BITS, np.int32)
        self.check = np.zeros(1 << SLOT_BITS, np.uint32)
        self.number[slots] = np.arange(1, self.size)
        self.check[slots] = (kept & _U(0xFFFFFFFF)).astype(np.uint32)
        self.stem = np.append(np.int32(0), self.lookup(stems[first]))
        #: One column per language: whether the word is one of its function words.
        self.function = np.zeros((self.size, OTHER), bool)
        for column, words in enumerate(_FUNCTION.values()):
            found = self.lookup(words[0])
            self.function[found[found > 0], column] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes >> _U(64 - SLOT_BITS)).astype(np.int64)
        known = self.check[slots] == (hashes & _U(0xFFFFFFFF)).astype(np.uint32)
        return np.where(known, self.number[slots], 0)

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Words (first row of the hashes) and stems as one number each: that of the word, which gives
        its stem, or that of the stem of a word which is not known."""
        word, stem = self.lookup(hashes)
        return np.where(word > 0, word << 1, stem << 1 | 1).astype("<i4")

    def words(self, codes: np.ndarray) -> np.ndarray:
        """Words and stems of codes."""
        number, known = codes >> 1, codes & 1 == 0
        return np.stack((np.where(known, number, 0), np.where(known, self.stem[number], number)))

    def languages(self, texts: int, doc: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Language of every text; OTHER without any function word."""
        hits = np.zeros((texts, OTHER), np.int64)
        for column in range(OTHER):
            hits[:, column] = np.bincount(doc[self.function[words, column]], minlength=texts)
        return np.where(hits.any(axis=1), hits.argmax(axis=1), OTHER)


def sequence(texts: int, doc: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (first row) and stems of all texts in one line, _PAD zeros behind each text, and where the
    texts begin. A text without words is one zero and its padding."""
    size = np.maximum(np.bincount(doc, minlength=texts), 1) + _PAD
    start = np.cumsum(size) - size
    line = np.zeros((2, int(size.sum())), np.int32)
    first = np.searchsorted(doc, np.arange(texts))
    line[:, start[doc] + np.arange(len(doc)) - first[doc]] = words
    return line, start


class Network:
    """Embeddings, filters, and the layer over their largest values; doubles while it learns, so that
    another order of additions inside numpy does not show in the scores."""

    def __init__(self, size: int, seed: int | list[int] = 5):
        rng = np.random.RandomState(seed)
        self.rng, self.size = rng, size
        self.embedding = rng.randn(size, DIMENSIONS) * 0.1
        self.embedding[:1] = 0
        self.filters = [rng.randn(w * DIMENSIONS, FILTERS) / np.sqrt(w * DIMENSIONS) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS) for _ in WIDTHS]
        self.out = rng.randn(len(WIDTHS) * FILTERS) * 0.1
        self.bias = np.zeros(1)

    def responses(self, line: np.ndarray) -> list[np.ndarray]:
        """Values of all filters of each width at every place that has _PAD places behind it."""
        x = self.embedding[line[0]] + self.embedding[line[1]]
        n, out = len(x) - _PAD, []
        for w, f in zip(WIDTHS, self.filters):
            total = x[:n] @ f[:DIMENSIONS]
            for k in range(1, w):
                total += x[k:n + k] @ f[k * DIMENSIONS:(k + 1) * DIMENSIONS]
            out.append(total)
        return out

    def largest(self, line: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Largest value of every filter over each text, block by block."""
        out = np.full((len(start), len(WIDTHS) * FILTERS), -np.inf, self.embedding.dtype)
        low, end = 0, line.shape[1] - _PAD
        padding = np.zeros(line.shape[1], bool)  # no window begins there: it could reach into the next text
        for k in range(1, _PAD + 1):
            padding[start[1:] - k] = True
        while low < end:
            high = min(low + BLOCK, end)
            first = np.searchsorted(start, low, side="right") - 1
            last = np.searchsorted(start, high, side="left")
            cuts = np.maximum(start[first:last], low) - low
            for i, r in enumerate(self.responses(line[:, low:high + _PAD])):
                part = slice(i * FILTERS, (i + 1) * FILTERS)
                r[padding[low:high]] = -np.inf
                out[first:last, part] = np.maximum(out[first:last, part], np.maximum.reduceat(r, cuts, axis=0))
            low = high
        return out

    def logits(self, line: np.ndarray, start: np.ndarray) -> np.ndarray:
        top = self.largest(line, start) + np.concatenate(self.shift)
        return np.maximum(top, 0) @ self.out + self.bias[0]

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.shift, self.out, self.bias]

    def small(self) -> Network:
        """This network in single precision, to score with."""
        self.embedding, self.out = self.embedding.astype(np.float32), self.out.astype(np.float32)
        self.filters = [f.astype(np.float32) for f in self.filters]
        self.shift = [f.astype(np.float32) for f in self.shift]
        return self

    def peaks(self, line: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of every filter over each text, and its first place, block by block."""
        ends = np.append(start[1:], line.shape[1]) - _PAD
        top = np.full((len(start), len(WIDTHS), FILTERS), -np.inf)
        place = np.zeros(top.shape, np.int64)
        column = np.arange(FILTERS)
        for low in range(0, int(ends[-1]), BLOCK):
            high = min(low + BLOCK, int(ends[-1]))
            x = (self.embedding[line[0, low:high + _PAD]] + self.embedding[line[1, low:high + _PAD]]).T
            first = np.searchsorted(start, low, side="right") - 1
            texts = range(first, np.searchsorted(start, high, side="left"))
            for i, (w, f) in enumerate(zip(WIDTHS, self.filters)):
                r = f[:DIMENSIONS].T @ x[:, :high - low]
                for k in range(1, w):
                    r += f[k * DIMENSIONS:(k + 1) * DIMENSIONS].T @ x[:, k:high - low + k]
                for t in texts:
                    a, b = max(start[t], low) - low, min(ends[t], high) - low
                    if a >= b:
                        continue  # only padding
                    at = r[:, a:b].argmax(axis=1) + a
                    value = r[column, at]
                    better = value > top[t, i]
                    top[t, i, better], place[t, i, better] = value[better], at[better] + low
        return top.reshape(len(start), -1), place

    def train(self, words: np.ndarray, ends: np.ndarray, y: np.ndarray, memory: list[np.ndarray]) -> None:
        """One turn over texts laid end to end (``ends``: exclusive ends); ``memory`` holds the sums of
        squares: one number for every embedding, then as many as each other parameter has."""
        starts, order = np.concatenate(([0], ends[:-1])), self.rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // BATCH)):
            self._step([words[:, starts[i]:ends[i]] for i in part], y[part], memory)

    def _step(self, texts, y, memory) -> None:
        doc = np.repeat(np.arange(len(texts)), [t.shape[1] for t in texts])
        words = np.concatenate(texts, axis=1)
        chance = self.rng.random_sample(words.shape[1])
        words[0][chance < 2 * LEFT_OUT] = 0  # a stem also has to do without its word
        words[1][chance < LEFT_OUT] = 0
        line, start = sequence(len(texts), doc, words)
        top, place = self.peaks(line, start)
        top += np.concatenate(self.shift)
        active = np.maximum(top, 0)
        error = (1 / (1 + np.exp(-np.clip(active @ self.out + self.bias[0], -30, 30))) - y) / len(y)
        back = error[:, None] * self.out * (top > 0)
        filters, shifts, rows, slopes = [], [], [], []
        for i, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            g = back[:, i * FILTERS:(i + 1) * FILTERS]
            grad = np.empty_like(f)
            for k in range(w):
                word, stem = line[:, place[:, i] + k]            # text x filter
                x = self.embedding[word] + self.embedding[stem]  # text x filter x dimension
                own = f[k * DIMENSIONS:(k + 1) * DIMENSIONS]
                grad[k * DIMENSIONS:(k + 1) * DIMENSIONS] = np.einsum("tfd,tf->df", x, g)
                text, filt = np.nonzero(g)
                slope = g[text, filt][:, None] * own.T[filt]
                rows += [word[text, filt], stem[text, filt]]
                slopes += [slope, slope]
            filters.append(grad + DECAY * f)
            shifts.append(g.sum(axis=0))
        rest = [*filters, *shifts, active.T @ error + DECAY * self.out, np.array([error.sum()])]
        for p, m, g in zip(self.dense(), memory[1:], rest):
            m += g * g
            p -= RATE * g / np.sqrt(m)
        row, inverse = np.unique(np.concatenate(rows), return_inverse=True)
        slopes = np.concatenate(slopes)
        slope = np.stack([np.bincount(inverse, slopes[:, d], len(row)) for d in range(DIMENSIONS)], axis=1)
        learned = row > 0  # words that are not learned stay zero
        row, slope = row[learned], slope[learned]
        memory[0][row] += (slope * slope).mean(axis=1)
        self.embedding[row] -= RATE * slope / np.sqrt(memory[0][row])[:, None]


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the gap between two texts' logits where F1 is best; of equally good ones the widest."""
    order = np.argsort(logit, kind="stable")
    z, hit, other = logit[order], weight[order] * y[order], weight[order] * (1 - y[order])
    right = hit.sum() - np.cumsum(hit)[:-1]
    wrong = other.sum() - np.cumsum(other)[:-1]
    f1 = 2 * right / np.maximum(right + wrong + hit.sum(), 1e-12)
    gap = np.diff(z)
    if not len(gap):
        return float(z[0])
    best = max(range(len(gap)), key=lambda i: (round(float(f1[i]), 9) if gap[i] > 0 else -1.0, float(gap[i])))
    return float((z[best] + z[best + 1]) / 2)


class Model:
    """Lexicon, network and thresholds by language, or one score for all texts."""

    def __init__(self, lexicon: Lexicon | None, network: Network | None, thresholds: np.ndarray | None,
                 constant: float | None = None):
        self.lexicon, self.network, self.thresholds, self.constant = lexicon, network, thresholds, constant

    def score(self, flat: Flat) -> np.ndarray:
        if self.constant is not None:
            return np.full(flat.docs, self.constant)
        doc, hashes = word_hashes(flat)
        words = self.lexicon.lookup(hashes)
        logit = self.network.logits(*sequence(flat.docs, doc, words)).astype(np.float64)
        moved = logit - self.thresholds[self.lexicon.languages(flat.docs, doc, words[0])] + _logit(MARK)
        return 1 / (1 + np.exp(-np.clip(moved, -30, 30)))


def _counted(hashes: np.ndarray, stems: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once, with its stem and the sum of its counts."""
    one, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return one, stems[first], np.bincount(which, n, len(one)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their stems, and stems (whose own stem is 0): in how many texts each is."""
    def out(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(found[0].view(np.int64)), pa.array(found[1].view(np.int64)), pa.array(found[2])],
            ["hash", "stem", "n"])

    held = (np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64))
    waiting, size = [held], 0
    for batch in batches:
        for _, flat in slices(batch.column(0)):
            doc, hashes = word_hashes(flat)
            for own, stems in ((hashes[0], hashes[1]), (hashes[1], np.zeros(len(doc), _U))):
                order = np.argsort(own, kind="stable")
                h, d = own[order], doc[order]
                first = np.append(True, h[1:] != h[:-1])[:len(h)]
                places = np.flatnonzero(first)
                if len(places):
                    n = np.add.reduceat((first | np.append(True, d[1:] != d[:-1])).astype(np.int64), places)
                    waiting.append((h[places], stems[order[places]], n))
                    size += len(places)
            if size > KEPT:
                waiting = [_counted(*map(np.concatenate, zip(*waiting)))]
                if len(waiting[0][0]) > KEPT:
                    yield out(waiting[0])
                    waiting = [held]
                size = 0
    yield out(_counted(*map(np.concatenate, zip(*waiting))))


def lexicon_of(texts: DataFrame) -> Lexicon:
    """Words and stems of at least MIN_TEXTS texts, of those in one slot the most frequent."""
    found = texts.select("text").mapInArrow(_count, "hash long, stem long, n long") \
        .groupBy("hash").agg(F.sum("n").alias("n"), F.first("stem").alias("stem")) \
        .filter(F.col("n") >= MIN_TEXTS) \
        .groupBy(F.shiftrightunsigned("hash", 64 - SLOT_BITS).alias("slot")) \
        .agg(F.max(F.struct("n", "hash", "stem")).alias("best")) \
        .select("best.hash", "best.stem", "best.n").toArrow()  # at most one row for each slot
    hashes, stems, n = (found.column(c).to_numpy() for c in range(3))
    order = np.lexsort((hashes, -n))
    return Lexicon(hashes[order].view(_U), stems[order].view(_U))


def _planes(codes: np.ndarray) -> bytes:
    """Codes by place of their bytes: the high ones are nearly all zero and take little room stored."""
    return codes.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _code(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, flat in slices(batch.column(2), SLICE):
                doc, hashes = word_hashes(flat)
                bounds = np.searchsorted(doc, np.arange(flat.docs + 1))
                codes = sent.value.codes(hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, flat.docs), batch.column(1).slice(low, flat.docs),
                     pa.array([_planes(codes[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary())],
                    ["doc_id", "mark", "codes"])
    return run


BLOCKS = "part int, block int, sizes binary, label binary, apart binary, codes binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a part, in order, in blocks."""
    part, number, size, texts, label, apart = None, 0, 0, [], [], []

    def out() -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], "<i4")
        values = [part, number, sizes.tobytes(), np.array(label, np.uint8).tobytes(),
                  np.array(apart, np.uint8).tobytes(), _planes(np.concatenate(texts))]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                          ["part", "block", "sizes", "label", "apart", "codes"])

    for batch in batches:
        for here, y, a, raw in zip(*(batch.column(c).to_pylist() for c in range(4))):
            codes = _from_planes(raw)
            if texts and (here != part or size + len(codes) > WORDS):
                yield out()
                number = number + 1 if here == part else 0
                size, texts, label, apart = 0, [], [], []
            part = here
            size += len(codes)
            texts.append(codes)
            label.append(y)
            apart.append(a)
    if texts:
        yield out()


def _block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, exclusive ends, labels and whether set apart, of the texts of a block."""
    return (_from_planes(row["codes"]), np.cumsum(np.frombuffer(row["sizes"], "<i4"), dtype=np.int64),
            np.frombuffer(row["label"], np.uint8).astype(np.float64), np.frombuffer(row["apart"], np.uint8) == 1)


def _chosen(codes, ends, which) -> tuple[np.ndarray, np.ndarray]:
    """Codes and exclusive ends of some of the texts."""
    sizes = np.diff(ends, prepend=0)
    return codes[np.repeat(which, sizes)], np.cumsum(sizes[which])


def _rows(arrays: list[np.ndarray]) -> np.ndarray:
    """Arrays of any shape one behind the other, in rows of DIMENSIONS numbers."""
    flat = np.concatenate([a.ravel() for a in arrays])
    return np.append(flat, np.zeros(-len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)


def _from_rows(rows: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([a.size for a in like])
    return [p.reshape(a.shape).copy() for p, a in zip(np.split(rows.ravel()[:ends[-1]], ends[:-1]), like)]


_D = [f"d{i}" for i in range(DIMENSIONS)]
CHANGE = "number int, texts long, squares double, " + ", ".join(f"{d} float" for d in _D)


def _change(sent, words, turn: int, few: bool):
    """How a turn over each block changes the parameters, times its texts: a row for every embedding, and
    with numbers behind those, for the other parameters and then for their sums of squares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedding, squares, dense, memory = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                codes, ends, y, apart = _block(row)
                learn = ~apart | few
                if not learn.any():
                    continue
                codes, ends = _chosen(codes, ends, learn)
                pairs = words.value.words(codes)
                holds = np.zeros(len(embedding), bool)
                holds[0] = holds[pairs[0]] = holds[pairs[1]] = True
                used, which = np.flatnonzero(holds), (np.cumsum(holds, dtype=np.int32) - 1)[pairs]
                del codes, pairs
                net = Network(0, [5, turn, row["part"], row["block"]])
                net.embedding = embedding[used].astype(np.float64)
                net.filters, net.shift, net.out, net.bias = _unpacked(dense)
                own = [squares[used].astype(np.float64), *(m.copy() for m in memory)]
                net.train(which, ends, y[learn], own)
                rest = np.concatenate((_rows(net.dense()) - _rows(dense), _rows(own[1:]) - _rows(memory)))
                change = np.concatenate((net.embedding - embedding[used], rest)) * len(ends)
                gain = np.append(own[0] - squares[used], np.zeros(len(rest))) * len(ends)
                number = np.append(used, len(embedding) + np.arange(len(rest))).astype(np.int32)
                keep = change.any(axis=1) | (turn == 0)  # the first turn names all words learned from
                keep[0] = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[keep]), pa.array(np.full(keep.sum(), len(ends))), pa.array(gain[keep]),
                     *(pa.array(change[keep, d].astype(np.float32)) for d in range(DIMENSIONS))],
                    ["number", "texts", "squares", *_D])
    return run


def _unpacked(dense: list[np.ndarray]) -> tuple[list, list, np.ndarray, np.ndarray]:
    own, n = [d.copy() for d in dense], len(WIDTHS)
    return own[:n], own[n:2 * n], own[-2], own[-1]


def learned(blocks: DataFrame, words, few: bool, store: Scratch) -> Network:
    """The network after EPOCHS turns over all blocks."""
    context, size = blocks.sparkSession.sparkContext, words.value.size
    net = Network(size)
    embedding, squares = net.embedding.astype(np.float32), np.full(size, 1e-6, np.float32)
    dense = net.dense()
    memory = [np.full_like(p, 1e-6) for p in dense]
    del net
    seen = np.zeros(size, bool)
    for turn in range(EPOCHS):
        sent = context.broadcast((embedding, squares, dense, memory))
        found = blocks.mapInArrow(lean(_change(sent, words, turn, few)), CHANGE).groupBy("number") \
            .agg(*[(F.sum(c) / F.sum("texts")).cast("float").alias(c) for c in ("squares", *_D)]).toArrow()
        number = found.column("number").to_numpy()
        own, rest = number < size, np.argsort(number)[(number < size).sum():]
        seen[number[own]] = True
        squares[number[own]] += found.column("squares").to_numpy()[own]
        moved = np.zeros((len(number), DIMENSIONS), np.float32)
        for i, d in enumerate(_D):
            moved[:, i] = found.column(d).to_numpy()
        embedding[number[own]] += moved[own]
        # The other parameters change in every block, but for those whose slopes were all zero.
        both = np.concatenate((_rows(dense), _rows(memory)))
        both[number[rest] - size] += moved[rest]
        half = len(both) // 2
        dense, memory = _from_rows(both[:half], dense), _from_rows(both[half:], memory)
        sent.destroy()
        del found
        store.release()  # of the turn's shuffle
    out = Network(0)
    out.size, out.embedding = size, np.where(seen[:, None], embedding, 0)
    out.filters, out.shift, out.out, out.bias = _unpacked(dense)
    return out.small()


def _judge(sent, few: bool):
    """How many texts set apart have each language, step of the logit and label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, network = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                codes, ends, y, apart = _block(row)
                which = np.flatnonzero(apart | few)
                starts = np.concatenate(([0], ends[:-1]))
                for low in range(0, len(which), BATCH):
                    some = which[low:low + BATCH]
                    doc = np.repeat(np.arange(len(some)), ends[some] - starts[some])
                    words = lexicon.words(np.concatenate([codes[starts[i]:ends[i]] for i in some]))
                    logit = network.logits(*sequence(len(some), doc, words))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lexicon.languages(len(some), doc, words[0]).astype(np.int32)),
                         pa.array(np.rint(np.clip(logit, -30, 30) * GRID).astype(np.int32)), pa.array(y[some])],
                        ["lang", "step", "label"])
    return run


def thresholds_of(blocks: DataFrame, lexicon: Lexicon, network: Network, few: bool) -> np.ndarray:
    """Thresholds by language, from exact counts over all texts set apart."""
    sent = blocks.sparkSession.sparkContext.broadcast((lexicon, network))
    found = blocks.mapInArrow(lean(_judge(sent, few)), "lang int, step int, label double") \
        .groupBy("lang", "step", "label").agg(F.count("*").alias("n")).toArrow()
    lang, step, y, n = (found.column(c).to_numpy() for c in range(4))
    order = np.lexsort((lang, y, step))
    lang, logit, y, n = lang[order], step[order] / GRID, y[order], n[order].astype(np.float64)
    out = np.full(OTHER + 1, threshold(logit, y, n))
    for k in range(OTHER + 1):
        mine = lang == k
        if min(n[mine & (y == 1)].sum(), n[mine & (y == 0)].sum()) >= ENOUGH:
            out[k] = threshold(logit[mine], y[mine], n[mine])
    return out


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, toxic): from every labelled text, different pairs of id and text
    once each."""
    marked = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id") \
        .agg((F.avg("toxic") >= 0.5).cast("double").alias("label"))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                             F.xxhash64("text").alias("mark"), "text")
    store = Scratch(docs.sparkSession, "toxicity")
    keys = store.save(texts.select("doc_id", "mark").join(marked, "doc_id").distinct(), "labels")
    counts = {r["label"]: r["n"] for r in keys.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    if len(counts) < 2:
        store.drop(keys)
        return Model(None, None, None, (counts.get(1.0, 0) + 1) / (n + 2))
    few = min(counts.values()) < 2 * ENOUGH
    context = docs.sparkSession.sparkContext
    lexicon = lexicon_of(texts)
    words = context.broadcast(lexicon)
    store.release()
    parts = -(-n // TEXTS)

    def draw(seed: int, most: int):
        return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "mark"), F.lit(most)).cast("int")

    coded = texts.mapInArrow(_code(words), "doc_id long, mark long, codes binary") \
        .dropDuplicates(["doc_id", "mark"]).join(keys, ["doc_id", "mark"])
    blocks = store.save(
        coded.select(draw(12, parts).alias("part"), F.col("label").cast("int").alias("label"),
                     (draw(2, 5) == 0).cast("int").alias("apart"), "codes", "doc_id", "mark")
        .repartition(parts, "part").sortWithinPartitions("part", "doc_id", "mark")
        .select("part", "label", "apart", "codes").mapInArrow(_pack, BLOCKS), "blocks", 1)
    store.drop(keys)
    store.release()
    network = learned(blocks, words, few, store)
    thresholds = thresholds_of(blocks, lexicon, network, few)
    store.drop(blocks)
    store.release()
    return Model(lexicon, network, thresholds)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, flat in slices(batch.column(1), SLICE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, flat.docs), pa.array(model.value.score(flat).astype(np.float64))],
                    ["doc_id", "score"])
    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and score; labels are those that may be learned from."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_score(model), "doc_id long, score double")
