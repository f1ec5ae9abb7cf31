"""Token ids in files compressed by Re-Pair grammars, with random access.

Texts are encoded by a tokenizers file in the tasks (each different piece of text once, see
``pieces``), every document ends with END_ID, and documents are written in ascending doc_id order. A
file row is a shard: some documents of one range of doc_ids, at most about SHARD_IDS ids (a longer
document is a shard of its own). Within a shard the pairs of neighbouring ids that occur at least
MIN_COUNT times are replaced by new symbols, again and again up to ROUNDS times; no pair crosses the
end of a document. The row stores the rules (two symbols each), how many ids every rule stands for,
the symbols, and where each document begins in symbols and in ids, so one document can be decoded
without the others.

Files are Parquet rows with little-endian binary columns, written by Spark's writer, so any store that
Spark reads will do and a repeated task leaves no half-written file.

A null text is empty and holds the end id alone. Rows that repeat a doc_id are ordered by a hash of
their text. Null doc_ids come first. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lakewarden.llm.lean import give_back, lean
from lakewarden.llm.ordered import in_parts, order_key, part_bounds, part_of
from lakewarden.llm.pieces import CUT, PieceTable

END_ID = 0
SHARD_IDS = 1 << 20
MIN_COUNT = 2
CACHE = 64 << 20  # bytes of the table of pieces
WORD_CACHE = 24 << 20  # of that of words
BLOCK = 4 << 20  # bytes of texts encoded together
JOINED = 4096  # pieces in a string for the tokenizer
SHORT = 32  # ids of a rule that is spelled out once
WORDS = 128  # words in a string for its model
STRINGS = 8  # of those at a time
ONCE = 1 << 32  # one occurrence in a rank

SHARD = ("part int, shard int, ids_before long, n_ids int, vocabulary int, doc_id array<long>, "
         "first_id array<int>, first_symbol array<int>, rules binary, lengths binary, "
         "symbol_bytes int, symbols binary")


def compress(ids: np.ndarray, ends: np.ndarray, vocabulary: int, rounds: int | None = None,
             min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over documents laid end to end (``ends``: exclusive ends). Returns the rules (shape
    (n, 2)), the expansion length of each, the symbols, and the documents' ends in symbols.

    Pairs are ranked by their exact count, ties by a fixed scramble of their numbers. A round replaces
    all pairs that rank above every pair they overlap with anywhere: no replacement elsewhere can
    change their count, and none makes a pair that ranks above them, so the most frequent pair first
    would replace them just so. Counts are kept up to date at the replaced places only. Rounds look at
    pairs seen ``least`` times alone, which is halved when none of these can be replaced: rarer pairs
    rank below them. It ends when no pair occurs ``min_count`` times; ``rounds`` ends it
    earlier.
    """
    ends = np.asarray(ends, np.int64)
    sizes = np.diff(ends, prepend=0)
    full = np.flatnonzero(sizes > 0)
    n = len(ids) + len(full) + 1
    border = np.append(ends[full] - sizes[full] + np.arange(len(full)), n - 1)  # places around documents
    within = np.ones(n, bool)
    within[border] = False
    seq = np.full(n, -1, np.int32)  # below 0: a border or no symbol any more
    seq[within] = ids
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)  # neighbours
    after[-1], before[0] = n - 1, 0
    pair = np.zeros(n, np.int32)  # the pair that begins at a place: 0 for none and for those seen too rarely
    skip = np.zeros(n, bool)
    # By the number of a pair: its count and scramble, its symbols, and room for a name and a mark.
    rank, known = np.zeros(n // 4 + 16, np.int64), 1
    left, right, name = (np.zeros(len(rank), np.int32) for _ in range(3))
    mark = np.zeros(len(rank), bool)
    # Where the places of a pair begin in ``pool``, how many were found, and one where another ranks above it.
    start, size, blocked = (np.zeros(len(rank), np.int32) for _ in range(3))
    pool, filled = np.zeros(n + 16, np.int32), 0
    rules: list[np.ndarray] = []
    top, turn, place_bits = vocabulary, 0, n.bit_length()

    def number(places: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Number the pairs (x, y) at places, none of which is known, if they are seen ``min_count``
        times; no pair holds a symbol below 0."""
        nonlocal rank, left, right, name, mark, start, size, blocked, pool, known, filled
        bits = int(top).bit_length()
        if 2 * bits + place_bits < 64:  # sorted in one word with their places
            code = x.astype(np.int64)
            code <<= bits
            code |= y
            code <<= place_bits
            code |= places
            code.sort()
            code = code[np.searchsorted(code, 0):]
            places = (code & (1 << place_bits) - 1).astype(np.int32)
            code >>= place_bits
        else:
            bits = 32
            real = (x | y) >= 0
            code, places = x[real].astype(np.int64) << 32 | y[real], places[real]
            order = np.argsort(code, kind="stable")
            code, places = code[order], places[order]
        again = np.zeros(len(code) + 1, bool)
        np.equal(code[1:], code[:-1], out=again[1:-1])
        some = np.flatnonzero(again[1:] | again[:-1]) if min_count > 1 else np.arange(len(code))
        starts = np.flatnonzero(~again.take(some))
        times = np.diff(starts, append=len(some))
        code, places = code.take(some.take(starts)), places.take(some)
        often = times >= min_count
        if not often.all():
            places, code, times = places[np.repeat(often, times)], code[often], times[often]
        old, known = known, known + len(times)
        rank, left, right, name, mark, start, size, blocked = (
            _grown(a, known) for a in (rank, left, right, name, mark, start, size, blocked))
        numbers = np.arange(old, known)
        left[old:known], right[old:known] = code >> bits, code & (1 << bits) - 1
        rank[old:known] = times << 32 | numbers * 0x9E3779B1 & 0xFFFFFFFF
        start[old:known], size[old:known] = filled + np.cumsum(times) - times, times
        pool = _grown(pool, filled + len(places))
        pool[filled:filled + len(places)] = places
        filled += len(places)
        pair[places] = np.repeat(numbers, times)

    def found(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of some pairs, and the pair of each."""
        sizes = size.take(pairs)
        own = np.repeat(pairs, sizes)
        at = np.repeat(start.take(pairs) - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        at = pool.take(at)
        there = np.flatnonzero(pair.take(at) == own)
        return at.take(there), own.take(there)

    number(np.arange(n - 1, dtype=np.int32), seq[:-1], seq[1:])
    least = max(min_count, int(size[:known].max()) // 2)
    live = np.flatnonzero(rank[:known] >= least << 32)
    while turn != rounds:
        # In a row of equal symbols every other pair counts.
        odd = pool[:0]
        alike = live[left.take(live) == right.take(live)]
        if len(alike):
            row = np.sort(found(alike)[0])
            place = np.arange(len(row))
            begins = pair.take(before.take(row)) != pair.take(row)
            odd = row[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 1]
            of = pair.take(odd)
            np.subtract.at(rank, of, ONCE)
            rare = rank.take(of) < min_count << 32  # these cannot be replaced any more
            rank[of[rare]] = 0
            odd = odd[~rare]
        # A pair that ranks below another at the place where it did before need not be looked at elsewhere.
        mine, place = rank.take(live), blocked.take(live)
        lower = rank.take(pair.take(before.take(place))) > mine
        lower |= rank.take(pair.take(after.take(place))) > mine
        lower &= pair.take(place) == live
        free = live[~lower & (mine >= min_count << 32)]
        at, which = found(free)
        mine = rank.take(which)
        mark[free] = True
        for side in (before, after):
            lower = rank.take(pair.take(side.take(at))) > mine
            of = which[lower]
            mark[of], blocked[of] = False, at[lower]
            still = np.flatnonzero(mark.take(which))
            at, which, mine = at.take(still), which.take(still), mine.take(still)
        np.add.at(rank, pair.take(odd), ONCE)
        used = free[mark.take(free)]
        mark[used] = False
        if not len(used):
            if least <= min_count:
                break
            least = max(min_count, least // 2)
            live = np.flatnonzero(rank[:known] >= least << 32)
            continue
        turn += 1
        if len(odd):
            skip[odd] = True
            even = ~skip.take(at)
            at, which = at[even], which[even]
            skip[odd] = False
        used.sort()
        rules.append(np.stack((left[used], right[used]), axis=1).astype(np.int64))
        base, top = top, top + len(used)
        name[used] = np.arange(base, top)
        new = name.take(which)
        second = after.take(at)
        pair[at] = 0
        for gone in (second, before.take(at)):  # a place is in each once; pairs there are no more
            np.subtract.at(rank, pair.take(gone), ONCE)
            pair[gone] = 0
        rank[0] = 0
        rank[used] = 0
        seq[at], seq[second] = new, -1
        behind = after.take(second)
        after[at], before[behind] = behind, at
        ahead = before.take(at)
        x = seq.take(ahead)
        x[x >= base] = -1  # two new symbols meet: at the place of the left one
        old = known
        number(np.concatenate((at, ahead)), np.concatenate((new, x)), np.concatenate((seq.take(behind), new)))
        live = np.concatenate((live, np.arange(old, known)))
        live = live[rank.take(live) >= least << 32]
    flat = rules_flat(rules)
    kept = np.flatnonzero(seq >= 0)
    out = np.zeros(len(ends), np.int64)
    out[full] = np.searchsorted(kept, border[1:])
    return (flat, _lengths(rules, vocabulary), seq.take(kept).astype(np.int64),
            np.maximum.accumulate(out) if len(out) else out)


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[:len(array)] = array
    return out


def _lengths(rules: list[np.ndarray], vocabulary: int) -> np.ndarray:
    """How many ids each rule stands for; rules of a round hold those of earlier rounds only."""
    out, top = np.ones(vocabulary + sum(map(len, rules)), np.int64), vocabulary
    for some in rules:
        out[top:top + len(some)] = out[some[:, 0]] + out[some[:, 1]]
        top += len(some)
    return out[vocabulary:]


def rules_flat(rules: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def rule_lengths(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """How many ids each symbol stands for; a rule holds ids and rules before it."""
    out = np.append(np.ones(vocabulary, np.int64), np.zeros(len(rules), np.int64))
    open_rules = np.arange(len(rules))
    while len(open_rules):
        parts = out[rules[open_rules]]
        ready = parts.all(axis=1)
        out[vocabulary + open_rules[ready]] = parts[ready].sum(axis=1)
        open_rules = open_rules[~ready]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, vocabulary: int,
           lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for; ``lengths`` of the rules are found if they are not given."""
    size = rule_lengths(rules, vocabulary) if lengths is None else \
        np.append(np.ones(vocabulary, np.int64), lengths)
    # Where symbols are many, those of at most SHORT ids are spelled out once and copied.
    short = vocabulary + np.flatnonzero(size[vocabulary:] <= SHORT) if len(symbols) > len(rules) else rules[:0, 0]
    ids = _spelled(short, rules, vocabulary, size)
    sizes = size.take(short)
    name = np.full(len(size), -1, np.int32)
    name[short] = np.arange(len(short))
    return _spelled(symbols.astype(np.int64), rules, vocabulary, size, name, ids, sizes)


def _spelled(seq: np.ndarray, rules: np.ndarray, vocabulary: int, size: np.ndarray, name: np.ndarray | None = None,
             ids: np.ndarray | None = None, sizes: np.ndarray | None = None) -> np.ndarray:
    """``expand``; the ids of the rules that ``name`` numbers are copied from ``ids``, ``sizes`` each."""
    ends = np.cumsum(size.take(seq))
    start = ends - size.take(seq)
    out = np.zeros(ends[-1] if len(ends) else 0, np.int64)
    while len(seq):  # only rules go on
        plain = np.flatnonzero(seq < vocabulary)
        out[start.take(plain)] = seq.take(plain)
        rest = np.flatnonzero(seq >= vocabulary)
        seq, start = seq.take(rest), start.take(rest)
        if name is not None and len(sizes):
            which = name.take(seq)
            told = np.flatnonzero(which >= 0)
            which = which.take(told)
            many = sizes.take(which)
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place = (np.cumsum(sizes) - sizes).take(which)
            out[np.repeat(start.take(told), many) + step] = ids.take(np.repeat(place, many) + step)
            rest = np.flatnonzero(name.take(seq) < 0)
            seq, start = seq.take(rest), start.take(rest)
        pairs = rules[seq - vocabulary]
        start = np.concatenate((start, start + size.take(pairs[:, 0])))
        seq = np.concatenate((pairs[:, 0], pairs[:, 1]))
    return out


#: Characters whose kind (letter, digit, sign or white space) no version of Unicode changes, and the split
#: pattern of byte-level tokenizers written out for them.
LETTER = "A-Za-zÀ-ÖØ-öø-ſА-ҁ"
KNOWN = re.compile(f"[\t\n\r -~{LETTER}\u2010-\u2027]*")
SPLIT = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[0-9]+| ?[^\\s{LETTER}0-9]+|\\s+(?!\\S)|\\s+")
#: Texts with a space that begins no piece, as ``pieces.OTHER``.
ODD = " (?:[^!-~¡-ᙿ]|\\z)"


def picked(ids: np.ndarray, ends: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of some runs, in turn; runs are given by their ends and how many ids each has."""
    sizes = counts.take(which)
    place = np.repeat(ends.take(which) - np.cumsum(sizes), sizes)
    place += np.arange(len(place))
    return ids.take(place)


class WordTable:
    """Ids of words, found by ``learn`` for many new words at once. When it takes more than ``budget``
    bytes it begins anew."""

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], budget: int):
        self.learn, self.budget = learn, budget
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.counts = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def lookup(self, words: list[str]) -> np.ndarray:
        coded = pa.array(words, pa.string()).dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=self.words)
        new = coded.dictionary.filter(pc.is_null(found))
        which = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        which[which < 0] = len(self.words) + np.arange(len(new))
        if len(new):
            ids, counts = self.learn(new)
            self.words = pa.concat_arrays([self.words, new])
            self.ids, self.counts = np.concatenate((self.ids, ids)), np.concatenate((self.counts, counts))
        out = picked(self.ids, np.cumsum(self.counts), self.counts, which.take(coded.indices.to_numpy()))
        if self.words.nbytes + self.ids.nbytes + self.counts.nbytes > self.budget:
            self.clear()
        return out


class Encoder:
    """Ids of texts by a tokenizers file.

    Texts are cut into pieces as in ``pieces``, each different piece is split into the words that the
    tokenizer's own split would give, and the tokenizer's model finds the ids of many new words in one
    string, with a byte between them that no text holds and nothing merges with. Pieces with other characters
    than KNOWN go to the whole tokenizer, and so does all where the file asks for more than this split.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.words, self.table = WordTable(self._merge, WORD_CACHE), PieceTable(self._learn, CACHE)
        # Bytes of every id: a token of the byte-level alphabet has one character per byte.
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [a.content for a in added.values()]
        self.wide = np.zeros(self.size, np.int64)
        vocabulary = self.tokenizer.get_vocab()
        for token, i in vocabulary.items():
            self.wide[i] = len(added[i].content.encode()) if i in added else len(token)
        # The alphabet: printable bytes stand for themselves, the others for what follows U+00FF in turn.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.letters = np.zeros(256, "<u2")
        self.letters[plain], self.letters[other] = plain, 256 + np.arange(len(other))
        between = chr(self.letters[0])
        first = self.tokenizer.pre_tokenizer
        asked = self.tokenizer.normalizer is None and isinstance(first, pre_tokenizers.ByteLevel) \
            and first.use_regex and not first.add_prefix_space and not any(" " in a for a in self.added)
        self.model = Tokenizer(self.tokenizer.model) if asked and [t for t in vocabulary if between in t] == [between] \
            else None
        self.between = vocabulary.get(between)
        del vocabulary
        give_back()

    def _merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are not split any more, one after the other, and how many each has."""
        stops = [*range(0, len(words), WORDS), len(words)]
        joined = pc.binary_join(pa.ListArray.from_arrays(stops, words), "\0").cast(pa.binary()).to_pylist()
        texts = [self.letters.take(np.frombuffer(raw, np.uint8)).tobytes().decode("utf-16-le") for raw in joined]
        ids = np.concatenate([np.array(e.ids + [self.between], "<u4") for low in range(0, len(texts), STRINGS)
                              for e in self.model.encode_batch_fast(texts[low:low + STRINGS], add_special_tokens=False)])
        stops = np.flatnonzero(ids == self.between)
        return ids[ids != self.between], np.diff(stops, prepend=-1) - 1

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Pieces that begin with a space are encoded many in one string, which the tokenizer splits
        at their beginnings too; where the ids of each end follows from the bytes of the ids."""
        out: list[bytes | None] = [None] * len(parts)
        joined, alone = [], []
        for i, p in enumerate(parts):
            (joined if p[:1] == " " and CUT.match(p) else alone).append(i)
        found = self.tokenizer.encode_batch_fast([parts[i] for i in alone], add_special_tokens=False)
        for i, e in zip(alone, found):
            out[i] = np.array(e.ids, "<u4").tobytes()
        for low in range(0, len(joined), JOINED):
            some = joined[low:low + JOINED]
            words = [parts[i] for i in some]
            text = "".join(words)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cut = self._cuts(ids, np.array([len(p) if p.isascii() else len(p.encode()) for p in words]))
            raw, last = ids.tobytes(), 0
            for i, c in zip(some, cut.tolist()):
                out[i], last = raw[4 * last:4 * c], c
        return out

    def _cuts(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where the ids of each of some pieces end, by the bytes of the pieces."""
        ends, reach = np.cumsum(sizes), np.concatenate(([0], np.cumsum(self.wide.take(ids))))
        cut = np.searchsorted(reach, ends)
        if len(cut) and (reach[-1] != ends[-1] or (reach[cut] != ends).any()):
            raise ValueError("an id crosses the end of a piece")
        return cut

    def _plain(self, text: str) -> bool:
        return self.model is not None and KNOWN.fullmatch(text) is not None and not any(a in text for a in self.added)

    def _tails(self, tails: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces, given without the space that each begins with, one after the other,
        and how many each has. A visible character follows the space, so they are split alike when they
        follow one another."""
        if not len(tails):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        text = " " + pc.binary_join(pa.ListArray.from_arrays([0, len(tails)], tails), " ")[0].as_py()
        if self._plain(text):
            ids = self.words.lookup(SPLIT.findall(text))
            sizes = pc.binary_length(tails).to_numpy().astype(np.int64) + 1
            return ids, np.diff(self._cuts(ids, sizes), prepend=0)
        parts = [" " + t for t in tails.to_pylist()]
        plain = np.array([self._plain(p) for p in parts])
        found = np.zeros(len(parts), object)
        found[~plain] = np.array([*self.table.lookup([p for p, yes in zip(parts, plain) if not yes]), None], object)[:-1]
        ids, counts = self._tails(tails.filter(pa.array(plain)))
        raw, ends = ids.tobytes(), 4 * np.cumsum(counts)
        found[plain] = np.array([*(raw[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist())), None], object)[:-1]
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(p) // 4 for p in found], np.int64)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of every text; new pieces of all the texts are learned together."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        order = np.argsort(odd, kind="stable")
        pieces = pa.chunked_array([
            pc.split_pattern(texts.filter(pa.array(~odd)), " ").cast(pa.list_(pa.string())),
            pa.array([CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()], pa.list_(pa.string()))]).combine_chunks()
        many = pc.list_value_length(pieces).to_numpy().astype(np.int64)
        heads = np.cumsum(many) - many
        flat = pieces.flatten()
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        follows = np.ones(len(codes), bool)
        follows[heads] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[codes[follows]] = True
        codes = (np.cumsum(used) - 1 + len(heads)).take(codes)
        codes[heads] = np.arange(len(heads))
        first = self.table.lookup(flat.take(pa.array(heads)).to_pylist())
        ids, counts = self._tails(coded.dictionary.filter(pa.array(used)))
        del pieces, flat, coded, follows
        ids = np.concatenate((np.frombuffer(b"".join(first), "<u4"), ids))
        counts = np.concatenate((np.array([len(f) // 4 for f in first], np.int64), counts))
        raw = picked(ids, np.cumsum(counts), counts, codes).tobytes()
        stops = 4 * np.cumsum(counts.take(codes))[heads + many - 1]
        out: list[bytes] = [b""] * len(texts)
        last = 0
        for i, stop in zip(order.tolist(), stops.tolist()):
            out[i], last = raw[last:stop], stop
        return out

    def clear(self) -> None:
        self.words.clear()
        self.table.clear()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _shard(part: int, number: int, before: int, vocabulary: int, docs: list, raws: list[bytes]) -> dict:
    give_back()  # what encoding took
    sizes = np.array([len(r) // 4 for r in raws], np.int64)
    ends = np.cumsum(sizes)
    rules, lengths, symbols, symbol_ends = compress(
        np.frombuffer(b"".join(raws), "<u4"), ends, vocabulary)
    wide = 2 if vocabulary + len(rules) <= 1 << 16 else 4
    return {"part": part, "shard": number, "ids_before": before, "n_ids": int(ends[-1]),
            "vocabulary": vocabulary,
            "doc_id": docs, "first_id": (ends - sizes).tolist(),
            "first_symbol": np.append(0, symbol_ends[:-1]).tolist(),
            "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
            "symbol_bytes": wide, "symbols": symbols.astype(f"<u{wide}").tobytes()}


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, together while their texts have at most BLOCK bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().astype(np.int64))
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + BLOCK, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _pack(path: str):
    kinds = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("ids_before", pa.int64()),
                       ("n_ids", pa.int32()), ("vocabulary", pa.int32()), ("doc_id", pa.list_(pa.int64())),
                       ("first_id", pa.list_(pa.int32())), ("first_symbol", pa.list_(pa.int32())),
                       ("rules", pa.binary()), ("lengths", pa.binary()), ("symbol_bytes", pa.int32()),
                       ("symbols", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        part, number, before, size, docs, raws = None, 0, 0, 0, [], []

        def out() -> pa.RecordBatch:
            row = _shard(part, number, before, own.size, docs, raws)
            return pa.RecordBatch.from_pylist([row], kinds)

        try:
            for batch in batches:
                for some in _blocks(batch):
                    ids = own.encode_all(some.column(2))
                    for here, doc, raw in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), ids):
                        if raws and (here != part or size >= SHARD_IDS):
                            yield out()
                            number, before = (number + 1, before + size) if here == part else (0, 0)
                            size, docs, raws = 0, [], []
                        part = here
                        docs.append(doc)
                        raws.append(raw + end)
                        size += len(raw) // 4 + 1
            if raws:
                yield out()
        finally:
            own.clear()
    return run


def write(docs: DataFrame, path: str, folder: str) -> None:
    """Encode all texts by the tokenizers file ``path`` and write shards in doc_id order."""
    bounds = part_bounds(docs.select(order_key().alias("_key")))
    keyed = docs.select(part_of(order_key(), bounds).alias("_part"),
                        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        order_key().alias("_key"), F.xxhash64("text").alias("_tie"))
    in_parts(keyed, bounds, "_key", "_tie").select("_part", "doc_id", "text") \
        .mapInArrow(lean(_pack(path)), SHARD).write.parquet(folder)


def document(shard: dict, at: int) -> np.ndarray:
    """The ids of the document at place ``at`` of a shard, from its own symbols and the rules."""
    symbols = np.frombuffer(shard["symbols"], f"<u{shard['symbol_bytes']}")
    starts = list(shard["first_symbol"]) + [len(symbols)]
    rules = np.frombuffer(shard["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    lengths = np.frombuffer(shard["lengths"], "<u4").astype(np.int64)
    return expand(symbols[starts[at]:starts[at + 1]], rules, shard["vocabulary"], lengths)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            symbols = np.frombuffer(row["symbols"], f"<u{row['symbol_bytes']}")
            rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
            lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
            ids = expand(symbols, rules, row["vocabulary"], lengths).astype("<u4")
            starts = np.append(np.array(row["first_id"], np.int64), len(ids))
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts[:-1], starts[1:])]
            n = len(crc)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_id"], pa.int64()),
                pa.array(starts[:-1] + row["ids_before"]), pa.array(np.diff(starts)),
                pa.array(crc, pa.int64())], ["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens and
    the crc32 of its ids as little-endian 32-bit integers."""
    rows = spark.read.schema(SHARD).parquet(folder)
    found = rows.mapInArrow(lean(_unpack), "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row per part, from columns that need no decoding.
    sizes = rows.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    return found.join(F.broadcast(offset), "part").select(
        "doc_id", (F.col("offset") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
