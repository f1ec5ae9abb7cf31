"""Byte-level BPE with a sentencepiece model written directly from a rank file.

Every byte is one character (U+0100 plus its value), every token a piece of such characters with its
negative rank as the score, the normaliser is the identity. Merging the best-scored neighbours is
then merging the pair of lowest rank, as the rank file asks. A match of the split pattern that is
itself a token becomes that token.

Texts are cut where the pattern always begins a match, and repeated pieces are looked up in a table of
bounded size. Decoding maps every id back to its bytes.

A null text counts as empty: no ids, and the hashes of nothing. Rows that repeat are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakewarden.llm.lean import give_back
from lakewarden.llm.pieces import PieceTable, parts_of

CACHE = 72 << 20  # bytes of the table of pieces


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol buffer field: a number, a 32-bit float or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def letters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_LETTERS)


_LETTERS = {b: 0x100 + b for b in range(256)}


def model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model: the unknown piece is 0, the token of rank r is r + 1."""
    order = sorted(ranks.items(), key=lambda kv: kv[1])
    if [r for _, r in order] != list(range(len(order))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    # Fixed values of the model format: pieces 1 (piece 1, score 2, type 3: 2 unknown),
    # trainer 2 (model type 3: 2 BPE, vocabulary size 4, unk 40, bos 41, eos 42, pad 43),
    # normaliser 3 (name 1, dummy prefix 3, extra white space 4, escaped white space 5).
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in order:
        pieces.append(_field(1, _field(1, letters(token).encode()) + _field(2, -float(rank))))
    trainer = _field(3, 2) + _field(4, len(order) + 1) + _field(40, 0) + \
        _field(41, -1) + _field(42, -1) + _field(43, -1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder over one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.bytes = [t for t, _ in sorted(self.ranks.items(), key=lambda kv: kv[1])]
        self.pattern = regex.compile(pattern)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model(self.ranks))
        self.table = PieceTable(self._learn, CACHE)

    def _merge(self, pretokens: list[str]) -> list[list[int]]:
        raws = [p.encode() for p in pretokens]
        out = [[r] if (r := self.ranks.get(raw)) is not None else None for raw in raws]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            found = self.pieces.encode([letters(raws[i]) for i in rest], num_threads=1)
            for i, ids in zip(rest, found):
                out[i] = [n - 1 for n in ids]
        return out

    def _learn(self, parts: list[str]) -> list[tuple]:
        """Number of ids, ids as text, decoded bytes and ids as bytes of each piece."""
        split = [self.pattern.findall(p) for p in parts]
        names = list(dict.fromkeys(t for tokens in split for t in tokens))
        ids = dict(zip(names, self._merge(names)))
        out = []
        for tokens in split:
            flat = [n for t in tokens for n in ids[t]]
            out.append((len(flat), ",".join(map(str, flat)),
                        b"".join([self.bytes[n] for n in flat]), array("i", flat).tobytes()))
        return out

    def encode(self, text: str) -> list[tuple]:
        """For each piece of the text: number of ids, ids as text, decoded bytes, ids as bytes."""
        return self.table.lookup(parts_of(text))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker; its table serves all tasks of the worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, cache: int = CACHE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 (of the bytes that the ids decode to), n_bytes (of them) and, if asked, ids. ``cache``
    bounds the bytes of the table of pieces in each worker: a smaller one takes more time."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        own.table.budget = cache
        try:
            for batch in batches:
                for low in range(0, batch.num_rows, 64):
                    part = batch.slice(low, 64)
                    rows, lists = [], []
                    for found in own.table.lookup_texts(part.column(1).to_pylist()):
                        raw = b"".join([f[2] for f in found])
                        rows.append((sum([f[0] for f in found]),
                                     hashlib.sha256(",".join([f[1] for f in found]).encode()).hexdigest(),
                                     hashlib.sha256(raw).hexdigest(), len(raw)))
                        if with_ids:
                            lists.append(b"".join([f[3] for f in found]))
                    n, ids, decoded, size = zip(*rows)
                    columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded),
                               pa.array(size, pa.int64())]
                    if with_ids:
                        ends = [0]
                        for x in lists:
                            ends.append(ends[-1] + len(x) // 4)
                        values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(lists))])
                        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            own.table.clear()
            give_back()

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, kind + ", ids array<int>" * with_ids)


def decoded(ids: list[int], path: str, pattern: str) -> bytes:
    """The bytes of a list of ids."""
    own = codec(path, pattern)
    return b"".join([own.bytes[n] for n in ids])
