"""Texts of an Arrow batch as flat byte arrays: words, lines and their hashes without Python loops.

Work goes in slices of a bounded number of bytes (one longer text is a slice of its own), so memory
follows the slice and not the batch. A word is a run of bytes other than ASCII white space
(0x20, 0x09-0x0D), as in the pattern ``[^\\x20\\x09-\\x0D]+``. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; different inputs keep different outputs."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit hashes."""
    return ((x >> _U(11)) + _U(1)).astype(np.float64) * 2.0 ** -53


def powers(n: int, name: str = "up") -> np.ndarray:
    """``base**i`` modulo 2**64 for i < n; "down" has the inverse powers."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        base = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, SLICE_BYTES + 1), base, _U)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 8 * SLICE_BYTES:  # tables for one very long text are not kept
            _powers[name] = have
    return have[:n]


class Flat:
    """Bytes of some texts, one after the other; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.docs = len(offsets) - 1
        filled = offsets[1:] > offsets[:-1]
        self._first, self._last = offsets[:-1][filled], offsets[1:][filled] - 1
        self._sums: np.ndarray | None = None

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every run of marked bytes; runs end with their text."""
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        start[self._first] = inside[self._first]
        end[self._last] = inside[self._last]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def per_doc(self, marks: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def bounds(self, positions: np.ndarray) -> np.ndarray:
        """Where the items of each text begin in a sorted list of positions; one more at the end."""
        return np.searchsorted(positions, self.offsets, side="left")

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of every span of bytes, from prefix sums of a polynomial."""
        if self._sums is None:
            n = len(self.data)
            self._sums = np.zeros(n + 1, _U)
            np.cumsum((self.data.astype(_U) + _U(1)) * powers(n), out=self._sums[1:])
        span = self._sums[ends] - self._sums[starts]
        return mix(span * powers(len(self.data) + 1, "down")[starts]
                   + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def slices(texts: pa.Array, limit: int = SLICE_BYTES,
           rows: int = 1 << 16) -> Iterator[tuple[int, Flat]]:
    """Row number of the first text and the Flat of each slice of a string array, with at most
    ``limit`` bytes (or one text) and ``rows`` texts in each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), low + rows, len(texts))
        yield low, Flat(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
        low = high


def occurrence(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by (owner, value, place). Returns the order, how many equal items stand before each
    sorted item, and the size of its group of equal items."""
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    return order, np.arange(len(order)) - np.repeat(first, size), np.repeat(size, size)
