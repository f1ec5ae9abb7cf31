"""Cutting texts where a byte-level split pattern always begins a match, and a table of encoded pieces.

The split patterns of the byte-level tokenizers take one space with the word, number or sign that
follows it. So a match begins at every space before a visible character, whatever stands before
it, and the pieces between such places can be encoded one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: A cut is made only before these characters, which no version of Unicode calls white space.
CUT = re.compile(" (?=[!-~¡-ᙿ])")
OTHER = re.compile(" (?![!-~¡-ᙿ])")


def parts_of(text: str) -> list[str]:
    """Pieces that give the text when joined; each but the first begins with its space."""
    head, *tail = CUT.split(text) if OTHER.search(text) else text.split(" ")
    parts = [" " + p for p in tail]
    return [head, *parts] if head else parts


CHUNK = 40_000   # pieces looked up together
LONGEST = 256    # characters of a piece that is kept
#: About the bytes that a kept piece takes in the table, and each of its characters with what it gives.
PIECE_BYTES, CHARACTER_BYTES = 300, 24


class PieceTable:
    """Values of pieces, found by ``learn`` for many new pieces at once. Two generations of at most
    half of ``budget`` bytes each are kept, so frequent pieces stay while memory is bounded, whatever
    the texts; pieces of more than LONGEST characters are never kept. A task clears the table when it
    ends, for its worker lives on and serves other operators."""

    def __init__(self, learn: Callable[[list[str]], list], budget: int):
        self.learn, self.budget = learn, budget
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.bytes = 0  # of the young generation

    def clear(self) -> None:
        self.young, self.old, self.bytes = {}, {}, 0

    def lookup(self, parts: list[str]) -> list:
        out = []
        for low in range(0, len(parts), CHUNK):
            some = parts[low:low + CHUNK]
            found = list(map(self.young.get, some))
            if None in found:
                missing = [i for i, f in enumerate(found) if f is None]
                values = self._fill([some[i] for i in missing])
                for i in missing:
                    found[i] = values[some[i]]
            out += found
        return out

    def lookup_texts(self, texts: list[str]) -> list[list]:
        """Values of the pieces of every text; new pieces of all the texts are learned together."""
        parts = [parts_of(t) if t else [] for t in texts]
        found, out, low = self.lookup([p for some in parts for p in some]), [], 0
        for some in parts:
            out.append(found[low:low + len(some)])
            low += len(some)
        return out

    def _fill(self, parts: list[str]) -> dict[str, object]:
        values = dict.fromkeys(parts)
        for p in values:
            values[p] = self.old.get(p)
        new = [p for p, v in values.items() if v is None]
        values.update(zip(new, self.learn(new)))
        kept = values if max(map(len, values), default=0) <= LONGEST else {
            p: v for p, v in values.items() if len(p) <= LONGEST}
        size = PIECE_BYTES * len(kept) + CHARACTER_BYTES * sum(map(len, kept))
        if self.bytes + size > self.budget // 2:
            self.old, self.young, self.bytes = self.young, {}, 0
        if size <= self.budget // 2:
            self.young.update(kept)
            self.bytes += size
        return values
