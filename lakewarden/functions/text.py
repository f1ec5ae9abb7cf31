"""Pieces of statement text, messages and JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Between texts that travel as one, and before the letter that stands for a mark or for NULL.
GAP, ESCAPE = "\x02", "\x01"


def comment_json(text: Column) -> Column:
    """Content of the first ``/* ... */`` comment; NULL when there is none."""
    opened = F.instr(text, "/*")
    closed = F.instr(text, "*/")
    inner = F.substr(text, opened + F.lit(2), closed - opened - F.lit(2))
    return F.when((opened > 0) & (closed > opened), inner)


def query_tag(text: Column) -> Column:
    """Text after ``QUERY_TAG:`` inside a comment; empty when there is no tag."""
    return F.regexp_extract(text, r"/\*.*?QUERY_TAG:(.*?)\*/", 1)


def error_class(message: Column, otherwise: str = "NO ERROR") -> Column:
    """Text in the first square brackets of an error message."""
    found = F.regexp_extract(message, r"\[(.*?)\]", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(otherwise))


def json_field(text: Column, path: str, otherwise: str | None = None) -> Column:
    value = F.get_json_object(text, f"$.{path}")
    return value if otherwise is None else F.coalesce(value, F.lit(otherwise))


def unit_hash(key: Column, seed: int) -> Column:
    """Number in [0, 1) that depends only on ``key`` and ``seed``, the same on every retry."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def join_texts(columns: Sequence[str]) -> Column:
    """Several text columns as one; equal only where all of them are equal, NULL and empty kept apart."""
    def escaped(name: str) -> Column:
        marked = F.replace(F.col(name), F.lit(ESCAPE), F.lit(ESCAPE + "e"))
        return F.coalesce(F.replace(marked, F.lit(GAP), F.lit(ESCAPE + "g")), F.lit(ESCAPE + "n"))

    return F.concat_ws(GAP, *[escaped(c) for c in columns])


def part_texts(joined: str, n: int) -> list[Column]:
    """The ``n`` texts that ``join_texts`` put together."""
    def plain(part: Column) -> Column:
        marked = F.replace(part, F.lit(ESCAPE + "g"), F.lit(GAP))
        return F.when(part != ESCAPE + "n", F.replace(marked, F.lit(ESCAPE + "e"), F.lit(ESCAPE)))

    return [plain(F.split(joined, GAP)[i]) for i in range(n)]
