"""Memory of Python workers, which live on after a task and serve other operators.

Allocators keep what was freed for their process. A worker that has read texts once would hold tens of
megabytes for as long as it lives, and an executor has several of them.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool, and the C library's where it can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, giving memory back when the task ends."""
    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped
