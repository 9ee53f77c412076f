"""What a Python worker gives back when a task ends: Spark keeps workers for later tasks, of any operator."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Return memory that is free in this process to the system; does nothing where the C library cannot."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(scan: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``scan``, a generator over batches, with memory given back behind the last of them."""

    @wraps(scan)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from scan(batches)
        finally:
            give_back()

    return run
