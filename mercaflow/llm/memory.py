"""Memory of Python workers. A worker stays for later tasks, and what it has
freed but not given back counts against its executor all the while."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Returns freed memory to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(work: Work) -> Work:
    """``work`` for ``mapInArrow`` or ``mapInPandas``, with its memory given back at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run
