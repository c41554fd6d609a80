"""Memory of Python workers: what a batch took goes back to the system behind it.

A worker serves many tasks, and an allocator keeps what was freed.  Beside a JVM that keeps its heap, too, two workers
that hold their largest batch for ever would take an executor over its limit.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa


@lru_cache(1)
def _trim():
    """glibc's malloc_trim, or nothing where the C library has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def release() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


def frugal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after each, freed memory is given back."""
    for batch in batches:
        yield batch
        del batch
        release()
    release()
