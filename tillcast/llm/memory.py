"""Memory of Python workers: what a task frees goes back to the system.

A worker is reused by later tasks and stages, and idle ones stay for a while, so what
their allocators keep adds up in an executor. Large blocks are taken from the system
one by one (and returned when freed), Arrow uses the same allocator, and free memory
is handed back after every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

_MMAP_THRESHOLD, _TRIM_THRESHOLD = -3, -1  # fixed values of glibc's mallopt
_LARGE = 1 << 18
_SET: list[bool] = []


def _libc():
    libc = ctypes.CDLL(None)
    return libc if hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim") else None  # absent outside glibc


def settle() -> None:
    """Allocator settings of this worker, once."""
    if not _SET:
        _SET.append(True)
        if libc := _libc():
            libc.mallopt(_MMAP_THRESHOLD, _LARGE)
            libc.mallopt(_TRIM_THRESHOLD, _LARGE)
        pa.set_memory_pool(pa.system_memory_pool())


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def lean(scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that leaves no free memory behind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        try:
            yield from scan(batches)
        finally:
            give_back()
    return run
