"""What operators with Python workers share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return what a worker has freed to the system: Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, giving back at its end what it has freed: workers outlive tasks, and stages without Python run beside them."""

    def to_its_end(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return to_its_end
