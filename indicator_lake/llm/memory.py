"""Memory that one operator's tasks leave to the next one's in the same Python worker."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

BATCH_BYTES = 8 << 20  # of an Arrow batch: a batch's texts and what is made of them are held at once


def _trim() -> None:
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library frees by itself
        pass


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function of batches, giving free memory back to the system when a task ends.

    Workers live on between tasks; without this, each keeps the most it ever needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        _trim()

    return run
