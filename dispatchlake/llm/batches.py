"""Arrow batches through Python workers that hand their memory back."""

from __future__ import annotations

import ctypes
import gc
import mmap
from collections.abc import Callable, Iterator

import pyarrow as pa

LIGHT = 160 << 20  # resident bytes up to which a worker is left alone: many small tasks should not pay for it

Batches = Iterator[pa.RecordBatch]


def resident() -> int:
    """Bytes of memory this process holds, 0 where the system does not tell."""
    try:
        with open("/proc/self/statm") as statm:
            return int(statm.read().split()[1]) * mmap.PAGESIZE
    except OSError:
        return 0


def hand_back() -> None:
    """Give freed memory back to the machine: a worker lives on after its task, beside the next one's."""
    if resident() <= LIGHT:
        return
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        return


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow`` whose workers hold no more than their base between tasks."""

    def mapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return mapped
