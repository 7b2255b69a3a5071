"""What a Python worker keeps between tasks. Workers are reused by all operators of a session, so an
operator's tables and caches go as soon as the worker runs a task of another operator, and memory
that a task has freed goes back to the machine when the task ends."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_kept: dict[str, Callable[[], None]] = {}
_now: list[str] = [""]


def keeps(operator: str, clear: Callable[[], None]) -> None:
    """Tells how to let go of what ``operator`` keeps."""
    _kept[operator] = clear


def task(operator: str):
    """Marks a function over Arrow batches as a task of an operator."""
    def mark(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        @functools.wraps(run)
        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            works_for(operator)
            try:
                yield from run(batches)
            finally:
                give_back()

        return whole

    return mark


def give_back() -> None:
    """Allocators keep what was freed; an idle worker has no use for it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def works_for(operator: str) -> None:
    """To be called where a task begins."""
    if _now[0] != operator:
        for other, clear in _kept.items():
            if other != operator:
                clear()
        _now[0] = operator
        gc.collect()
