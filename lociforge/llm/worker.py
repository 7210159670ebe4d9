"""Memory of the executors' Python workers.

Workers are reused by later tasks and stages, and two allocators keep what a task has freed: Arrow's pool and the C library.  What idle
workers hold counts against the executor, so it goes back to the system after each task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Returns freed memory to the system, where the C library can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy_batches(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``run``, and after its last batch what it freed is given back."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_call(run: Callable) -> Callable:
    """For Arrow UDFs: ``run``, and after each call what it freed is given back."""

    @wraps(run)
    def tidied(*args):
        try:
            return run(*args)
        finally:
            give_back()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """For ``applyInArrow``, which counts its function's parameters: ``run``, and after each group what it freed is given back."""

    def tidied(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return tidied
