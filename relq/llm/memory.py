"""One large object at a time in a Python worker.

Workers live on between tasks, and so do the memos of tokenizers, which are
worth keeping for the next task of the same kind.  A task of another kind
drops them, so that a worker never holds the memos of several operators.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_held: dict[Hashable, object] = {}


def only(key: Hashable, make: Callable[[], object]) -> object:
    """The object held under ``key``, made anew (others dropped) if need be."""
    if key not in _held:
        drop()
        _held[key] = make()
    return _held[key]


def drop() -> None:
    """Let go of what is held, and hand freed memory back to the system: the
    allocators of C and Arrow would keep it for this process, which may stay
    idle for long."""
    if _held:
        _held.clear()
        gc.collect()
    trim()


def trim() -> None:
    """Hand freed memory back."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function that hands freed memory back when the task ends."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
