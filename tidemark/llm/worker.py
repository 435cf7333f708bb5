"""What a Python worker keeps between tasks, and when it lets go of it.

Spark hands a worker process on from stage to stage.  Tables that one operator keeps for its
next tasks (vocabularies, encoded words) would stay there while others need the memory.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa

from . import tokens

_kept: list[Callable] = []
_operator: str | None = None


def kept(make: Callable) -> Callable:
    """``make`` with its last results kept for further tasks of the same operator."""
    cached = lru_cache(maxsize=2)(make)
    _kept.append(cached)
    return cached


def release() -> None:
    """Gives memory that is no longer used back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which decides for itself
        pass


def begin(operator: str) -> None:
    """Called at the start of a task: what another operator kept here goes."""
    global _operator
    if _operator not in (None, operator):
        for cached in _kept:
            cached.cache_clear()
        tokens.forget_powers()
        release()
    _operator = operator
