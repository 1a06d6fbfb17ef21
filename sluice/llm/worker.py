"""What a Python worker holds from one task to the next.

Workers live on from stage to stage, so whatever a stage leaves in them adds to the next one's peak. A worker keeps one
model at a time, and gives memory back to the system when a task ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa

_held: dict[tuple, Any] = {}


def model(make: Callable[[str], Any], path: str) -> Any:
    """The worker's ``make(path)``. Asking for another one drops it."""
    if (make, path) not in _held:
        _held.clear()
        give_back()
        _held[make, path] = make(path)
    return _held[make, path]


def give_back() -> None:
    """Returns free memory to the system, as far as the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that gives memory back when its task ends."""

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
