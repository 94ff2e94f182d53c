"""Python workers live on between tasks; what a task has freed should leave them."""

from __future__ import annotations

import functools
import inspect
import types
from collections.abc import Callable


def release() -> None:
    """Give freed memory back to the system, where Arrow and the C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frees_memory(work: Callable) -> Callable:
    """A worker function (batch iterator or group function) that releases memory when it is done."""

    def done(result):
        if isinstance(result, types.GeneratorType):
            return _until_done(result)
        release()
        return result

    # Spark looks at the number of parameters.
    if len(inspect.signature(work).parameters) == 2:

        @functools.wraps(work)
        def of_two(left, right):
            return done(work(left, right))

        return of_two

    @functools.wraps(work)
    def of_one(rows):
        return done(work(rows))

    return of_one


def _until_done(batches):
    try:
        yield from batches
    finally:
        release()
