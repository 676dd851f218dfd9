"""Memory of Python workers, which outlive their tasks."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system at the end of a task or group.

    Python workers outlive their tasks: what they keep counts beside the stages that follow.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries than glibc have none
    if trim:
        trim(0)
