"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import gc
import sys
from types import ModuleType

import pyarrow as pa

_NAME = "corpusmill_worker_cache"


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python process.

    Task functions travel with the globals they use, so a dictionary of this package's own
    modules would be new in every task. This one hangs on a module that the process holds.
    Users bound what they keep.
    """
    held = sys.modules.setdefault(_NAME, ModuleType(_NAME))
    return held.__dict__.setdefault(name, {})


def give_back() -> None:
    """Return free memory to the system, which a Python process else keeps for its next tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)
