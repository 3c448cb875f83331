"""What a Python worker keeps from one task to the next: tokenizers and the words they have met."""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa

HOLDER = "mercato_llm_kept"


def kept(kind: str, source: str, make: Callable[[], object]):
    """The object made for this source in this process, made once. Workers are reused, functions sent to them are not."""
    held = sys.modules.setdefault(HOLDER, ModuleType(HOLDER)).__dict__
    key = f"{kind}-{hashlib.blake2b(source.encode(), digest_size=16).hexdigest()}"
    if key not in held:
        held[key] = make()
    return held[key]


def _return_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for mapInArrow that hands its freed memory back at its end: its worker may idle beside other stages for long."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _return_memory()

    return wrapped
