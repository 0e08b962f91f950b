"""Bounded caches of computed values for one Python worker."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from functools import wraps
from itertools import islice
from typing import Any

import pyarrow as pa

#: What this worker keeps from one task to the next.
_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept for the worker's next tasks under ``key``.

    Spark gives the tasks of later queries to the same workers, and an executor has
    several of them beside its heap; so they keep what one operator needs only.
    """
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Free what the worker keeps of the operator that it ran before."""
    _KEPT.clear()


def give_back() -> None:
    """Return what was freed to the system; allocators keep it for the process else."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # glibc has it
        libc.malloc_trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function for mapInArrow, that gives memory back when its task ends:
    an executor has idle workers beside those that run."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


class HotCache(dict):
    """``cache[key]`` computes and keeps what is missing, in bounded memory.

    When ``limit`` values are held they become the old generation and a new one
    begins; what is asked for again moves over, the rest goes with the next
    change. Frequent keys so stay, whatever passes through.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def trim(self, entries: int) -> None:
        """Keep the first entries only: frequent keys are met early."""
        first = dict(islice(self.items(), entries))
        self.old = {}
        self.clear()
        self.update(first)


class Generations:
    """A cache that is filled in bulk: ``turn`` before a batch, then ``found`` for the
    batch's keys, after which ``held`` gets those that were absent."""

    def __init__(self, limit: int):
        self.limit, self.held, self.old = limit, {}, {}

    def turn(self) -> None:
        if len(self.held) >= self.limit:
            self.held, self.old = {}, self.held

    def found(self, keys: list) -> list:
        """Values of the batch's distinct keys, looked up once; None for absent ones."""
        held, old = self.held, self.old
        values = list(map(held.get, keys))
        for i in [i for i, v in enumerate(values) if v is None]:
            if (v := old.get(keys[i])) is not None:
                values[i] = held[keys[i]] = v
        return values
