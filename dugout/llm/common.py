"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession

from ..session import settle

__all__ = ["give_back", "in_worker", "settle", "table"]

Made = TypeVar("Made")
_HELD: dict[Hashable, object] = {}


def in_worker(key: Hashable, make: Callable[[], Made]) -> Made:
    """What ``make`` gives, kept in this worker process until another key is asked for.

    Tasks of one operator that follow each other share it; an operator that comes later in
    the same process does not find the memory taken.
    """
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()
            give_back()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the system, which allocators keep for later else."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
