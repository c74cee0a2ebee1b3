"""Sizes of the batches that Spark hands to Python, and what its worker processes keep between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows and bytes of a batch at most; a single longer row is a batch of its own.
ROWS, BYTES = 2048, 16 << 20

_held: dict[Hashable, object] = {}


def small_batches(df: DataFrame) -> DataFrame:
    """df, with batches for Python bounded by ROWS and BYTES from now on in its session.

    Spark reads these settings when the query runs, after this returns, so they can't be put back here.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))
    return df


def held(key: Hashable, make: Callable[[], object]) -> object:
    """What this worker process keeps from task to task, made once; one thing at a time, so an operator's goes when the next one's comes."""
    if key not in _held:
        forget()
        _held[key] = make()
    return _held[key]


def forget() -> None:
    """Drop what is held and give freed memory back to the system: executors count the memory of their idle workers too."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
