"""Bounded memory outside the JVM's heap: Arrow batches of texts, and what Python workers keep between tasks."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 1_000  # texts in an Arrow batch
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows at most in this session; a smaller setting stays.

    Spark's 10,000 texts of some kB are tens of MB in a batch, and its buffers double as they
    grow: hundreds of MB outside the heap, which the process does not give back.
    """
    rows = int(spark.conf.get(_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_SETTING, str(BATCH_ROWS))


CACHES: list[dict] = []  # tables that a worker rebuilds at little cost


def give_back() -> None:
    """Return what is free in this process, and what it can build again, to the system."""
    for cache in CACHES:
        cache.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
