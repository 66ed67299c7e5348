"""Python stages on Arrow batches, a bounded part of a batch at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship

#: Bytes of a part (one longer row is taken whole).
PART = 1 << 19


def parts(batch: pa.RecordBatch, most: int = PART) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of at most so many bytes."""
    if batch.num_rows <= 1 or batch.nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from parts(batch.slice(0, half), most)
    yield from parts(batch.slice(half), most)


def _run(batches: Iterator[pa.RecordBatch], f: Callable, most: int) -> Iterator[pa.RecordBatch]:
    """f of each part; then what the worker has freed goes back to the system, as workers live on between stages."""
    for b in batches:
        for x in parts(b, most):
            yield f(x)
        del b
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_parts(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, most: int = PART) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(partial(_run, f=f, most=most), schema)
