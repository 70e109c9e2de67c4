"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BREAKS = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The runs of characters between ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAKS, -1), "")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def even_keys(count: int) -> np.ndarray:
    """Whole numbers (int) that a shuffle by hash deals into ``count`` partitions, one into each, in that order."""
    size = 32 * count
    while True:
        numbers = np.arange(size, dtype=np.uint32)
        # Spark's hash of an int: 32-bit Murmur3 with seed 42
        h = numbers * np.uint32(0xCC9E2D51)
        h = ((h << np.uint32(15)) | (h >> np.uint32(17))) * np.uint32(0x1B873593) ^ np.uint32(42)
        h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        places, first = np.unique((h ^ (h >> np.uint32(16))).view(np.int32) % count, return_index=True)
        if len(places) == count:
            return first.astype(np.int32)
        size *= 2


def releasing(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``work`` over the batches of a task, which gives its memory back at the end.

    Workers outlive their tasks, and allocators keep what is free: without this, an idle worker
    holds what the largest of its tasks took.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # a C library without it
                pass

    return run
