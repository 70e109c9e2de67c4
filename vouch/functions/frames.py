"""Small helpers over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by position.

    Halving keeps the plan shallow: a chain of unions is analysed anew at every link.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionAll(union_all(frames[middle:]))
