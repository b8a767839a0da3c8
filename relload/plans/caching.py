"""Cached intermediates that can be given back.

``cached`` persists a frame and notes it in the innermost open :class:`Caches`; whoever
opened it releases all of them once its results are written.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_OPEN: list[Caches] = []


class Caches:
    """The frames cached while it was open (``with``); :meth:`release` drops them."""

    def __init__(self):
        self.frames: list[DataFrame] = []

    def __enter__(self) -> Caches:
        _OPEN.append(self)
        return self

    def __exit__(self, *_) -> None:
        _OPEN.remove(self)

    def release(self) -> None:
        while self.frames:
            self.frames.pop().unpersist()


def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """``df`` persisted, and released with the innermost open :class:`Caches`."""
    df = df.persist(level)
    if _OPEN:
        _OPEN[-1].frames.append(df)
    return df
