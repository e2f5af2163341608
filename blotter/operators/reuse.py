"""A scope for intermediates that several results read: cached while it lasts, and released in any case when it ends.

A checkpoint (``extreme_zone_counts(materialize=True)``) survives lost executors and is written to the shared folder; a cache is
faster, is computed again where an executor is lost, and must be released. The caller chooses.
"""

from __future__ import annotations

from types import TracebackType

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class Reuse:
    """``with Reuse() as reuse: shared = reuse.keep(df); ...``: what was kept is unpersisted at the end, after success and after an error.

    Frames that read a kept one must run inside the scope; outside it they are computed anew (the result is the same).
    """

    def __init__(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self.level = level
        self._kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, cached from its first use on. One that was cached before stays the caller's, and isn't released here."""
        if df.storageLevel != StorageLevel.NONE:
            return df
        df.persist(self.level)
        self._kept.append(df)
        return df

    def release(self) -> None:
        """Give back all that was kept; waits until the blocks are gone."""
        while self._kept:
            self._kept.pop().unpersist(blocking=True)

    def __enter__(self) -> Reuse:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        self.release()
