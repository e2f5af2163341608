"""Partition layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` dealt round-robin to ``partitions``, or as it is when that is None.

    For CPU-bound work on an input that one split holds. The caller knows the input's layout; nothing is looked up, so no job
    runs while the plan is built.
    """
    return df.repartition(partitions) if partitions else df
