"""Part-of-day histograms over HHMM clock times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.timeparts import DAYPART_BINS, DAYPART_OTHER, HOUR_PREFIX_BINS, daypart, hour_prefix_part


def daypart_counts(df: DataFrame, hhmm_col: str, where: Column | None = None, bins: Sequence = DAYPART_BINS,
                   other: str = DAYPART_OTHER, label_col: str = "period_of_day",
                   count_col: str = "crime_total") -> DataFrame:
    """Rows per part of day, busiest first.

    Bins are inclusive HHMM integer ranges; a null or unparseable time goes
    to the ``other`` bin instead of failing the job.
    """
    if where is not None:
        df = df.filter(where)
    return (
        df.groupBy(daypart(F.col(hhmm_col), bins, other).alias(label_col))
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), F.col(label_col))
    )


def hour_prefix_counts(df: DataFrame, hhmm_col: str, where: Column | None = None, bins: Sequence = HOUR_PREFIX_BINS,
                       label_col: str = "period_of_day", count_col: str = "crime_total") -> DataFrame:
    """Rows per part of day chosen by set membership of the hour prefix.

    Times whose first two characters are in no bin are dropped.
    """
    if where is not None:
        df = df.filter(where)
    labelled = df.select(hour_prefix_part(F.col(hhmm_col), bins).alias(label_col)).filter(F.col(label_col).isNotNull())
    return labelled.groupBy(label_col).agg(F.count(F.lit(1)).alias(count_col)).orderBy(
        F.col(count_col).desc(), F.col(label_col)
    )


def reduce_by_key(df: DataFrame, key: str, value: str, out_col: str = "total") -> DataFrame:
    """Sum of ``value`` per ``key``, largest first (map-side combine, one shuffle)."""
    return df.groupBy(key).agg(F.sum(value).alias(out_col)).orderBy(F.col(out_col).desc(), F.col(key))
