"""Top-k periods per year (counts per year and month, ranked within the year)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_counts(df: DataFrame, date_col: str, count_col: str = "crime_total") -> DataFrame:
    """Rows per (year, month) of ``date_col``; unparseable dates form a null year."""
    d = F.col(date_col)
    return df.groupBy(F.year(d).alias("year"), F.month(d).alias("month")).agg(F.count(F.lit(1)).alias(count_col))


def top_periods(df: DataFrame, date_col: str, k: int = 3, count_col: str = "crime_total",
                rank_col: str = "rank") -> DataFrame:
    """The ``k`` busiest months of every year.

    ``rank`` semantics: months tied on the count share a rank, so a year can
    return more than ``k`` rows. The counting aggregate is combined map-side;
    the window then sorts at most 12 rows per year, and Spark plans the
    ``rank <= k`` filter as a WindowGroupLimit.
    """
    counts = period_counts(df, date_col, count_col)
    w = Window.partitionBy("year").orderBy(F.col(count_col).desc())
    return counts.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= k)
