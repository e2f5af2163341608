"""L4/L5 side tables from CSV files: incomes, reverse geocoding and stations.

Columns are taken by their header names (in any case), so files may hold further columns in any order, the same in all
files of one call. Values that
don't parse become null and their rows stay, as for incidents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One scan over files of one layout; every column a string (no inference pass over the data)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", True).csv(paths)


def load_income(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(zip, community, income_raw); the amount stays text such as ``$33,887`` (``clean_money`` parses it)."""
    raw = _read(spark, paths)
    return raw.select(
        F.col("`Zip Code`").alias("zip"),
        F.col("Community").alias("community"),
        F.col("`Estimated Median Income`").alias("income_raw"),
    )


def load_geocode(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(lat, lon, zip); a ZIP may carry a +4 suffix or be null."""
    raw = _read(spark, paths)
    return raw.select(
        F.col("LAT").try_cast("double").alias("lat"),
        F.col("LON").try_cast("double").alias("lon"),
        F.col("ZIPcode").alias("zip"),
    )


def load_stations(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(site_id, prec, division, y, x); site_id is the precinct as a number, y the latitude, x the longitude."""
    raw = _read(spark, paths)
    return raw.select(
        F.col("PREC").try_cast("int").alias("site_id"),
        F.col("PREC").alias("prec"),
        F.col("DIVISION").alias("division"),
        F.col("Y").try_cast("double").alias("y"),
        F.col("X").try_cast("double").alias("x"),
    )


__all__ = ["load_geocode", "load_income", "load_stations"]
