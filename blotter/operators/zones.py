"""Category counts in the zones with the highest and the lowest income."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.clean import zip_prefix
from blotter.functions.labels import code_to_label
from blotter.operators.reuse import Reuse
from blotter.session import shared_dir


def zone_incomes(income: DataFrame, zone_col: str = "zip", income_col: str = "income") -> DataFrame:
    """One income per zone: the minimum of its rows; zones without a number are dropped."""
    return (
        income.filter(F.col(zone_col).isNotNull() & F.col(income_col).isNotNull())
        .groupBy(zone_col)
        .agg(F.min(income_col).alias(income_col))
    )


def extreme_zones(zones: DataFrame, k: int = 3, zone_col: str = "zip", income_col: str = "income") -> DataFrame:
    """The ``k`` highest- and ``k`` lowest-income zones, tagged by ``side``.

    Equal incomes at the boundary are broken by the zone key, so the result is
    deterministic. ``orderBy().limit()`` runs as a distributed top-k (each
    task keeps k rows), never gathering the zones into one task.
    """
    top = zones.orderBy(F.col(income_col).desc(), F.col(zone_col)).limit(k).withColumn("side", F.lit("highest"))
    bottom = zones.orderBy(F.col(income_col).asc(), F.col(zone_col)).limit(k).withColumn("side", F.lit("lowest"))
    return top.unionByName(bottom)


def facts_per_zone(facts: DataFrame, geocode: DataFrame, *, lat: str = "lat", lon: str = "lon",
                   category: str = "victim_code", zone_col: str = "zip", zip_key: str = "raw",
                   dedupe_geocode: bool = False) -> DataFrame:
    """(zone, category, n): facts placed in zones by exact (lat, lon) lookup.

    Facts are first counted per (lat, lon, category) so that repeated
    locations cross the join shuffle once. ``zip_key='raw'`` joins on the
    geocoder's value as stored (``90731-7232`` then matches no 5-digit
    income key); ``'prefix'`` keeps the part before ``-``.
    """
    if zip_key not in ("raw", "prefix"):
        raise ValueError("zip_key must be 'raw' or 'prefix'")
    zone = F.col(zone_col) if zip_key == "raw" else zip_prefix(zone_col)
    geo = geocode.select(F.col(lat), F.col(lon), zone.alias(zone_col)).filter(F.col(zone_col).isNotNull())
    if dedupe_geocode:
        geo = geo.dropDuplicates([lat, lon])
    counted = (
        facts.filter(F.col(category).isNotNull())
        .groupBy(lat, lon, category)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.join(geo, [lat, lon], "inner").select(zone_col, category, "n")


def extreme_zone_counts(facts: DataFrame, geocode: DataFrame, income: DataFrame, *, k: int = 3,
                        lat: str = "lat", lon: str = "lon", category: str = "victim_code",
                        zone_col: str = "zip", income_col: str = "income", zip_key: str = "raw",
                        label: Callable[[Column], Column] = code_to_label, label_col: str = "victim_descent",
                        count_col: str = "crime_total", dedupe_geocode: bool = False,
                        materialize: bool = True, reuse: Reuse | None = None) -> DataFrame:
    """Facts per category in the ``k`` richest and ``k`` poorest zones.

    Output: ``side`` ('highest' | 'lowest'), the category code, its label and
    the count, busiest first within a side. Only zones that hold at least one
    located fact and have an income compete for the extremes. One pass over
    the facts serves both sides: the 2k extreme zones form a table of proven
    size that is broadcast into the final join.

    The per-zone counts feed both the choice of zones and the final counts;
    with ``materialize`` they are computed once and checkpointed to the
    shared folder (reliable, lineage cut), so the facts are scanned once.
    With ``reuse`` they are cached in that scope instead.
    """
    per_zone = facts_per_zone(facts, geocode, lat=lat, lon=lon, category=category, zone_col=zone_col,
                              zip_key=zip_key, dedupe_geocode=dedupe_geocode)
    per_zone = per_zone.groupBy(zone_col, category).agg(F.sum("n").alias("n"))  # zones x categories rows
    if reuse is not None:
        per_zone = reuse.keep(per_zone)
    elif materialize:
        shared_dir(per_zone.sparkSession)
        per_zone = per_zone.checkpoint(eager=True)
    incomes = zone_incomes(income, zone_col, income_col)
    relevant = incomes.join(per_zone.select(zone_col), zone_col, "left_semi")
    extremes = extreme_zones(relevant, k, zone_col, income_col).select(zone_col, "side")
    counts = (
        per_zone.join(F.broadcast(extremes), zone_col, "inner")
        .groupBy("side", category)
        .agg(F.sum("n").alias(count_col))
    )
    return counts.select("side", category, label(F.col(category)).alias(label_col), count_col).orderBy(
        "side", F.col(count_col).desc(), category
    )


def extreme_zone_totals(counts: DataFrame, label_col: str = "victim_descent",
                        count_col: str = "crime_total") -> DataFrame:
    """Both sides added up per label (UNION ALL semantics: equal rows are not merged)."""
    return counts.groupBy(label_col).agg(F.sum(count_col).alias(count_col)).orderBy(
        F.col(count_col).desc(), F.col(label_col)
    )
