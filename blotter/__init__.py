"""blotter: Spark-native incident and place analytics.

Parameterised DataFrame operators (each with a Spark SQL twin where the
semantics allow) for typed incident loading, top periods per year,
part-of-day histograms, category counts in the richest and poorest zones,
and distances to the assigned or the nearest facility.

Every operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver and the library never creates or stops a session.
"""

from blotter.functions.geo import geodesic_km, haversine_km
from blotter.operators.dayparts import daypart_counts, hour_prefix_counts
from blotter.operators.facilities import assigned_distance, nearest_distance, nearest_facility
from blotter.operators.periods import period_counts, top_periods
from blotter.operators.zones import extreme_zone_counts
from blotter.sources.incidents import load_incidents, load_incidents_text
from blotter.sources.lookups import load_geocode, load_income, load_stations

__all__ = [
    "assigned_distance",
    "daypart_counts",
    "extreme_zone_counts",
    "geodesic_km",
    "haversine_km",
    "hour_prefix_counts",
    "load_geocode",
    "load_incidents",
    "load_incidents_text",
    "load_income",
    "load_stations",
    "nearest_distance",
    "nearest_facility",
    "period_counts",
    "top_periods",
]
