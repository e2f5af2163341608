"""Cross-form checks: each DataFrame operator and its SQL twin return the same multiset."""

import pytest

from blotter import catalog
from tests.conftest import SF_SMALL

PAIRS = [
    ("top_months_per_year", "top_months_per_year_sql"),
    ("daypart_counts", "daypart_counts_sql"),
    ("daypart_counts", "udf_scalar"),
    ("daypart_counts", "udf_in_sql"),
    ("income_extremes", "income_extremes_sql"),
    ("responsible_station_by_year", "responsible_station_by_year_sql"),
    ("responsible_station_by_division", "responsible_station_by_division_sql"),
    ("nearest_station_by_year", "nearest_station_by_year_sql"),
    ("nearest_station_by_division", "nearest_station_by_division_sql"),
    ("or_join", "or_join_rewritten"),
    ("filter_prefix", "filter_like"),
    ("csv_scan", "text_scan_from_csv"),
    ("join_hint_merge", "join_hint_shuffle_hash"),
]


def _rows(df):
    from tests.oracle_compare import rows_of

    return rows_of(df.columns, [tuple(r) for r in df.collect()]), sorted(df.columns)


@pytest.mark.parametrize("a,b", PAIRS)
def test_twins_agree(spark, a, b):
    qs = catalog.queries()
    ra, ca = _rows(qs[a](spark, SF_SMALL))
    rb, cb = _rows(qs[b](spark, SF_SMALL))
    assert ca == cb and ra == rb


def test_nearest_never_farther_than_assigned(spark):
    """The nearest station is never farther than the responsible one, per division of incidents."""
    from pyspark.sql import functions as F

    from blotter.operators.facilities import assign_sites, nearest_facility
    from blotter.sources import tables as T

    pts = catalog._armed(catalog._located(spark, SF_SMALL))
    assigned = assign_sites(pts, T.stations(spark, SF_SMALL), point_key="area", site_key="prec").select(
        "incident_id", F.expr("(12742.0176 * asin(sqrt(pow(sin(radians(y - lat) / 2), 2) + cos(radians(lat))"
                              " * cos(radians(y)) * pow(sin(radians(x - lon) / 2), 2))))").alias("assigned"))
    near = nearest_facility(pts.select("incident_id", "lat", "lon"), T.stations(spark, SF_SMALL),
                            metric="haversine").select("incident_id", "distance_km")
    bad = assigned.join(near, "incident_id").filter(F.col("distance_km") > F.col("assigned") + 1e-9).count()
    assert bad == 0
