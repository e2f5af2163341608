"""Distance functions and the exact nearest-facility search."""

import math
import random
import time

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.functions.geo import WGS84_F, _fast, _sure, geodesic_distances, geodesic_km, haversine_km, with_geodesic_km
from blotter.operators.facilities import nearest_facility

FLINDERS = (-37.95103341666667, 144.42486788888888)   # Flinders Peak
BUNINYONG = (-37.65282113888889, 143.92649552777777)  # Buninyong


def _one(spark, expr_fn, a, b):
    df = spark.createDataFrame([(a[0], a[1], b[0], b[1])], "lat1 double, lon1 double, lat2 double, lon2 double")
    return df.select(expr_fn("lat1", "lon1", "lat2", "lon2").alias("d")).first()["d"]


def test_geodesic_reference_line(spark):
    # the GRS80/WGS-84 test line of the Australian geodetic datum manual
    assert abs(_one(spark, geodesic_km, FLINDERS, BUNINYONG) - 54.972271) < 1e-6


def test_geodesic_projection_chain_equals_fold(spark):
    df = spark.createDataFrame([(*FLINDERS, *BUNINYONG), (34.05, -118.25, 34.01, -118.27)],
                               "lat1 double, lon1 double, lat2 double, lon2 double")
    chained = with_geodesic_km(df, "d", "lat1", "lon1", "lat2", "lon2").select("d").collect()
    folded = df.select(geodesic_km("lat1", "lon1", "lat2", "lon2").alias("d")).collect()
    for a, b in zip(chained, folded):
        assert abs(a["d"] - b["d"]) < 1e-9


def test_coincident_points_are_zero(spark):
    assert _one(spark, geodesic_km, (34.0, -118.0), (34.0, -118.0)) == 0.0
    assert _one(spark, haversine_km, (34.0, -118.0), (34.0, -118.0)) == 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.tuples(st.floats(-80, 80), st.floats(-179, 179), st.floats(-80, 80), st.floats(-179, 179)))
def test_distances_symmetric_and_close(spark, p):
    a, b = (p[0], p[1]), (p[2], p[3])
    h1, h2 = _one(spark, haversine_km, a, b), _one(spark, haversine_km, b, a)
    assert h1 >= 0 and abs(h1 - h2) < 1e-6
    g = _one(spark, geodesic_km, a, b)
    assert abs(g - h1) <= 0.01 * h1 + 1e-6


def test_geodesic_always_answers():
    """Random, near-antipodal and degenerate pairs against a quadrature along the geodesic that a fine search finds."""
    rnd = np.random.default_rng(3)
    lat1, lon1 = rnd.uniform(-90, 90, 6000), rnd.uniform(-180, 180, 6000)
    lat2, lon2 = rnd.uniform(-90, 90, 6000), rnd.uniform(-180, 180, 6000)
    lat2[:2000], lon2[:2000] = -lat1[:2000] + rnd.normal(0, 0.2, 2000), lon1[:2000] + 180 + rnd.normal(0, 0.2, 2000)
    lat2 = np.clip(lat2, -90, 90)
    d = geodesic_distances(lat1, lon1, lat2, lon2)
    assert np.isfinite(d).all()
    assert np.allclose(d, geodesic_distances(lat2, lon2, lat1, lon1), atol=1e-6)
    h = 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(1, np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon2 - lon1) / 2) ** 2)))
    assert (np.abs(d - h) <= 0.01 * h + 1e-6).all()
    # where both solutions answer they agree
    beta = [np.arctan((1 - WGS84_F) * np.tan(np.radians(x))) for x in (lat1, lat2)]
    lam = np.abs(np.radians((lon2 - lon1 + 180) % 360 - 180))
    assert np.nanmax(np.abs(_sure(*beta, lam) - _fast(*beta, lam))) < 1e-5


@pytest.mark.parametrize("pair,km", [
    ((0.0, 0.0, 0.0, 180.0), 20003.931459),  # over a pole: half a meridian
    ((0.0, 0.0, 0.5, 179.5), 19936.288579),  # published near-antipodal line
    ((0.0, 0.0, 0.5, 179.7), 19944.127421),  # published line on which Vincenty's iteration fails
    ((90.0, 0.0, -90.0, 77.0), 20003.931459),
    ((0.0, 10.0, 0.0, 11.0), 111.319491),
])
def test_geodesic_known_lines(pair, km):
    assert abs(geodesic_distances(*([x] for x in pair))[0] - km) < 2e-6


def test_geodesic_can_be_filtered(spark):
    df = spark.range(2000).selectExpr("34.0 + id / 1000 AS a", "-118.0 AS b", "34.0 AS c", "-118.0 AS e")
    began = time.time()
    out = with_geodesic_km(df, "d", "a", "b", "c", "e").filter("d < 5").filter("d > 1")
    out._jdf.queryExecution().optimizedPlan()
    assert time.time() - began < 2
    assert out.count() == sum(1 for k in range(2000) if 1 < geodesic_distances([34 + k / 1000], [-118], [34], [-118])[0] < 5)


def test_missing_coordinates_give_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0), (1.0, float("nan"), 2.0, 3.0)], "a double, b double, c double, e double")
    assert [r["d"] for r in with_geodesic_km(df, "d", "a", "b", "c", "e").collect()] == [None, None]


def _brute(points, sites, metric):

    def hav(la1, lo1, la2, lo2):
        p1, p2 = math.radians(la1), math.radians(la2)
        a = math.sin(math.radians(la2 - la1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
            math.radians(lo2 - lo1) / 2) ** 2
        return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(a)))

    out = {}
    for pid, la, lo in points:
        ds = [(hav(la, lo, y, x), sid) for sid, y, x in sites]
        out[pid] = min(ds)
    return out


@pytest.mark.parametrize("spread,max_sites", [(0.5, 20000), (60.0, 20000), (0.5, 0)])
def test_nearest_equals_brute_force(spark, spread, max_sites):
    rnd = random.Random(int(spread * 10) + max_sites)
    sites = [(i, max(-89.0, min(89.0, 34 + rnd.uniform(-spread, spread))), -118 + rnd.uniform(-spread, spread))
             for i in range(40)]
    points = [(i, max(-89.0, min(89.0, 34 + rnd.uniform(-2 * spread, 2 * spread))),
               -118 + rnd.uniform(-2 * spread, 2 * spread)) for i in range(300)]
    sdf = spark.createDataFrame(sites, "site_id long, y double, x double")
    pdf = spark.createDataFrame(points, "incident_id long, lat double, lon double")
    got = {r["incident_id"]: (r["distance_km"], r["site_id"])
           for r in nearest_facility(pdf, sdf, metric="haversine", max_broadcast_sites=max_sites).collect()}
    want = _brute(points, sites, "haversine")
    assert set(got) == set(want)
    for pid, (d, sid) in want.items():
        assert got[pid][1] == sid and abs(got[pid][0] - d) < 1e-6


@pytest.mark.parametrize("max_sites", [20000, 0])
def test_nearest_geodesic_equals_brute_force(spark, max_sites):
    rnd = random.Random(7)
    sites = [(i, 34 + rnd.uniform(-0.3, 0.3), -118 + rnd.uniform(-0.3, 0.3)) for i in range(25)]
    points = [(i, 34 + rnd.uniform(-0.5, 0.5), -118 + rnd.uniform(-0.5, 0.5)) for i in range(200)]
    sdf = spark.createDataFrame(sites, "site_id long, y double, x double")
    pdf = spark.createDataFrame(points, "incident_id long, lat double, lon double")
    pairs = pdf.crossJoin(sdf).select("incident_id", "site_id",
                                      geodesic_km("lat", "lon", "y", "x").alias("d"))
    want = {r["incident_id"]: (r["m"]["d"], r["m"]["site_id"])
            for r in pairs.groupBy("incident_id").agg(F.min(F.struct("d", "site_id")).alias("m")).collect()}
    got = {r["incident_id"]: (r["distance_km"], r["site_id"])
           for r in nearest_facility(pdf, sdf, metric="geodesic", max_broadcast_sites=max_sites).collect()}
    assert got.keys() == want.keys()
    for k, (d, sid) in want.items():
        assert got[k][1] == sid and abs(got[k][0] - d) < 1e-9


def test_nearest_across_antimeridian_and_poles(spark):
    sites = spark.createDataFrame([(1, 0.0, 179.95), (2, 0.0, -170.0), (3, 89.9, 0.0), (4, -89.9, 45.0)],
                                  "site_id long, y double, x double")
    pts = spark.createDataFrame([(1, 0.0, -179.95), (2, 89.95, 170.0), (3, -89.95, -100.0)],
                                "incident_id long, lat double, lon double")
    got = {r["incident_id"]: r["site_id"] for r in nearest_facility(pts, sites, metric="haversine").collect()}
    assert got == {1: 1, 2: 3, 3: 4}
