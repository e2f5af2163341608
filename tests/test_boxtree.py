"""Nearest sites by the tree of bounding boxes: exact against all pairs, also for far points, equal sites and hot places."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.functions.geo import geodesic_distances
from blotter.operators import boxtree
from blotter.operators.facilities import nearest_facility


def _all_pairs(lat, lon, slat, slon, metric):
    far = geodesic_distances if metric == "geodesic" else boxtree._hav
    return np.stack([far(np.full(len(slat), a), np.full(len(slat), o), slat, slon) for a, o in zip(lat, lon)])


def _places(rng, n, kind):
    if kind == "globe":
        return np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    if kind == "pole":
        return rng.uniform(89.5, 90, n), rng.uniform(-180, 180, n)
    if kind == "date line":
        return rng.uniform(-1, 1, n), (rng.uniform(179.5, 180.5, n) + 180) % 360 - 180
    return 34 + rng.normal(0, 0.1, n), -118 + rng.normal(0, 0.1, n)


@pytest.mark.parametrize("metric", ["haversine", "geodesic"])
@pytest.mark.parametrize("kind", ["globe", "pole", "date line", "city"])
def test_equals_all_pairs(spark, kind, metric):
    rng = np.random.default_rng(len(kind))
    slat, slon = _places(rng, 500, kind)
    parts = [_places(rng, 30, k) for k in (kind, "globe")]
    lat, lon = (np.concatenate([p[x] for p in parts] + [np.array([0.0, 90, -90, 0, 10][: 5 if x == 0 else 0] or [0.0, 0, 33, 180, -180])]) for x in (0, 1))
    sites = spark.createDataFrame([(int(k), float(a), float(o), f"s{k}") for k, (a, o) in enumerate(zip(slat, slon))], "site_id long, y double, x double, name string")
    points = spark.createDataFrame([(int(k), float(a), float(o)) for k, (a, o) in enumerate(zip(lat, lon))], "pid long, lat double, lon double").repartition(3)
    got = {r["pid"]: r for r in nearest_facility(points, sites, metric=metric, site_cols=["name"], max_broadcast_sites=0).collect()}
    d = _all_pairs(lat, lon, slat, slon, metric)
    assert len(got) == len(lat)
    for k in range(len(lat)):
        assert abs(got[k]["distance_km"] - d[k].min()) < 1e-6 and d[k][got[k]["site_id"]] - d[k].min() < 1e-6
        assert got[k]["name"] == f"s{got[k]['site_id']}"


def test_many_points_and_sites(spark):
    """100,000 points (a third in one place, some on the other side of the globe) and 50,000 sites: exact on a slice, nothing lost, no hot key."""
    k = F.col("id")
    u, v = F.rand(3), F.rand(4)
    sites = spark.range(0, 50_000, 1, 4).select(k.alias("site_id"), (33.5 + u).alias("y"), (-118.7 + v * F.when(k % 10 == 0, 0.01).otherwise(1.0)).alias("x")).checkpoint()
    lat = F.when(k % 3 == 0, F.lit(34.0522)).when(k % 100 == 1, -60 * F.rand(5)).otherwise(33.5 + F.rand(6))
    lon = F.when(k % 3 == 0, F.lit(-118.2437)).when(k % 100 == 1, 180 * F.rand(7)).otherwise(-118.7 + F.rand(8))
    points = spark.range(0, 100_000, 1, 4).select(k.alias("pid"), lat.alias("lat"), lon.alias("lon")).checkpoint()
    seen = {}
    plain = boxtree.skew_join

    def watched(left, right, on, how="inner", **kw):
        if on == [("leaf", "of")]:
            seen["pairs"], seen["leaf"] = left.count(), left.groupBy("leaf").count().agg(F.max("count")).first()[0]
        return plain(left, right, on, how, **kw)

    boxtree.skew_join = watched
    try:
        got = nearest_facility(points, sites, metric="geodesic").checkpoint()
    finally:
        boxtree.skew_join = plain
    assert got.count() == 100_000 and got.where("site_id is null").count() == 0
    assert seen["pairs"] < 8 * 67_000 and seen["leaf"] < seen["pairs"] / 20  # equal locations count once
    s = sites.toPandas()
    some = got.where("pid % 1000 in (0, 1)").toPandas()
    d = _all_pairs(some.lat.to_numpy(), some.lon.to_numpy(), s.y.to_numpy(), s.x.to_numpy(), "geodesic")
    assert len(some) == 200 and np.abs(d.min(1) - some.distance_km.to_numpy()).max() < 1e-6


def test_ties_candidates_and_missing_coordinates(spark):
    rng = random.Random(2)
    spots = [(34 + rng.random(), -118 + rng.random()) for _ in range(30)]
    sites = spark.createDataFrame([(k, *spots[k % 30]) for k in range(300)], "site_id long, y double, x double")  # ten sites in each spot
    points = spark.createDataFrame([(k, *spots[k % 30]) for k in range(60)] + [(60, None, 1.0), (61, 34.0, float("nan")), (62, -0.0, 0.0)], "__row long, lat double, lon double")
    got = nearest_facility(points, sites, metric="haversine", ties=True, max_broadcast_sites=0, candidates_col="c").collect()
    by = {}
    for r in got:
        by.setdefault(r["__row"], []).append(r)
    assert sorted(by) == list(range(63))
    for k in range(60):
        assert sorted(r["site_id"] for r in by[k]) == list(range(k % 30, 300, 30)) and all(r["distance_km"] == 0 for r in by[k])
        assert {x["k"] for x in by[k][0]["c"]} >= set(range(k % 30, 300, 30))
    assert [(r["site_id"], r["distance_km"]) for k in (60, 61) for r in by[k]] == [(None, None)] * 2
    first = {r["__row"]: r["site_id"] for r in nearest_facility(points, sites, metric="haversine", max_broadcast_sites=0).collect()}
    assert all(first[k] == k % 30 for k in range(60))
    wide = sites.withColumn("note", F.repeat(F.lit("x"), 40_000))
    assert {r["__row"]: r["site_id"] for r in nearest_facility(points, wide, metric="haversine", site_cols=["note"]).collect()} == first  # 12 MB of payload: no broadcast


def test_leaves_hold_all_sites_once(spark):
    sites = spark.range(1000).select((F.col("id") % 7).cast("double").alias("lat"), F.lit(1.0).alias("lon"), F.col("id").alias("k"), F.struct(F.lit(1)).alias("p"))
    leaves = boxtree.site_leaves(sites, 1000, leaf=10, most=20)  # at most about 20 leaves, so 50 sites in each
    rows = leaves.collect()
    assert sorted(c["k"] for r in rows for c in r["cands"]) == list(range(1000)) and max(len(r["cands"]) for r in rows) == 50
    assert len(rows) <= 20 + 8
