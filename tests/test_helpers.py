"""Session and join helpers, and edge cases of the operators."""

import uuid

import pytest
from pyspark.sql import functions as F

from blotter.operators.facilities import assigned_distance, nearest_distance, nearest_facility
from blotter.operators.joins import bounded_broadcast, measured_bytes
from blotter.operators.layout import spread
from blotter.session import scratch_path, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == configured or configured is None
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(shared_dir(spark).rstrip("/"))


def test_measured_bytes_see_wide_columns(spark):
    assert measured_bytes(spark.range(100)) == 1600 and measured_bytes(spark.range(0)) == 0
    wide = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 5000)).withColumn("l", F.array(F.lit("y" * 100)))
    assert measured_bytes(wide) > 500_000 + 10_000


def test_bounded_broadcast_only_below_the_bound(spark):
    small, big = spark.range(10), spark.range(1000)
    a = spark.range(5000)
    plan_small = a.join(bounded_broadcast(small, 1600), "id")._jdf.queryExecution().analyzed().toString()
    plan_big = a.join(bounded_broadcast(big, 1600), "id")._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan_small and "broadcast" in plan_small.lower()
    assert "ResolvedHint" not in plan_big


def test_spread_is_explicit_and_runs_no_job(spark):
    df = spark.range(0, 1000, numPartitions=1)
    assert spread(df, None) is df
    assert spread(df, 6).rdd.getNumPartitions() == 6


def test_shared_dir_is_needed_on_a_cluster(spark, monkeypatch):
    import blotter.session as session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(ValueError):
        session.shared_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        session.shared_dir(Session())


def _jobs(spark, make):
    """Jobs that run while ``make`` builds its plan."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        make()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_search_runs_no_job_over_the_points(spark):
    """The sites are counted; an upstream join of the points, with its shuffles, isn't run."""
    sites = spark.createDataFrame([(k, 34 + k / 100, -118.0, "d", str(k)) for k in range(20)], "site_id long, y double, x double, division string, prec string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).selectExpr("id AS incident_id", "34.0 AS lat", "-118.0 AS lon", "id % 7 AS k")
        points = left.join(spark.range(7).selectExpr("id AS k", "cast(id AS string) AS area"), "k")
        few = _jobs(spark, lambda: nearest_facility(left, sites))
        assert _jobs(spark, lambda: nearest_facility(points, sites)) == few
        few = _jobs(spark, lambda: assigned_distance(left.withColumn("area", F.lit("1")), sites, by="division"))
        assert _jobs(spark, lambda: assigned_distance(points, sites, by="division")) == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("max_sites", [20000, 0])
@pytest.mark.parametrize("metric", ["haversine", "geodesic"])
def test_nearest_keeps_any_columns_on_both_paths(spark, max_sites, metric):
    pts = spark.createDataFrame([(1, 34.0, -118.0, 7, 8, 9, 10)], "incident_id long, lat double, lon double, k int, d int, p int, __x int")
    sites = spark.createDataFrame([(5, 34.0, -118.1), (6, 35.0, -118.0)], "site_id long, y double, x double")
    out = nearest_facility(pts, sites, metric=metric, max_broadcast_sites=max_sites, candidates_col="cands")
    assert out.columns == ["incident_id", "lat", "lon", "k", "d", "p", "__x", "site_id", "distance_km", "cands"]
    r = out.first()
    assert (r["k"], r["d"], r["p"], r["__x"], r["site_id"]) == (7, 8, 9, 10, 5)
    assert [c["k"] for c in r["cands"]] == [5] and r["cands"][0]["d"] == r["distance_km"]


def test_one_far_site_does_not_stretch_the_cells(spark):
    from blotter.operators.facilities import _default_cell_deg

    city = [(34 + (k % 20) / 50, -118 + (k // 20) / 50) for k in range(400)]
    make = lambda rows: spark.createDataFrame(rows, "lat double, lon double")
    plain, with_far = _default_cell_deg(make(city))[1], _default_cell_deg(make([*city, (0.0, 0.0)]))[1]
    assert with_far <= 1.2 * plain


@pytest.mark.parametrize("max_sites", [20000, 0])
def test_nearest_without_sites_and_without_coordinates(spark, max_sites):
    pts = spark.createDataFrame([(1, 34.0, -118.0), (2, None, None)], "incident_id long, lat double, lon double")
    none = spark.createDataFrame([], "site_id long, y double, x double")
    got = nearest_facility(pts, none, metric="haversine", max_broadcast_sites=max_sites).collect()
    assert len(got) == 2 and all(r["site_id"] is None for r in got)
    some = spark.createDataFrame([(5, 34.0, -118.0)], "site_id long, y double, x double")
    got = {r["incident_id"]: r["site_id"]
           for r in nearest_facility(pts, some, metric="haversine", max_broadcast_sites=max_sites).collect()}
    assert got == {1: 5, 2: None}
    pts = pts.withColumn("year", F.lit(2015))
    agg = nearest_distance(pts, some, by="year", metric="haversine").collect()
    assert [(r["year"], r["crime_total"]) for r in agg] == [(2015, 1)]
