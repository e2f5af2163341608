"""Hand-made fixtures, one per semantic trap (FIXTURES.md F1-F4)."""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from blotter.operators.dayparts import daypart_counts, hour_prefix_counts
from blotter.operators.facilities import assigned_distance, nearest_facility
from blotter.operators.joins import key_spellings_join
from blotter.operators.periods import top_periods
from blotter.operators.zones import extreme_zone_counts, extreme_zone_totals
from blotter.sources.incidents import INCIDENT_HEADER, load_incidents, load_incidents_text

D = dt.date

# id, reported, occurred, hhmm, area, descent, premise, weapon, lat, lon
OLDER = [
    ("1", "01/05/2015 12:00:00 AM", "12/31/2014 12:00:00 AM", "2330", "01", "H", "STREET", "102", "34.05", "-118.25"),
    ("2", "02/01/2015 12:00:00 AM", "02/01/2015 12:00:00 AM", "0430", "13", "W", "STREET", "400", "34.01", "-118.27"),
    ("3", "02/02/2015 12:00:00 AM", "02/02/2015 12:00:00 AM", None, "13", None, "SHOP, INDOOR", None, "34.01",
     "-118.27"),
]
NEWER = [
    ("4", "03/03/2015 12:00:00 PM", "03/03/2015 12:00:00 PM", "1200", "01", "-", "STREET", "101", "0", "0"),
    ("5", "not a date", "2015-03-03", "1175", "1", "B", "STREET", "109", "34.05", "0"),
] + [
    (str(6 + i), f"{m:02d}/10/2016 01:00:00 PM", f"{m:02d}/10/2016 01:00:00 PM", "0800", "13", "W", "STREET", "200",
     "34.02", "-118.26")
    for i, m in enumerate([1, 1, 2, 2, 3, 3])
]


def _write(path, header, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            full = [None] * len(INCIDENT_HEADER)
            pos = [0, 1, 2, 3, 4, 13, 15, 16, 26, 27]
            for p, v in zip(pos, r):
                full[p] = v
            w.writerow(["" if v is None else v for v in full])


@pytest.fixture()
def incident_files(tmp_dir):
    older_header = list(INCIDENT_HEADER)
    older_header[4] = "AREA "
    _write(f"{tmp_dir}/older", older_header, OLDER)
    _write(f"{tmp_dir}/newer", list(INCIDENT_HEADER), NEWER)
    return [f"{tmp_dir}/older", f"{tmp_dir}/newer"]


def test_load_unifies_both_generations(spark, incident_files):
    df = load_incidents(spark, incident_files)
    rows = {r["incident_id"]: r for r in df.collect()}
    assert len(rows) == 11
    assert rows["1"]["reported_on"] == D(2015, 1, 5) and rows["1"]["occurred_on"] == D(2014, 12, 31)
    assert rows["1"]["area"] == "01" and rows["5"]["area"] == "1"
    assert rows["3"]["premise"] == "SHOP, INDOOR" and rows["3"]["hhmm"] is None
    assert rows["4"]["occurred_on"] == D(2015, 3, 3)  # 12 PM is noon of the same day
    assert rows["5"]["reported_on"] is None and rows["5"]["occurred_on"] is None  # malformed dates
    assert rows["4"]["lat"] == 0.0 and rows["5"]["lon"] == 0.0


def test_text_scan_equals_csv_scan(spark, incident_files):
    a = load_incidents(spark, incident_files)
    b = load_incidents_text(spark, incident_files)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_daypart_bins(spark, incident_files):
    df = load_incidents(spark, incident_files)
    got = {r["period_of_day"]: r["crime_total"]
           for r in daypart_counts(df, "hhmm", where=F.col("premise") == "STREET").collect()}
    # 2330 and 0430 are night; 1200 afternoon; 1175 is in no bin; six 0800 rows
    assert got == {"21:00-03:59": 2, "12:00-16:59": 1, "Null": 1, "05:00-11:59": 6}
    everything = {r["period_of_day"]: r["crime_total"] for r in daypart_counts(df, "hhmm").collect()}
    assert everything["Null"] == 2  # the null time no longer fails the job


def test_hour_prefix_bins(spark, incident_files):
    df = load_incidents(spark, incident_files)
    got = {r["period_of_day"]: r["crime_total"] for r in hour_prefix_counts(df, "hhmm").collect()}
    # '04' is night here too; '11' (1175) is morning; the null time is dropped
    assert got == {"night": 2, "afternoon": 1, "morning": 7}


def test_top_periods_keeps_rank_ties(spark, incident_files):
    df = load_incidents(spark, incident_files)
    got = top_periods(df, "occurred_on", k=2).filter(F.col("year") == 2016).collect()
    assert sorted((r["month"], r["crime_total"], r["rank"]) for r in got) == [(1, 2, 1), (2, 2, 1), (3, 2, 1)]


def test_null_island_and_prefix_filters(spark, incident_files):
    df = load_incidents(spark, incident_files)
    kept = df.filter((F.col("lat") != 0) & (F.col("lon") != 0)).filter(F.col("weapon_code").startswith("1"))
    assert sorted(r["incident_id"] for r in kept.collect()) == ["1"]


def test_or_join_matches_padded_and_plain_keys(spark, incident_files):
    df = load_incidents(spark, incident_files)
    st = spark.createDataFrame([("1", "CENTRAL"), ("13", "NEWTON")], "prec string, division string")
    j = key_spellings_join(df, st, "area", [st["prec"], F.concat(F.lit("0"), st["prec"])])
    got = {r["incident_id"]: r["division"] for r in j.collect()}
    assert got["1"] == "CENTRAL" and got["5"] == "CENTRAL" and got["2"] == "NEWTON"
    assert len(got) == 11 and j.count() == 11  # each incident matches exactly once


# --- zones (F2, F3) --------------------------------------------------------

@pytest.fixture()
def zone_inputs(spark):
    facts = spark.createDataFrame(
        [(1.0, 1.0, "H"), (1.0, 1.0, "W"), (2.0, 2.0, "H"), (3.0, 3.0, "B"), (4.0, 4.0, "W"), (5.0, 5.0, "H"),
         (6.0, 6.0, "X"), (7.0, 7.0, "W"), (8.0, 8.0, "-")],
        "lat double, lon double, victim_code string")
    geocode = spark.createDataFrame(
        [(1.0, 1.0, "90001"), (2.0, 2.0, "90002"), (3.0, 3.0, "90003"), (4.0, 4.0, "90004"),
         (5.0, 5.0, "90005-1234"), (6.0, 6.0, "90006"), (7.0, 7.0, None), (8.0, 8.0, "90006")],
        "lat double, lon double, zip string")
    income = spark.createDataFrame(
        [("90001", 20000), ("90002", 50000), ("90003", 50000), ("90004", 50000), ("90005", 90000),
         ("90006", 10000), ("90006", 12000), ("90007", None)],
        "zip string, income int")
    return facts, geocode, income


def test_extreme_zones_raw_zip(spark, zone_inputs):
    facts, geocode, income = zone_inputs
    got = extreme_zone_counts(facts, geocode, income, k=3).collect()
    by_side = {}
    for r in got:
        by_side.setdefault(r["side"], {})[r["victim_code"]] = r["crime_total"]
    # raw ZIP+4 never matches; equal incomes at the boundary: smaller zip wins
    assert by_side["highest"] == {"H": 1, "B": 1, "W": 1}  # 90002, 90003, 90004
    assert by_side["lowest"] == {"X": 1, "-": 1, "H": 2, "W": 1}  # 90006, 90001, 90002
    totals = {r["victim_descent"]: r["crime_total"] for r in extreme_zone_totals(
        extreme_zone_counts(facts, geocode, income, k=3)).collect()}
    assert totals["Hispanic/Latin/Mexican"] == 3 and totals[None] == 1  # unknown code '-' has no label


def test_extreme_zones_prefix_zip(spark, zone_inputs):
    facts, geocode, income = zone_inputs
    got = extreme_zone_counts(facts, geocode, income, k=1, zip_key="prefix").collect()
    assert {(r["side"], r["victim_code"]) for r in got} == {("highest", "H"), ("lowest", "X"), ("lowest", "-")}


# --- facilities (F4) -------------------------------------------------------

@pytest.mark.parametrize("max_sites", [20000, 0])
def test_nearest_tie_broken_by_site_id(spark, max_sites):
    pts = spark.createDataFrame([(1, 34.0, -118.0)], "incident_id long, lat double, lon double")
    sites = spark.createDataFrame(
        [(7, "B", 34.1, -118.0), (3, "A", 33.9, -118.0), (9, "C", 35.0, -118.0)],
        "site_id long, division string, y double, x double")
    # on the sphere 0.1 degree north and south are exactly as far: a tie
    one = nearest_facility(pts, sites, site_cols=("division",), metric="haversine",
                           max_broadcast_sites=max_sites).collect()
    assert [(r["site_id"], r["division"]) for r in one] == [(3, "A")]
    both = nearest_facility(pts, sites, metric="haversine", ties=True, max_broadcast_sites=max_sites).collect()
    assert sorted(r["site_id"] for r in both) == [3, 7]
    # on the ellipsoid the meridian arc grows with latitude: the southern site is nearer
    geo = nearest_facility(pts, sites, metric="geodesic", ties=True, max_broadcast_sites=max_sites).collect()
    assert [r["site_id"] for r in geo] == [3]


def test_assigned_distance_counts_joined_rows(spark):
    pts = spark.createDataFrame(
        [(1, "01", 34.0, -118.0, 2015), (2, "1", 34.0, -118.0, 2015), (3, "13", 34.0, -118.0, 2016)],
        "incident_id long, area string, lat double, lon double, year int")
    sites = spark.createDataFrame([("1", "A", 34.0, -118.0), ("13", "B", 34.1, -118.0)],
                                  "prec string, division string, y double, x double")
    got = {r["year"]: (r["crime_total"], r["average_distance"])
           for r in assigned_distance(pts, sites, by="year").collect()}
    assert got[2015] == (2, 0.0)
    assert got[2016][0] == 1 and abs(got[2016][1] - 11.09) < 0.05
