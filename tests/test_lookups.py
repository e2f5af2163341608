"""Loaders of the side tables (FIXTURES.md F2-F4): traps in files, and the operators on loaded tables."""

import pytest
from pyspark.sql import functions as F

from blotter import assigned_distance, extreme_zone_counts, load_geocode, load_income, load_stations
from blotter.functions.clean import clean_money


@pytest.fixture()
def write(tmp_dir):
    def put(name, *lines):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
        return f"{tmp_dir}/{name}"

    return put


def test_income_amounts(spark, write):
    path = write("income.csv", "Zip Code,Community,Estimated Median Income", '90001,"Florence, South","$33,887"', "90002,Watts,", "90001,Florence,$30")
    rows = load_income(spark, path).withColumn("income", clean_money("income_raw")).collect()
    assert sorted((r["zip"], r["income"] or 0) for r in rows) == [("90001", 30), ("90001", 33887), ("90002", 0)]
    assert {r["community"] for r in rows} == {"Florence, South", "Watts", "Florence"}
    assert [r["income"] for r in rows if r["zip"] == "90002"] == [None]


def test_geocode_keeps_suffixes_nulls_and_repeats(spark, write):
    path = write("geo.csv", "LAT,LON,ZIPcode", "34.1,-118.2,90001", "33.7,-118.3,90731-7232", "34.0,-118.0,", "34.1,-118.2,90001", "north,-118.0,90002")
    got = sorted(map(str, (tuple(r) for r in load_geocode(spark, path).collect())))
    want = [(34.1, -118.2, "90001"), (33.7, -118.3, "90731-7232"), (34.0, -118.0, None), (34.1, -118.2, "90001"), (None, -118.0, "90002")]
    assert got == sorted(map(str, want))


def test_stations_take_columns_by_name(spark, write):
    path = write("stations.csv", "X,Y,FID,DIVISION,LOCATION,PREC", '-118.25,34.05,1,CENTRAL,"251 E 6TH ST, LA",1', "-118.27,34.01,2,NEWTON,x,13", "bad,34.0,3,NOWHERE,x,")
    rows = {r["division"]: tuple(r) for r in load_stations(spark, path).collect()}
    assert rows["CENTRAL"] == (1, "1", "CENTRAL", 34.05, -118.25)
    assert rows["NOWHERE"] == (None, None, "NOWHERE", 34.0, None)


def test_files_of_two_runs_are_one_table(spark, write):
    head = "Zip Code,Community,Estimated Median Income"
    paths = [write("a.csv", head, "90001,A,$10"), write("b.csv", head, "90002,B,$20")]
    assert sorted(r["zip"] for r in load_income(spark, paths).collect()) == ["90001", "90002"]


def test_operators_on_loaded_tables(spark, write):
    facts = spark.createDataFrame([(34.1, -118.2, "H", "01"), (33.7, -118.3, "W", "13")], "lat double, lon double, victim_code string, area string")
    geo = load_geocode(spark, write("geo.csv", "LAT,LON,ZIPcode", "34.1,-118.2,90001", "33.7,-118.3,90731"))
    income = load_income(spark, write("income.csv", "Zip Code,Community,Estimated Median Income", '90001,A,"$33,887"', '90731,B,"$1,000"'))
    income = income.withColumn("income", clean_money("income_raw"))
    got = {(r["side"], r["victim_code"]) for r in extreme_zone_counts(facts, geo, income, k=1).collect()}
    assert got == {("highest", "H"), ("lowest", "W")}
    sites = load_stations(spark, write("stations.csv", "PREC,DIVISION,X,Y", "1,CENTRAL,-118.2,34.1", "13,NEWTON,-118.3,33.7"))
    rows = assigned_distance(facts, sites, by="division").orderBy(F.col("division")).collect()
    assert [(r["division"], r["crime_total"], r["average_distance"]) for r in rows] == [("CENTRAL", 1, 0.0), ("NEWTON", 1, 0.0)]
