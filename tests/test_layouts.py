"""Files with other column orders, and malformed records."""

import gzip

import pytest

from blotter.sources.incidents import INCIDENT_HEADER, load_incidents_by_header
from blotter.sources.layouts import CORRUPT, files_by_header, malformed_counts, read_by_header


def _write(path, *lines, mode="wt", opener=open):
    with opener(path, mode) as f:
        f.write("\n".join(lines) + "\n")


def test_swapped_columns_load_under_their_names(spark, tmp_path):
    _write(tmp_path / "a.csv", "Id,Name , X", "1,one,10", '2,"t,wo",20')
    _write(tmp_path / "b {1}*.csv", '" x","ID",unknown,"name"', "30,3,u,three", "40,4,u,four")
    _write(tmp_path / "c.csv.gz", "name,id", "five,5", opener=gzip.open)
    _write(tmp_path / "d.csv", "﻿id,name,x", "6,six,60")
    (tmp_path / "empty.csv").write_text("")
    assert len(files_by_header(spark, str(tmp_path))) == 3
    got = read_by_header(spark, str(tmp_path), {"id": "ID", "label": "Name", "x": "X"}, required=["id"])
    assert sorted((r.id, r.label, r.x) for r in got.collect()) == [
        ("1", "one", "10"), ("2", "t,wo", "20"), ("3", "three", "30"), ("4", "four", "40"), ("5", "five", None), ("6", "six", "60")]
    with pytest.raises(ValueError, match="x"):
        read_by_header(spark, str(tmp_path), {"id": "ID", "x": "X"}, required=["x"])


def test_malformed_rows_are_kept_and_counted(spark, tmp_path):
    _write(tmp_path / "a.csv", "id,x", "1,2", "3", "4,5,6", "", '7,"8"')
    _write(tmp_path / "b.csv", "x,id", "2,1")
    rows = read_by_header(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"], {"id": "id", "x": "x"})
    assert sorted((r.id, r.x, r[CORRUPT]) for r in rows.collect()) == [("1", "2", None), ("1", "2", None), ("3", None, "3"), ("4", "5", "4,5,6"), ("7", "8", None)]
    got = {r.file.rsplit("/", 1)[1]: (r.n_rows, r.n_malformed) for r in malformed_counts(rows).collect()}
    assert got == {"a.csv": (4, 2), "b.csv": (1, 0)}


def test_only_headers_and_equal_names(spark, tmp_path):
    _write(tmp_path / "a.csv", "id,x,x")
    assert read_by_header(spark, str(tmp_path), {"id": "id", "x": "x"}).collect() == []
    _write(tmp_path / "b.csv", "id,x,x", "1,first,second")
    assert [(r.id, r.x) for r in read_by_header(spark, str(tmp_path), {"id": "id", "x": "x"}).collect()] == [("1", "first")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read_by_header(spark, f"{tmp_path}/none", {"id": "id"}).columns == ["id", CORRUPT, "_file"]


def test_incidents_in_two_orders(spark, tmp_path):
    values = {"DR_NO": "1", "Date Rptd": "01/05/2015 12:00:00 AM", "DATE OCC": "12/31/2014 12:00:00 AM", "TIME OCC": "2330", "AREA": "01", "Vict Age": "30",
              "Vict Descent": "H", "Premis Desc": "STREET", "Weapon Used Cd": "102", "LAT": "34.05", "LON": "-118.25"}
    for k, names in enumerate((list(INCIDENT_HEADER), list(reversed(INCIDENT_HEADER)))):
        head = [n + " " if n == "AREA" and k else n for n in names]
        _write(tmp_path / f"{k}.csv", ",".join(head), ",".join({**values, "DR_NO": str(k)}.get(n, "") for n in names))
    a, b = sorted(load_incidents_by_header(spark, str(tmp_path)).collect())
    assert (a.incident_id, b.incident_id) == ("0", "1") and a[1:] == b[1:] and (b.lat, b.lon, str(b.occurred_on), b.victim_age) == (34.05, -118.25, "2014-12-31", 30)
