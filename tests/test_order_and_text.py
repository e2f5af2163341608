"""Row order of the sorted queries, and equality of the two incident loaders."""

from blotter import catalog
from blotter.sources.incidents import INCIDENT_HEADER, load_incidents, load_incidents_text
from tests.conftest import SF_SMALL


def test_sorted_queries_return_their_order(spark):
    q = catalog.queries()
    up, down = ([r[0] for r in q[k](spark, SF_SMALL).collect()] for k in ("sort_asc", "sort_desc"))
    assert len(up) > 1 and len(down) > 1
    keys = {k: q[k](spark, SF_SMALL) for k in ("daypart_counts", "responsible_station_by_division")}
    for df in keys.values():
        counts = [r["crime_total"] for r in df.collect()]
        assert counts == sorted(counts, reverse=True)
    years = [r["year"] for r in q["responsible_station_by_year"](spark, SF_SMALL).collect()]
    assert years == sorted(years)


def test_both_loaders_keep_every_record(spark, tmp_dir):
    """Records without an id or with blank fields stay; header and blank lines go."""
    row = lambda **v: ",".join(v.get(h, "") for h in INCIDENT_HEADER)
    lines = [",".join(INCIDENT_HEADER), row(**{"DR_NO": "1", "DATE OCC": "01/02/2015 12:00:00 AM", "LAT": "34.0", "LON": "-118.0"}),
             row(**{"DATE OCC": "01/03/2015 12:00:00 AM", "AREA": "7"}), "", row(**{"DR_NO": "2", "Premis Desc": '"SHOP, INDOOR"', "Vict Age": "x"})]
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    a, b = (sorted(map(str, load(spark, f"{tmp_dir}/a.csv").collect())) for load in (load_incidents, load_incidents_text))
    assert a == b and len(a) == 3
