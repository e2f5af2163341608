"""Records with quoted line breaks from splittable text, against the multi-line reader."""

import random

import pytest
from pyspark.sql import functions as F

from blotter import catalog
from blotter.sources.incidents import load_incidents, load_incidents_text
from blotter.sources.records import read_quoted_records
from tests.conftest import SF_SMALL

DDL = "a string, b string, c string"


@pytest.fixture()
def tiny_splits(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _value(rng):
    kind = rng.random()
    if kind < 0.4:
        return rng.choice(["x", "12", "a b", "it's", 'in "side', ""])
    body = "".join(rng.choice(["a", "b c", ",", "\n", "\n\n", "\\\\", '\\"', " ", "é"]) for _ in range(rng.randrange(0, 9)))
    return f'"{body}"'


def _text(rng, n, end="\n"):
    return "".join(",".join([str(k), _value(rng), _value(rng)]) + end * rng.choice([1, 1, 1, 2]) for k in range(n))


def _both(spark, path):
    got = read_quoted_records(spark, path).select(F.from_csv("value", DDL).alias("r")).select("r.*")
    want = spark.read.schema(DDL).option("multiLine", True).csv(path)
    return sorted(map(str, got.collect())), sorted(map(str, want.collect()))


@pytest.mark.parametrize("size", [9, 40, 1000, 1 << 20])
def test_equals_the_multi_line_reader(spark, tmp_path, tiny_splits, size):
    rng = random.Random(size)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(_text(rng, 2 * size if size < 1000 else 400), newline="")
    tiny_splits(size)
    got, want = _both(spark, str(tmp_path))
    assert len(want) > 40 and got == want


def test_carriage_returns(spark, tmp_path, tiny_splits):
    (tmp_path / "w.csv").write_text('1,"a,\r\nb",x\r\n\r\n2,"",y\r\n3,plain,"z"\r\n"\r\n",4,5\r\n', newline="")
    for size in (5, 1 << 20):
        tiny_splits(size)
        got, want = _both(spark, str(tmp_path))
        assert len(got) == 4 and got == want


def test_odd_quotes(spark, tmp_path, tiny_splits):
    text = '"a "b" c\nd",x\n1,2\n"a ""b"" c\nd",x\n"a""\nd",x\na"b\nc",x\n"a\\"\nc",x\n"a\\\\"\nc",x\n"a" \nc",x\n "a\nc",x\n"x""",y\n"a ,"b",c\nd",x\n\n  \n"",""\n"\n",\n1\n'
    (tmp_path / "odd.csv").write_text(text)
    for size in (3, 11, 1 << 20):
        tiny_splits(size)
        got, want = _both(spark, str(tmp_path))
        assert got == want


def test_a_record_longer_than_splits_and_one_never_closed(spark, tmp_path, tiny_splits):
    long = "line of text,\n" * 200
    (tmp_path / "a.csv").write_text(f'1,"{long}",z\n2,"{long}",z\n')
    (tmp_path / "b.csv").write_text('3,x,y\n4,"open\n5,x\n6,"y\n')
    (tmp_path / "c.csv").write_text("")
    tiny_splits(100)
    got = sorted(r.value for r in read_quoted_records(spark, str(tmp_path)).collect())
    assert got == sorted([f'1,"{long}",z', f'2,"{long}",z', "3,x,y", '4,"open\n5,x\n6,"y'])
    tiny_splits(1 << 20)
    assert sorted(r.value for r in read_quoted_records(spark, str(tmp_path)).collect()) == got
    assert read_quoted_records(spark, str(tmp_path / "c.csv")).collect() == []


def test_incidents_with_line_breaks_across_splits(spark, tiny_splits):
    paths = catalog.export_multiline_file(spark, SF_SMALL)
    want = sorted(map(str, load_incidents(spark, paths, multiline=True).collect()))
    tiny_splits(2000)
    lines = spark.read.text(paths)
    assert lines.rdd.getNumPartitions() > 20 and lines.count() > len(want) + 100
    assert sorted(map(str, load_incidents_text(spark, paths, multiline=True).collect())) == want
