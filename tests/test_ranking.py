"""Places within groups: named windows, and numbering without a task per group."""

import random

import pytest
from pyspark.sql import functions as F

from blotter import catalog
from blotter.operators.ranking import number_rows, top_rows
from blotter.plans.inspect import physical_plan
from tests.conftest import SF_SMALL


def _rows(n, seed=1):
    rng = random.Random(seed)
    return [(k, rng.choice(["hot"] * 6 + ["a", None, "b"]), rng.choice([None, 1, 2, 2, 3]), "x", 1) for k in range(n)]


def _frame(spark, rows):
    # names that the operator uses inside, and one that needs quotes
    return spark.createDataFrame(rows, "seq long, `b 0` string, k0 int, part string, n int")


def _places(rows):
    out = {}
    for g in {r[1] for r in rows}:
        of = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        for place, r in enumerate(of, 1):
            out[r[0]] = (place, 1 + sum(1 for o in of if (o[2] is None, -(o[2] or 0)) < (r[2] is None, -(r[2] or 0))))
    return out


@pytest.mark.parametrize("parts", ["1", "7"])
def test_numbers_equal_a_plain_sort(spark, parts):
    rows = _rows(700)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = number_rows(_frame(spark, rows).repartition(3), ["b 0"], [("k0", "desc")], tie_break=["seq"])
        assert got.columns == ["seq", "b 0", "k0", "part", "n", "place", "rank"]
        got = got.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 700 and {r["seq"]: (r["place"], r["rank"]) for r in got} == _places(rows)


def test_equal_rows_are_spread_and_numbered(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.lit("g").alias("g"), F.lit(None).cast("int").alias("v"), F.lit(1).alias("place"))
        got = number_rows(df.repartition(4), ["g"], ["v"])
        assert got.columns == ["g", "v", "place", "rank"]
        got = got.withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r["place"] for r in got) == list(range(1, 5001)) and {r["rank"] for r in got} == {1}
    sizes = [sum(r["p"] == p for r in got) for p in {r["p"] for r in got}]
    assert len(sizes) >= 4 and max(sizes) < 2500  # one group, many tasks


def test_no_rank_no_rows_and_several_groups(spark):
    df = _frame(spark, _rows(60))
    got = number_rows(df, ["b 0", "k0"], ["seq"], rank_col=None)
    assert got.columns[-1] == "place" and got.groupBy("b 0", "k0").agg((F.max("place") == F.count("*")).alias("ok")).where("not ok").count() == 0
    assert number_rows(df.limit(0), ["b 0"], ["k0"]).collect() == []


@pytest.mark.parametrize("ties", [False, True])
def test_first_rows_of_each_group(spark, ties):
    rows = _rows(300, seed=4)
    got = top_rows(_frame(spark, rows), ["b 0"], [("k0", "desc")], 4, tie_break=["seq"], ties=ties)
    want = {k: v for k, v in _places(rows).items() if v[1 if ties else 0] <= 4}
    assert {r["seq"]: (r["place"], r["rank"]) for r in got.collect()} == want
    with pytest.raises(ValueError):
        top_rows(_frame(spark, rows), ["b 0"], [("k0", "down")], 4)
    with pytest.raises(ValueError):
        top_rows(_frame(spark, rows), [], ["k0"], 4)


def test_a_bound_on_places_is_kept_before_the_shuffle(spark):
    plan = physical_plan(catalog.queries()["top_days_per_weapon"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") >= 2  # partial and final
