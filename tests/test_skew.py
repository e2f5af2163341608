"""Joins with hot keys: the plain join's rows, and no task with more than its share."""

import pytest
from pyspark.sql import functions as F

from blotter.operators.skew import hot_keys, skew_join


def _left(spark, n=6000):
    k = F.col("id")
    lat = F.when(k % 3 == 0, F.lit(0.0)).when(k % 3 == 1, F.lit(34.5)).otherwise(k / 100)
    lat = F.when(k % 50 == 7, F.lit(None)).otherwise(lat)
    return spark.range(0, n, 1, 6).select(k.alias("id"), lat.alias("lat"), F.when(k % 3 == 2, k % 40).otherwise(F.lit(0)).cast("int").alias("lon"), F.lit("x").alias("lsalt"), F.array(k).alias("r"))


def _right(spark):
    rows = [(0.0, 0, "island"), (-0.0, 0, "minus"), (34.5, 0, "corner"), (34.5, 0, None), (34.5, 1, "no"), (None, 0, "null")] + [(k / 100, k % 40, str(k)) for k in range(2, 3000, 6)]
    return spark.createDataFrame(rows, "y double, x long, zip string")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_of_the_plain_join(spark, how):
    a, b = _left(spark), _right(spark)
    want = a.join(b, (a.lat == b.y) & (a.lon == b.x), how)
    got = skew_join(a, b, [("lat", "y"), ("lon", "x")], how)
    assert got.columns == want.columns and _rows(got) == _rows(want)
    small = skew_join(a, b, [("lat", "y"), ("lon", "x")], how, broadcast_bytes=1 << 20)
    assert _rows(small) == _rows(want)


def test_hot_keys_are_found(spark):
    n, hot = hot_keys(_left(spark), ["lat", "lon"])
    assert n == 6000 and sorted(hot.values(), reverse=True)[0] > 1500 and len(hot) <= 512
    assert hot_keys(_left(spark).limit(0), ["lat"]) == (0, {})


@pytest.mark.parametrize("how", ["inner", "left"])
def test_no_task_holds_a_hot_key(spark, how):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        a, b = _left(spark, 60_000).select("id", "lat", "lon"), _right(spark)
        b = b.where("zip in ('island', 'corner')")  # one row for each of the hot keys

        def largest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / sorted(sizes)[len(sizes) // 2]

        plain, spread = largest(a.join(b, (a.lat == b.y) & (a.lon == b.x), how)), largest(skew_join(a, b, [("lat", "y"), ("lon", "x")], how))
        assert spread < 2 and (how == "inner" or plain > 5)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_wrong_arguments(spark):
    a, b = _left(spark, 10), _right(spark)
    with pytest.raises(ValueError):
        skew_join(a, b, [("lat", "y")], "full")
    with pytest.raises(ValueError):
        hot_keys(a, ["lat"], share=1 / 4096, tracked=4096)
    assert skew_join(a.limit(0), b, [("lat", "y")]).collect() == [] and skew_join(a, b.limit(0), [("lat", "y")], "left").count() == 10
