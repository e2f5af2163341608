"""Plans as rows, released caches, and disjoint branches of a disjunctive join."""

import duckdb
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from blotter import catalog
from blotter.operators.joins import disjunctive_join, with_join_hint
from blotter.operators.reuse import Reuse
from blotter.plans.compare import join_table, plan_rows, plan_table
from tests.conftest import SF_SMALL


def test_nodes_of_a_plan(spark):
    a, b = spark.range(100).withColumn("x", F.col("id") % 7), spark.range(50).withColumnRenamed("id", "y")
    df = with_join_hint(a.withColumnRenamed("id", "y"), b, "y", "left", "merge").groupBy("x").count()
    rows = plan_rows(df)
    assert [r.position for r in rows] == list(range(len(rows))) and rows[0].depth == 0 and max(r.depth for r in rows) > 4
    join = next(r for r in rows if r.node == "SortMergeJoin")
    assert (join.join_type, join.build_side) == ("LeftOuter", None)
    assert [r.exchange for r in rows if r.exchange].count("hashpartitioning") == 3 and sum(r.node == "HashAggregate" for r in rows) == 2
    t = plan_table(spark, {"a": df, "b": a})
    assert t.where("label = 'a'").count() == len(rows) and t.columns[0] == "label"


def test_each_join_has_its_own_exchanges(spark):
    a, b, c = (spark.range(n).withColumnRenamed("id", "k") for n in (100, 50, 20))
    df = with_join_hint(with_join_hint(a, b, "k", "inner", "merge"), c, "k", "left", "broadcast")
    got = [tuple(r)[1:] for r in join_table(spark, {"x": df}).orderBy("join_no").collect()]
    assert got == [(0, "BroadcastHashJoin", "LeftOuter", "right", 0, 1, 0), (1, "SortMergeJoin", "Inner", None, 2, 0, 2)]
    assert join_table(spark, {"none": a}).collect() == []


def test_plans_are_made_without_running(spark):
    boom = F.udf(lambda x: 1 / 0, "double")
    df = spark.range(5).withColumn("v", boom("id")).join(F.broadcast(spark.range(5)), "id")
    assert join_table(spark, {"x": df}).count() == 1


def _cached(spark):
    return spark._jsc.getPersistentRDDs().size(), spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    before = _cached(spark)[0]
    with Reuse() as reuse:
        df = reuse.keep(spark.range(1000).withColumn("x", F.rand()))
        assert df.agg(F.sum("x")).first() == df.agg(F.sum("x")).first() and _cached(spark) == (before + 1, False)
        assert df.storageLevel == StorageLevel.MEMORY_AND_DISK or df.storageLevel.useDisk
    assert _cached(spark) == (before, True)
    with pytest.raises(ZeroDivisionError):
        with Reuse() as reuse:
            reuse.keep(spark.range(10)).count()
            reuse.keep(spark.range(20))  # never used
            raise ZeroDivisionError
    assert _cached(spark) == (before, True)
    own = spark.range(30).cache()
    with Reuse() as reuse:
        assert reuse.keep(own) is own
        own.count()
    assert own.storageLevel != StorageLevel.NONE
    own.unpersist(blocking=True)


def test_income_extremes_release_their_counts(spark):
    spark.catalog.clearCache()
    got = catalog.queries()["income_extremes_cached"](spark, SF_SMALL)
    assert _cached(spark)[1]
    assert got.collect() == catalog.queries()["income_extremes"](spark, SF_SMALL).collect()


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_disjunctive_join_equals_the_or_join(spark, how):
    a = [(k, None if k % 7 == 0 else k % 5, f"{k % 4:02d}" if k % 3 else str(k % 4), "p") for k in range(40)] + [(39, 4, "03", "p")]
    b = [(k, None if k % 4 == 0 else k % 6, str(k % 9), k % 3) for k in range(20)] + [(19, 1, "1", 1)]
    left = spark.createDataFrame(a, "id int, x int, area string, r string")
    right = spark.createDataFrame(b, "id int, y int, prec string, l int")
    got = disjunctive_join(left, right, [[("x", "y"), (F.col("id") % 3, "l")], [("area", "prec")], [("area", F.concat(F.lit("0"), "prec"))], [("x", "l")]], how)
    assert got.columns == ["id", "x", "area", "r", "id", "y", "prec", "l"]
    con = duckdb.connect()
    con.execute("CREATE TABLE a (id int, x int, area text, r text)")
    con.execute("CREATE TABLE b (id int, y int, prec text, l int)")
    con.executemany("INSERT INTO a VALUES (?, ?, ?, ?)", a)
    con.executemany("INSERT INTO b VALUES (?, ?, ?, ?)", b)
    want = con.execute(f"SELECT * FROM a {how} JOIN b ON (a.x = b.y AND a.id % 3 = b.l) OR a.area = b.prec OR a.area = '0' || b.prec OR a.x = b.l").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want)) and len(want) > 40


def test_disjunctive_join_has_no_nested_loop(spark):
    nodes = {r.node for r in plan_rows(catalog.queries()["or_join_disjoint"](spark, SF_SMALL))}
    assert not nodes & {"BroadcastNestedLoopJoin", "CartesianProduct"}
    with pytest.raises(ValueError):
        disjunctive_join(spark.range(1), spark.range(1), [], "inner")
    with pytest.raises(ValueError):
        disjunctive_join(spark.range(1), spark.range(1), [[("id", "id")]], "cross")
