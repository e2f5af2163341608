"""Physical-plan checks: no Python evaluation, no nested loops, pushed filters, hints."""

import pytest

from blotter import catalog
from blotter.operators.joins import with_join_hint
from blotter.plans.inspect import physical_plan, plan_nodes
from tests.conftest import SF_SMALL

NATIVE_KEYS = [
    "top_months_per_year", "daypart_counts", "daypart_counts_isin", "income_extremes",
    "responsible_station_by_year", "responsible_station_by_division",
    "nearest_station_by_year", "nearest_station_by_division", "csv_scan",
]


@pytest.mark.parametrize("key", NATIVE_KEYS)
def test_no_python_and_no_pairs(spark, key):
    plan = physical_plan(catalog.queries()[key](spark, SF_SMALL))
    # the geodesic is the one Arrow-batched function; nothing runs row by row
    unwanted = ["BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]
    for node in unwanted if "station" in key else [*unwanted, "ArrowEvalPython"]:
        assert node not in plan, (key, node)


def test_udf_query_uses_arrow(spark):
    assert "ArrowEvalPython" in physical_plan(catalog.queries()["udf_scalar"](spark, SF_SMALL))


def test_year_filter_reaches_the_scan(spark):
    plan = physical_plan(catalog.queries()["filter_year"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_projection_is_pruned(spark):
    plan = physical_plan(catalog.queries()["top_months_per_year"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_nearest_search_is_one_broadcast(spark):
    df = catalog.queries()["nearest_station_by_division"](spark, SF_SMALL)
    df.collect()  # AQE reuses identical broadcast stages at run time
    final = physical_plan(df).split("== Initial Plan ==")[0]
    nodes = plan_nodes(final)
    assert nodes.count("BroadcastExchange") == 1  # one level table, reused by every probe
    assert nodes.count("ReusedExchange") >= 1
    assert "SortMergeJoin" not in final and "ShuffledHashJoin" not in final


@pytest.mark.parametrize("hint,node", [
    ("broadcast", "BroadcastHashJoin"),
    ("merge", "SortMergeJoin"),
    ("shuffle_hash", "ShuffledHashJoin"),
])
def test_join_hints(spark, hint, node):
    plan = physical_plan(catalog.queries()[f"join_hint_{hint}"](spark, SF_SMALL))
    assert node in plan


def test_replicate_nl_is_refused(spark):
    a = spark.range(3)
    with pytest.raises(ValueError):
        with_join_hint(a, a, "id", "inner", "shuffle_replicate_nl")


def test_broadcast_hint_needs_proven_size(spark):
    a = spark.range(10).withColumnRenamed("id", "k")
    b = spark.range(100).withColumnRenamed("id", "k")
    plan = physical_plan(with_join_hint(a, b, "k", "inner", "broadcast", max_broadcast_bytes=50))
    assert "ResolvedHint" not in with_join_hint(a, b, "k", "inner", "broadcast", max_broadcast_bytes=50)._jdf.queryExecution().analyzed().toString()
    assert plan
