"""Physical plans as rows, so that strategies can be compared by a query. Plans are made, but nothing runs."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from blotter.plans.inspect import physical_plan


class PlanRow(NamedTuple):
    """A node of a plan, top-down: its depth (0 is the top), name, and what it states about joins and exchanges."""

    position: int
    depth: int
    node: str
    join_type: str | None
    build_side: str | None
    exchange: str | None


PLAN_SCHEMA = "label string, position int, depth int, node string, join_type string, build_side string, exchange string"
JOIN_SCHEMA = "label string, join_no int, join_node string, join_type string, build_side string, shuffles int, broadcasts int, sorts int"

_LINE = re.compile(r"^(?P<tree>[ :+\-]*)(?:\*\(\d+\) )?(?P<node>[A-Za-z][A-Za-z ]*?)(?P<rest>(?: [\[(]|  |, | [a-z]\w*[(=]|\(| \w+Mode|$).*)$")
_JOIN_TYPES = "Inner|Cross|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti|ExistenceJoin"


def plan_rows(df: DataFrame) -> list[PlanRow]:
    """The nodes of the physical plan of ``df``, as it is before it runs (with adaptive execution: the initial plan)."""
    text = physical_plan(df, "simple").split("== Initial Plan ==")[-1]
    out = []
    for line in text.splitlines():
        m = _LINE.match(line)
        if line.startswith("==") or not m:
            continue
        node, rest = m["node"].strip(), m["rest"]
        join = node.endswith("Join") or node == "CartesianProduct"
        kind = re.search(rf"\b({_JOIN_TYPES})\b", rest) if join else None
        side = re.search(r"\bBuild(Left|Right)\b", rest) if join else None
        exchange = None
        if node == "Exchange":
            exchange = re.match(r"\W*(\w+)", rest)[1]
        elif node == "BroadcastExchange":
            exchange = "broadcast"
        out.append(PlanRow(len(out), len(m["tree"]) // 3, node, kind[1] if kind else None, side[1].lower() if side else None, exchange))
    return out


def plan_table(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """All plan nodes of the labelled frames."""
    return spark.createDataFrame([(label, *row) for label, df in frames.items() for row in plan_rows(df)], PLAN_SCHEMA)


def _below(rows: list[PlanRow], top: PlanRow) -> list[PlanRow]:
    """The nodes below a join, without those below a further join."""
    out, skip = [], None
    for r in rows[top.position + 1 :]:
        if r.depth <= top.depth:
            break
        if skip is not None and r.depth > skip:
            continue
        skip = r.depth if r.join_type or r.node.endswith("Join") else None
        if skip is None:
            out.append(r)
    return out


def join_table(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per join of the labelled frames: its node, type and build side, and the exchanges and sorts that feed it."""
    found = []
    for label, df in frames.items():
        rows = plan_rows(df)
        joins = [r for r in rows if r.node.endswith("Join") or r.node == "CartesianProduct"]
        for n, j in enumerate(joins):
            fed = _below(rows, j)
            shuffles, broadcasts = (sum(r.node == kind for r in fed) for kind in ("Exchange", "BroadcastExchange"))
            found.append((label, n, j.node, j.join_type, j.build_side, shuffles, broadcasts, sum(r.node == "Sort" for r in fed)))
    return spark.createDataFrame(found, JOIN_SCHEMA)
