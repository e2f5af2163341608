"""Plan inspection helpers (used by tests and for reviewing strategies)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan text, as ``df.explain(mode)`` prints it."""
    return df._jdf.queryExecution().explainString(_mode(df, mode))


def _mode(df: DataFrame, mode: str):
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)


def plan_nodes(plan_text: str) -> list[str]:
    """Operator names of the tree part of a formatted plan, top-down."""
    tree = plan_text.split("\n\n\n")[0]
    return re.findall(r"[+:\- ]*([A-Z][A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)", tree)
