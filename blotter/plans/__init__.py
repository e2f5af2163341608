"""Plans: SQL twins live next to their DataFrame operators in the catalogue;
this package holds plan inspection and comparison helpers."""

from blotter.plans.compare import join_table, plan_rows, plan_table
from blotter.plans.inspect import physical_plan, plan_nodes

__all__ = ["join_table", "physical_plan", "plan_nodes", "plan_rows", "plan_table"]
