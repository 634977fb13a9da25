"""Registered queries by name, and the DuckDB twin of each."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a plan ``(spark, sf_dir) -> DataFrame`` under its own name, with the SQL that gives the same rows."""

    def register(plan):
        known = name or plan.__name__
        QUERIES[known] = plan
        if sql:
            SQL[known] = sql
        return plan

    return register


from tidewake.plans import live_plans, movement_plans, planning_plans, report_plans, rule_plans, spatial_plans, stop_plans  # noqa: E402, F401
