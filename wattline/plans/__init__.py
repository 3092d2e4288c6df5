"""Registered queries: one Spark plan and one DuckDB oracle per inventory ID."""

from wattline.plans.registry import QUERIES, ORACLES, register

__all__ = ["QUERIES", "ORACLES", "register"]
