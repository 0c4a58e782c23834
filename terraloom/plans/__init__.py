"""Registered queries of the library."""

from terraloom.plans import q_aggregates, q_filters, q_functions, q_generate, q_joins, q_scene  # noqa: F401
from terraloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
