"""Every registered query; importing this module registers them."""

from settle.checks import q_flows, q_joins, q_rows, q_sources, q_totals, steps
from settle.checks.registry import ORACLES, QUERIES

MODULES = [steps, q_sources, q_rows, q_joins, q_totals, q_flows]

__all__ = ["MODULES", "ORACLES", "QUERIES"]
