"""All named queries."""

from workload import cdc, cost, governance, reshape, runs, streams, weather  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
