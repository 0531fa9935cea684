"""Registered queries with their SQL cross-checks, over views of the provided tables."""

from airlane.plans import ingest, metrics, reads, routes, state  # noqa: F401
from airlane.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
