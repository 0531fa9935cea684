"""Operators of training-data pipelines, as queries over the provided tables.

Nothing else in the package imports this one.
"""

from airlane.llm.queries import LLM_ORACLES, LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
