"""airlane: aircraft position pipelines as Spark DataFrame and streaming jobs."""

from airlane.session import configure

__all__ = ["configure"]
