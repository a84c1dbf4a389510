"""Queries over the driver's tables, one or more per operator, with their SQL counterparts."""

from workload import documents, enrichment, files, generation, readings, statistics, vectors  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
