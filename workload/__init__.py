"""Registered queries over the given tables, each with its SQL where SQL can say it."""

from workload import io_queries, log_queries, metric_queries, model_queries  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
