"""All registered queries: importing this module fills the registry."""

from flowloom.plans import queries_aggregates, queries_io, queries_jobs, queries_matrix, queries_scalar, queries_tables  # noqa: F401
from flowloom.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
