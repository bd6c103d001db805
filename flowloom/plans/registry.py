"""Registry of the named queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowloom.plans.derived import Inputs, with_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register ``fn(t)`` under ``name``; ``check`` is SQL with the same rows and column names."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if check is not None:
            CHECKS[name] = with_inputs(check)
        return fn

    return wrap
