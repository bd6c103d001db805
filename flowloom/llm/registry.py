"""Registry of the queries of this folder and of their checking SQL; every query reads its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_BYTES = 2 << 20
_BATCH_SETTING, _SPARK_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Batches that go to Python workers are counted in bytes, not rows, so long texts do not swell them; a session's own setting stays."""
    if spark.conf.get(_BATCH_SETTING, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def workers_find_package(spark: SparkSession) -> None:
    """Python workers on this machine import the package wherever the driver was started; on a cluster it is installed or sent with --py-files."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *[x for x in known if x]])
    bound_batches(spark)


def query(name: str, check: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark, folder):
            workers_find_package(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return fn

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
