"""Registered queries against their DuckDB SQL on the smallest tables.

Every query runs here except the longest jobs; ``FLOWLOOM_ALL=1`` adds those.
"""

import os

import pytest
from check import connect, differences

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
LONG = {"job_publish", "job_sockets", "job_resolve", "job_resolve_execution", "job_flow", "job_aggregate", "cluster_mcl", "cluster_kmeans"}
KEYS = [k for k in entry_point.queries() if os.environ.get("FLOWLOOM_ALL") or k not in LONG]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, duck, key):
    assert differences(spark, duck, FOLDER, key, entry_point.queries(), entry_point.oracle_sql()) is None


def test_every_check_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
