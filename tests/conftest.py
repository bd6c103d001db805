import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("flowloom-tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
                            spark__default__parallelism="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_path(spark, request):
    """Run a test with lookups broadcast, and again with no lookup small enough for it."""
    from flowloom.operators.joining import MAX_BYTES_SETTING

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set(MAX_BYTES_SETTING, "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset(MAX_BYTES_SETTING)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
