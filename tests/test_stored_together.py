"""Rows that lie together are stored without a shuffle, and the flows are joined once."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from flowloom.plans.derived import Inputs
from flowloom.session import cut_lineage, work_path
from flowloom.sources import sinks as sn


def _files(path):
    return len(glob.glob(f"{path}/month=*/*.parquet"))


def _months(spark, n, parts, scattered):
    month = F.concat(F.lit("m"), (F.col("id") % 6 if scattered else F.floor(F.col("id") / (n // 6))).cast("string"))
    return spark.range(0, n, 1, parts).select("id", (F.col("id") % 7).alias("unit"), month.alias("month"))


def test_rows_that_lie_together_are_stored_from_where_they_are(spark):
    together, scattered = (cut_lineage(_months(spark, 600, 12, s)) for s in (False, True))
    assert sn.lie_together(together, ["month"]) and not sn.lie_together(scattered, ["month"])
    for rows in (together, scattered):
        path = work_path(spark, "units")
        for _ in range(2):  # the same again, then a part of it
            sn.write_units(rows, path, ["month", "unit"], ["month"], staged=True)
            assert _files(path) <= 24 and spark.read.parquet(path).count() == 600
        sn.write_units(rows.filter("unit = 3").withColumn("id", F.col("id") + 1000), path, ["month", "unit"], ["month"])
        stored = spark.read.parquet(path)
        assert stored.count() == 600 and stored.filter("id >= 1000").count() == rows.filter("unit = 3").count()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(sn.SORTED_BYTES)


def test_rows_of_null_partitions_are_counted_too(spark):
    rows = cut_lineage(spark.range(0, 80, 1, 8).select("id", F.lit(None).cast("string").alias("month")))
    assert not sn.lie_together(rows, ["month"]) and sn.lie_together(rows.limit(0), ["month"]) is True


def _tables(spark):
    folder, day = work_path(spark, "tables"), dt.date(1998, 1, 30)
    tables = {
        "customer": ([(1, 3, "BUILDING"), (2, None, None), (2, 4, "FURNITURE")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": ([(1, 1, "P", "1"), (2, 2, "O", None), (None, 1, "F", "2"), (3, None, "F", "2")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "supplier": ([(1, 5), (1, 5), (2, None)], "s_suppkey long, s_nationkey int"),
        "part": ([(1, "a b", "t", "br", 7), (2, None, None, None, None)], "p_partkey long, p_name string, p_type string, p_brand string, p_size int"),
        "lineitem": ([(o, p, s, n, 5.0, 10.5, 0.1, f, "O", None if n == 3 else day + dt.timedelta(n)) for o in (1, 2, 3, None) for p in (1, 2) for s in (1, 2) for n, f in ((1, "A"), (3, "R"), (4, None))],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate date"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_flows_by_month_are_the_flows(spark, rows):
    folder = _tables(spark)
    plain, kept, once = (Inputs(spark, folder) for _ in range(3))
    kept.flows_by_month(without=("o_orderpriority",))
    once.flows_by_month(written=False)
    want = plain.d_flows
    assert want.count() == 54 and rows(want) == rows(once.d_flows.select(*want.columns))
    assert rows(want.drop("o_orderpriority")) == rows(kept.d_flows) and rows(plain.d_connection) == rows(kept.d_connection)
    assert "Join" not in kept.d_connection._jdf.queryExecution().optimizedPlan().toString()
    stored = once.stored("d_resolved")
    assert once.d_resolved is stored and rows(stored) == rows(plain.d_resolved)


def test_resolved_rows_are_stored_where_the_flows_of_a_month_lie(spark, monkeypatch):
    from flowloom.plans.queries import QUERIES

    class Stored(Exception):
        pass

    def seen(df, path, partitions, together=False):
        raise Stored(path.rsplit("/", 1)[1], partitions, together, df._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions"))

    monkeypatch.setattr(sn, "write_partitioned", seen)
    try:
        QUERIES["job_aggregate"](spark, _tables(spark))
    except Stored as found:  # before: False and 0, so the wide rows were shuffled by month
        assert found.args == ("resolved", ["month"], True, 1)
