"""Increments read and replace only what they must, and nothing is left out without a word."""

import os

import pytest
from pyspark.sql import functions as F

from flowloom.operators import clustering as cl
from flowloom.operators import ledger as lg
from flowloom.operators import matrix as mx
from flowloom.operators import privacy as pv
from flowloom.operators import usage as us
from flowloom.plans import jobs
from flowloom.session import work_path
from flowloom.sources import readers as rd
from flowloom.sources import sinks as sn




def unit_rows(spark, rows, extra="n int"):
    return spark.createDataFrame(rows, f"collecttype string, engine string, dt string, filedt string, {extra}").withColumn("dt", F.col("dt").cast("date"))


def test_days_of_units_prune_the_stored_table(spark):
    path = work_path(spark, "pruned")
    rows = unit_rows(spark, [("device", "e1", f"2016-05-{d:02}", "1", d) for d in range(1, 20)]).withColumn("month", F.lit("2016-05"))
    sn.write_partitioned(rows, path, ["month", "dt", "engine"])
    units = unit_rows(spark, [("device", "e1", "2016-05-07", "1", 0), ("device", "e1", "2016-05-09", "1", 0)]).withColumnRenamed("filedt", "min_filedt")
    ctx = jobs.scratch(spark, "x", folders={"resolved": path})
    found = jobs._stored_rows(spark, ctx, "resolved", units)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "2016-05-07" in line)
    assert "dt#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert sorted(r.n for r in found.collect()) == [7, 9]
    assert jobs._stored_rows(spark, ctx, "resolved", units.limit(0)).count() == 0


def test_another_engine_of_the_day_is_not_rewritten(spark):
    path = work_path(spark, "alone")
    first = unit_rows(spark, [("device", "e1", "2016-05-01", "2", 1), ("device", "e2", "2016-05-01", "2", 2)])
    sn.write_units(first, path, lg.UNIT, ["dt", "engine"])
    folder = path.removeprefix("file://") + "/dt=2016-05-01/engine=e2"
    before = sorted(os.listdir(folder))
    sn.write_units(unit_rows(spark, [("device", "e1", "2016-05-01", "1", 5)]), path, lg.UNIT, ["dt", "engine"])
    assert sorted(os.listdir(folder)) == before
    assert sorted((r.engine, r.filedt, r.n) for r in spark.read.parquet(path).collect()) == [("e1", "1", 5), ("e2", "2", 2)]


def test_nothing_new_adds_no_ledger_file(spark):
    path = work_path(spark, "ledger")
    entries = unit_rows(spark, [("device", "e1", "2016-05-01", "2", 1)])
    for _ in range(3):
        sn.append_ledger(entries, path)
    assert len([f for f in os.listdir(path.removeprefix("file://")) if f.startswith("part-")]) == 1


def test_a_file_without_the_header_is_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("I_ID_D;b\n1;2\n")
    (tmp_path / "b.csv").write_text("other;b\n3;4\n")
    assert rd.read_evolving(spark, [str(tmp_path / "a.csv")], "I_ID_D").count() == 1
    with pytest.raises(ValueError, match="b.csv"):
        rd.read_evolving(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "I_ID_D")


def test_other_destinations_are_an_error(spark):
    edges = spark.createDataFrame([("A", "B", 1.0), ("A", "Z", 5.0)], [mx.SRC, mx.DST, mx.TRAFFIC])
    assert mx.spread(edges, 5, ["B", "Z"]).count() == 1
    with pytest.raises(ValueError):
        mx.spread(edges, 5, ["B"])


def test_other_metrics_are_an_error(spark):
    rows = spark.createDataFrame([(1, "s", "cpu_percent", 2.0, "sysstat"), (1, "s", "brand_new", 3.0, "sysstat")],
                                 "date bigint, server string, name string, value double, `table` string")
    with pytest.raises(ValueError, match="brand_new"):
        us.pivot_metrics(rows, "sysstat")
    names = us.metric_names(rows, "sysstat")
    assert names == ["brand_new", "cpu_percent"] and us.pivot_metrics(rows, "sysstat", names).first()["brand_new"] == 3.0


def test_a_moving_matrix_is_an_error(spark):
    edges = spark.createDataFrame([("a", "b", 5.0), ("b", "c", 3.0), ("c", "a", 1.0)], [mx.SRC, mx.DST, mx.TRAFFIC])
    with pytest.raises(RuntimeError):
        cl.markov_clusters(edges, max_rounds=1)


def test_pseudonyms_need_a_key(spark):
    with pytest.raises(ValueError):
        pv.pseudonym(F.lit("name"), None)


def test_an_unknown_event_type_passes(spark):
    ctx = jobs.scratch(spark, "unknown")
    rows = unit_rows(spark, [("device", "e1", "2016-05-01", "2", 1)]).withColumn("month", F.lit("2016-05"))
    for _ in range(2):
        jobs.encode(spark, ctx, {"newtype": rows})
    assert [r.n for r in spark.read.parquet(ctx.path("newtype")).collect()] == [1]
